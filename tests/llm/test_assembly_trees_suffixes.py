"""Fill-in-middle, Merkle manifest and suffix dedup on planted and edge rows, against SQL and plain re-statements."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from citylens.llm import op11_fim, op12_merkle, op13_suffixes
from citylens.llm.oracles import ORACLES
from tests.llm.conftest import EDGE_ROWS, documents
from tests.llm.test_oracles import bag, same

#: extra columns with names that the operators use themselves
CLASHING = ["document", "tree", "pos", "n", "digest", "tampered", "block", "ids", "sizes", "data", "_block", "_part", "_tie", "path", "form"]


def duck(rows):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)",
                    [[*r[:2], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1", len(r[1] or "")] for r in rows])
    return con


def clashing(docs):
    return docs.withColumns({c: F.lit("x") for c in CLASHING})


def mixed_rows(n=400, seed=5):
    rng = random.Random(seed)
    texts = ["", None, "<P>", "a <M> b", "<S", "x<", "é漢", "ΔЖ" * 40, "Plain Words", "a"]
    return [(rng.choice([i, i, i, 7, None]), rng.choice([*texts, "Word " * rng.randrange(60)]), rng.choice(["en", "en", "en", "de", None, ""]),
             rng.choice(["s1", None])) for i in range(n)]


# ------------------------------------------------------------------ op11
def fim_rows(df):
    return df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@pytest.mark.parametrize("chunk", [1, 3, 65_536])
def test_fim_against_sql(spark, chunk):
    rows = [r for r in EDGE_ROWS if chunk > 3 or len(r[1] or "") < 10_000] + mixed_rows()
    docs = clashing(documents(spark, rows)).repartition(5)
    same(fim_rows(op11_fim.fill_in_middle(docs, chunk=chunk)), duck(rows).sql(ORACLES["op11_fim"]))


def test_fim_outputs_and_round_trip(spark):
    rows = [(i, f"text {i} " * (i % 9) + "é<" * (i % 4)) for i in range(300)]
    docs = documents(spark, rows)
    pieces = defaultdict(list)
    for r in op11_fim.output_pieces(docs, chunk=5).collect():
        pieces[r.doc_id].append((r.position, r.piece, r.form))
    digests = {r.doc_id: r for r in op11_fim.fill_in_middle(docs).collect()}
    outputs = []
    for doc_id, found in pieces.items():
        assert [p for p, *_ in sorted(found)] == list(range(1, len(found) + 1))
        text = "".join(piece for _, piece, _ in sorted(found))
        outputs.append((doc_id, text, found[0][2]))
        assert hashlib.sha256(text.encode()).hexdigest() == digests[doc_id].output_sha256
    back = op11_fim.restore(spark.createDataFrame(outputs, "doc_id long, text string, form string")).collect()
    assert {r.doc_id: r.text for r in back} == {i: t for i, t in rows if t}
    assert {r.form for r in back} == {"plain", "psm", "spm"}


def test_fim_parser_finds_cut_sentinels():
    out = "<S>su<ff<P>pre<<M>mid<S"
    for size in range(1, 9):
        parser, parts = op11_fim.Parser("spm"), defaultdict(bytes)
        for at in range(0, len(out), size):
            for rank, part in parser.feed(out[at:at + size].encode()):
                parts[rank] += part
        assert (parts[0], parts[1], parts[2]) == (b"pre<", b"mid<S", b"su<ff")


def test_fim_moves_texts_once(spark):
    docs = documents(spark, mixed_rows(50))
    lineage = op11_fim.fill_in_middle(docs).rdd.toDebugString().decode()
    assert lineage.count("ShuffledRDD") == 1              # the second sort stays in place


# ------------------------------------------------------------------ op12
def manifest_rows(df):
    return df.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "siblings"), 256).alias("proof_sha256"), "folded_root", "verified")


def test_merkle_against_sql(spark):
    rows = EDGE_ROWS + mixed_rows(900) + [(2000 + i, "One of Many Groups", f"l{i}") for i in range(75)]
    docs = clashing(documents(spark, rows)).repartition(7)
    same(manifest_rows(op12_merkle.manifest(docs)), duck(rows).sql(ORACLES["op12_merkle"]))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 4096, 4097])
def test_merkle_of_one_group(spark, n):
    rows = [(i, f"Text {i}") for i in range(n)]
    same(manifest_rows(op12_merkle.manifest(documents(spark, rows))), duck(rows).sql(ORACLES["op12_merkle"]))


def test_blocks_over_blocks_give_the_whole_tree(monkeypatch):
    """Blocks of one level, round after round, against one block of all levels."""
    digests = [op12_merkle.H(str(i)) for i in range(1500)]
    whole = op12_merkle.build(digests, op12_merkle.climb(1500)).digest
    monkeypatch.setattr(op12_merkle, "HEIGHT", 1)
    while len(digests) > 1:
        digests = [op12_merkle.build(digests[i:i + 8], op12_merkle.climb(len(digests))).digest for i in range(0, len(digests), 8)]
    assert digests == [whole]


def test_versions_share_untouched_nodes():
    digests = [op12_merkle.H(str(i)) for i in range(500)]
    tree = op12_merkle.build(digests, 3)
    version = op12_merkle.path_copy(tree, 3, 300, op12_merkle.H("other"))

    def nodes(node):
        yield id(node)
        for child in node.children:
            yield from nodes(child)

    kept, fresh = set(nodes(tree)), set(nodes(version))
    assert len(fresh - kept) == 4                         # the leaf and its three ancestors
    assert tree == op12_merkle.build(digests, 3)
    digests[300] = op12_merkle.H("other")
    assert version == op12_merkle.build(digests, 3)
    folded = digests[300]
    for left, right in op12_merkle.sibling_runs(tree, 3, 300):
        folded = op12_merkle.H([*left, folded, *right])
    assert folded == version.digest


# ------------------------------------------------------------------ op13
def suffix_rows(df):
    return df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def repeated_rows(seed=3):
    rng = random.Random(seed)
    ab = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 10, 49, 50, 51, 60, 200, 3000]))) for _ in range(60)]
    words = [" ".join(rng.choice(["alpha", "beta", "gämma", "δelta", "x\0"]) for _ in range(rng.choice([1, 5, 30, 300]))) for _ in range(60)]
    line = "This one very common line stands in every document, with other text on both sides of it."
    rows = []
    for i in range(300):
        t = rng.choice([rng.choice(ab), rng.choice(words), "a" * rng.choice([49, 50, 70, 500]), None, ""])
        if t and rng.random() < 0.5:
            s = rng.choice(ab + words)
            cut = rng.randrange(len(s) + 1)
            t = t[:cut] + s[cut // 2:cut + 100] + t[cut // 3:]
        rows.append((rng.choice([i, i, i, 5, None]), t))
    return rows + [(1000 + i, "%032x" % rng.getrandbits(128) + line + "%032x" % rng.getrandbits(128)) for i in range(200)]


def plain_repeats(rows, length=op13_suffixes.LENGTH):
    """Windows by dictionary, bytes by flags."""
    late = 2 ** 63 - 1
    docs = [(late if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    least = {}
    for i, b in docs:
        for p in range(len(b) - length + 1):
            least[b[p:p + length]] = min(i, least.get(b[p:p + length], late + 1))
    out = []
    for (i, b), row in zip(docs, rows):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((row[0], len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("block_bytes,hot", [(10_000_000, 20_000), (3_000, 20_000), (3_000, 5), (10_000_000, 5)])
def test_suffix_dedup_against_windows(spark, block_bytes, hot):
    rows = repeated_rows()
    docs = clashing(documents(spark, rows)).repartition(5)
    got = suffix_rows(op13_suffixes.repeated_strings(docs, block_bytes=block_bytes, hot=hot)).collect()
    assert bag(got) == bag(plain_repeats(rows))


def test_suffix_dedup_against_sql(spark, edge_docs):
    same(suffix_rows(op13_suffixes.repeated_strings(edge_docs)), duck(EDGE_ROWS).sql(ORACLES["op13_suffixes"]))


def test_suffix_spans_and_kept_bytes(spark):
    passage = "a passage of more than fifty bytes that stands in two documents, é"
    rows = [(3, "first " + passage + " third"), (9, passage + " alone " + passage), (4, "clean text of the same size as the other ones, and more of it")]
    got = {r.doc_id: r for r in op13_suffixes.repeated_strings(documents(spark, rows)).collect()}
    size = len(passage.encode())
    assert got[3].n_removed == got[4].n_removed == 0 and bytes(got[4].kept).decode() == rows[2][1]
    # the blank before "alone" is not in document 3, the one before the passage is
    starts = [(s.start, s.end) for s in got[9].spans]
    assert starts == [(0, size), (size + 6, 2 * size + 7)] or starts == [(0, size + 1), (size + 6, 2 * size + 7)]
    assert bytes(got[9].kept) == b"".join((rows[1][1].encode()[a:b] for a, b in zip([0, *(e for _, e in starts)], [*(s for s, _ in starts), None])))


def random_keys(rng, n):
    return sorted({b"\0" + bytes(rng.choice(b"ab") for _ in range(rng.randrange(24, 60))) for _ in range(n)})


def test_loser_tree_merges_in_order():
    rng = random.Random(8)
    for n_runs in (1, 2, 3, 5, 8, 13):
        lists = [random_keys(rng, rng.choice([1, 3, 40])) for _ in range(n_runs)]
        lists[-1] = lists[0]
        runs = [op13_suffixes.Run(op13_suffixes._front_coded(keys, [b""] * len(keys), np.arange(len(keys)))) for keys in lists]
        assert [r.keys for r in runs] == lists
        out = list(op13_suffixes.merged(runs))
        keys = [lists[r][at] for r, at, _ in out]
        assert keys == sorted(k for keys in lists for k in keys)
        assert Counter(r for r, *_ in out) == Counter({i: len(x) for i, x in enumerate(lists)})
        for before, key, (_, _, common) in zip([b""] + keys, keys, out):
            want = next((i for i, (a, b) in enumerate(zip(before, key)) if a != b), min(len(before), len(key)))
            assert common == want


class Counted(bytes):
    """Bytes that report the places they are compared at."""
    seen: list = []

    def __getitem__(self, at):
        if isinstance(at, slice):
            Counted.seen.append(at.start)
        return bytes.__getitem__(self, at)


def test_known_prefixes_are_not_compared_again():
    prefix = b"\0" + b"x" * 40
    lists = [[Counted(prefix + bytes([65 + i, 65 + r])) for i in range(20)] for r in range(4)]
    runs = []
    for keys in lists:
        run = op13_suffixes.Run(op13_suffixes._front_coded([bytes(k) for k in keys], [b""] * len(keys), np.arange(len(keys))))
        run.keys = keys
        runs.append(run)
    Counted.seen = []
    assert len(list(op13_suffixes.merged(runs))) == 80
    opening = Counted.seen[:6]                            # three matches build the tree
    assert set(opening) == {0} and min(Counted.seen[6:]) >= len(prefix)


def test_stretches_cover_every_window_once():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 49, 50, 51, 400, 3, 1200)]
    texts.append(texts[-1][100:700])
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    s = op13_suffixes.stretches(b"".join(texts), starts)
    windows = sorted(w for at, n in zip(s["at"].tolist(), s["n"].tolist()) for w in range(at, at + n))
    assert windows == [w for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()) for w in range(a, b - 49)]
    data = b"".join(texts)
    lead = {}
    for at, n, x, h in zip(*(s[c].tolist() for c in ("at", "n", "lead", "h"))):
        for w in range(n):                                # equal windows have their anchor at the same distance
            assert lead.setdefault(data[at + w:at + w + 50], (x - w, h)) == (x - w, h)


def test_no_documents(spark, no_docs):
    assert op11_fim.fill_in_middle(no_docs).count() == 0
    assert op12_merkle.manifest(no_docs).count() == 0
    assert op13_suffixes.repeated_strings(no_docs).count() == 0


def test_hot_copies_meet_once_a_block(spark):
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(60))
    rows = [(i, text) for i in range(300)] + [(i, f"{i} " + text[:200] + f" {i * 31}") for i in range(300, 400)]
    got = suffix_rows(op13_suffixes.repeated_strings(documents(spark, rows).repartition(4), block_bytes=20_000)).collect()
    assert bag(got) == bag(plain_repeats(rows))
    assert sum(r.n_removed == r.n_bytes for r in got) == 299


def test_run_packs_are_small():
    keys = [b"\0" + b"common prefix of many suffixes " + b"%05d" % i for i in range(5000)]
    packed = op13_suffixes._front_coded(keys, [b""] * 5000, np.arange(5000))
    assert len(packed) < 0.4 * sum(map(len, keys)) and op13_suffixes.Run(packed).keys == keys
