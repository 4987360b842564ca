"""The corpus pipeline against a brute-force version, and every stage on edge rows."""

import math

import duckdb
import pytest

import corpus_pipeline
from citylens.llm import op2_langid
from citylens.llm.oracles import ORACLES
from tests.llm import brute
from tests.llm.conftest import EDGE_ROWS, documents

SF = "/root/testdata/sf0.001"


def brute_language(rows, model):
    """Rows that some language parses in longer phrases: phrases by plain substring search."""
    texts = {n: t for n, t in model.items()}
    kept = []
    for r in rows:
        words = op2_langid.letters(r["text"]) if r["text"] else []
        if not any(c.isalpha() for w in words for c in w):
            continue
        seen, bits, phrases = {}, {}, {}
        for n, t in texts.items():
            total = 0
            for w in words:
                if (n, w) not in seen:
                    seen[n, w] = brute.phrases(t, f" {w} ")
                total += seen[n, w]
            phrases[n], bits[n] = total, total * math.log2(len(t) + 1)
        best = min(sorted(bits), key=lambda n: bits[n])
        if phrases[best] <= 0.8 * sum(len(w) + 2 for w in words):
            kept.append(r)
    return kept


def brute_pipeline(rows, benchmark, training):
    rows = brute_language(rows, training)
    last = {}
    for r in rows:
        if r["text"] not in last or r["doc_id"] > last[r["text"]]:
            last[r["text"]] = r["doc_id"]
    rows = [r for r in rows if last[r["text"]] == r["doc_id"]]
    rows.sort(key=lambda r: r["doc_id"])
    comp = brute.components([brute.simhash(r["text"]) for r in rows])
    rows = [r for i, r in enumerate(rows) if comp[i] == i]               # sorted by id: the first is the smallest
    bad = {d for d, *_, hit in brute.contamination([(r["doc_id"], r["text"]) for r in rows], benchmark) if hit}
    rows = [r for r in rows if r["doc_id"] not in bad]
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", [[r["doc_id"], r["text"], r["lang"], r["source"]] for r in rows])
    return sorted(con.sql(f"select doc_id, epoch, take_tokens from ({ORACLES['op3_mixing']})").fetchall())


@pytest.fixture
def short_training(monkeypatch):
    """A small training text, so that plain substring search is quick; remembered for the brute-force version."""
    seen = {}
    begin, train = op2_langid.Model.__init__, op2_langid.train

    def remember(self, samples):
        seen.clear()
        seen.update(samples)
        begin(self, samples)

    monkeypatch.setattr(op2_langid.Model, "__init__", remember)
    monkeypatch.setattr(op2_langid, "train", lambda *a, **k: train(*a, **{**k, "max_chars": 3000}))
    return seen


def test_pipeline_equals_brute_force(spark, short_training):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "mix_epoch", "mix_take_tokens"]
    got = sorted((r.doc_id, r.mix_epoch, r.mix_take_tokens) for r in out.collect())
    assert got == brute_pipeline(rows, benchmark, dict(short_training)) and got


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "decontaminate", "mix"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_edge_rows(spark, edge_docs, no_docs, name, stage):
    labelled = documents(spark, [(100 + i, f"plain english words number {i} in a row", "en", "src3") for i in range(12)])
    docs = edge_docs.unionByName(labelled)
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns + (["mix_epoch", "mix_take_tokens"] if name == "mix" else [])
    rows = out.collect()
    assert rows and len(rows) <= len(EDGE_ROWS) + 12 or name == "mix"
    assert {100, 111} <= {r.doc_id for r in rows} or name in ("simhash", "mix")
    assert stage(spark, no_docs, SF).collect() == []


def test_repeated_rows_leave_one(spark):
    rows = [(1, "the very same row of text"), (1, "the very same row of text"), (1, "another text of the same id"), (None, "no id"), (None, "no id")]
    stages = dict(corpus_pipeline.STAGES)
    for name in ("exact_dedup", "simhash"):
        kept = [(r.doc_id, r.text) for r in stages[name](spark, documents(spark, rows), SF).collect()]
        assert sorted(kept, key=str) == sorted(set(rows), key=str), name
