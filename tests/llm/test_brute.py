"""Operators that SQL cannot express, against brute force, planted cases and held-out labels."""

import random

import numpy as np
import pytest

from citylens.llm import op1_licenses, op2_langid, op5_quality, op7_simhash, op10_html
from citylens.llm.components import connected_components
from citylens.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import EDGE_ROWS, documents

SF = "/root/testdata/sf0.001"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("prefix", [4, 7, 11])
def test_ball_hashing_finds_all_links(spark, prefix):
    rng = random.Random(prefix)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(450):                              # chains and balls around them
        x = rng.choice(fps)
        for _ in range(rng.randint(1, 5)):
            x ^= 1 << rng.choice([rng.randrange(64), 63 - rng.randrange(prefix + 1)])
        fps.append(x)
    fps = sorted(set(fps), key=signed)
    forest = op7_simhash.links(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), prefix, max_variants=5_000)
    roots = {r.node: r.root for r in connected_components(forest).collect()}
    want = [signed(fps[r]) for r in brute.components(fps)]
    assert [roots.get(signed(x), signed(x)) for x in fps] == want


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(path + star, "u long, v long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}


def check_simhash(rows, out):
    fps = [brute.simhash(r[1]) for r in rows]
    comp = brute.components(fps)
    ids = {}
    for (i, *_), c in zip(rows, comp):
        ids.setdefault(c, []).append(i)
    least = {c: min((i for i in v if i is not None), default=None) for c, v in ids.items()}
    want = [(r[0], f"{f:016x}", least[c]) for r, f, c in zip(rows, fps, comp)]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)
    return len(ids)


def near_copies(rng, text, n):
    words = text.split()
    for _ in range(n):
        w = list(words)
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10 ** 6)}"
        yield " ".join(w)


def test_simhash_edges_and_near_copies(spark):
    rng = random.Random(1)
    base = " ".join(f"word{rng.randrange(500)}" for _ in range(900))
    rows = EDGE_ROWS + [(100 + i, t) for i, t in enumerate(near_copies(rng, base, 60))]
    docs = documents(spark, rows)
    n = check_simhash(rows, op7_simhash.near_duplicates(docs).collect())
    kept = op7_simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == n < len(rows) - 30


def test_simhash_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_simhash(rows, QUERIES["op7_simhash"](spark, SF).collect())


def test_simhash_empty(spark, no_docs):
    assert op7_simhash.near_duplicates(no_docs).count() == 0
    assert op7_simhash.drop_near_duplicates(no_docs).count() == 0


def test_licenses_planted_and_brute(spark, edge_docs):
    name, text = "MIT", op1_licenses.TEMPLATES["MIT"]
    words = text.split()
    edited = " ".join(w for i, w in enumerate(words) if i % 23 != 5)
    rows = [(1, f"noise before it. {text} noise after"), (2, f"intro {edited} end"), (3, " ".join(words[:30])), (4, " ".join(reversed(words))),
            (5, "x RELEASED  under -- the mit license y"), (6, None), (5, "x RELEASED  under -- the mit license y"), (7, f"é漢 {text}\n{text}")]
    got = {}
    for r in op1_licenses.scan_licenses(documents(spark, rows)).collect():
        got.setdefault((r.doc_id, r.license), []).append(r)
    at = f"noise before it. {text}".index(words[0])
    assert got[1, name][0].coverage == 1.0 and got[1, name][0].spans == f"{at}:{at + len(text) - 1}"
    assert 0.9 < got[2, name][0].coverage < 1.0
    assert (3, name) not in got and (4, name) not in got
    assert len(got[5, "MIT-notice"]) == 2 and got[5, "MIT-notice"][0].spans == "2:36"
    assert got[7, name][0].n_spans == 2
    assert op1_licenses.scan_licenses(edge_docs).count() == 0
    notice = op1_licenses.TEMPLATES["MIT-notice"]
    again = op1_licenses.scan_licenses(documents(spark, [(1, " ".join([notice] * 9))])).collect()
    assert [(r.license, r.n_spans, r.spans.split(",")[1]) for r in again] == [("MIT-notice", 9, f"{len(notice) + 1}:{2 * len(notice)}")]


def test_licenses_in_blocks_of_templates(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = sorted(map(tuple, op1_licenses.scan_licenses(docs).collect()))
    monkeypatch.setattr(op1_licenses, "MAX_TEMPLATE_WORDS", 40)
    assert len(op1_licenses._blocks(op1_licenses.TEMPLATES)) > 3
    assert sorted(map(tuple, op1_licenses.scan_licenses(docs).collect())) == whole


def test_license_lines_of_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    notices = ["GPL-3.0-notice", "CC-BY-NC-4.0-notice", "MIT-notice", "Apache-2.0-notice"]
    want = {(r.doc_id, n) for r in docs.collect() for n in notices
            if " ".join(brute.words(op1_licenses.TEMPLATES[n])) in " ".join(brute.words(r.text))}
    assert {(r.doc_id, r.license) for r in QUERIES["op1_licenses"](spark, SF).collect()} == want and want


def test_phrases_are_longest_matches():
    rng = random.Random(3)
    for _ in range(30):
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 80)))
        model = op2_langid.Model({"x": " a" + text})
        alphabet = model.alphabet
        for _ in range(20):
            word = "".join(rng.choice("abcd ") for _ in range(rng.randint(1, 12)))
            assert model.automata[0].phrases([alphabet.get(c, -1) for c in word]) == brute.phrases(" a" + text, word)


def test_language_accuracy_and_edges(spark, edge_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    out = QUERIES["op2_langid"](spark, SF).collect()
    held = [r for r in out if r.held_out]
    assert len(out) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    got = {(r.doc_id, r.lang_pred) for r in op2_langid.identify(edge_docs.unionByName(documents(spark, [tuple(r[:4]) for r in docs.collect()]))).collect()}
    strange = documents(spark, [(1, "漢字仮名交じり文の例 ελληνικό κείμενο"), (2, "The and of it"), (3, "x")])
    labelled = documents(spark, [tuple(r[:4]) for r in docs.collect()])
    kept = {(r.doc_id, r.text) for r in op2_langid.keep_identified(strange.unionByName(labelled)).collect()}
    assert (1, "漢字仮名交じり文の例 ελληνικό κείμενο") not in kept and (2, "The and of it") in kept
    assert {(r.doc_id, r.text) for r in docs.collect()} <= kept
    assert {(3, "und"), (4, "und"), (6, "und"), (8, "und"), (None, "und")} <= got


def test_training_sample_is_the_first_ids_in_hash_order(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "case when id % 50 = 0 then 'xx' else 'en' end as lang")
    rows = rows.unionByName(spark.range(3000).selectExpr("7L as doc_id", "'one' as lang"))
    got = {}
    for lang, i in op2_langid._first_ids(rows, 40):
        got.setdefault(lang, []).append(i)
    for lang in ("en", "xx"):
        want = rows.where(f"lang = '{lang}'").distinct().selectExpr("doc_id", "shiftrightunsigned(xxhash64(doc_id), 1) as h").orderBy("h").limit(40)
        assert got[lang] == [r.doc_id for r in want.collect()]
    assert got["one"] == [7]


def test_language_without_labels(spark, edge_docs, no_docs):
    from pyspark.sql import functions as F

    assert {r.lang_pred for r in op2_langid.identify(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert op2_langid.identify(no_docs).count() == 0 and op2_langid.keep_identified(no_docs).count() == 0
    assert op2_langid.keep_identified(edge_docs).columns == edge_docs.columns


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in QUERIES["op5_quality"](spark, "/root/testdata/sf0.01").collect()]
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and sum(r.quality_pred == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, score double")
    assert {r.score for r in op5_quality.score_quality(edge_docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert len(op5_quality.score_quality(edge_docs, one).collect()) == len(EDGE_ROWS)
    assert op5_quality.score_quality(no_docs, one).count() == 0


def test_co_training_uses_both_views():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    views = [y[:, None] * 2.0 + rng.normal(size=(400, 3)), y[:, None] * 1.0 + rng.normal(size=(400, 2))]
    truth = rng.integers(0, 2, 600)
    pool = [truth[:, None] * 2.0 + rng.normal(size=(600, 3)), truth[:, None] * 1.0 + rng.normal(size=(600, 2))]
    both, text, meta = op5_quality.CoTrained(views, y, pool).score(*pool)
    accuracy = [np.mean((p >= 0.5) == truth) for p in (both, text, meta)]
    assert accuracy[0] >= max(accuracy[1:]) - 0.01 and accuracy[0] > 0.9


PAGE = ("<html><head><title>t</title><style>p{}</style></head><body><header>top</header><nav><a>x</a></nav><div class='cookie-notice'>c</div>"
        "<article><header>by me</header><h1>A &amp; B</h1><p>one\n two<br>three <b>bold</b>x<p>four &lt;5 &#233;<ul><li>i<li>ii</ul>"
        "<div class='ad'>buy</div><aside>s</aside><form>f<input></form><script>var a='<p>no</p>'</script><section id='comments'><p>nice</p></section>"
        "<p>last</article><footer>f</footer></body>")


def test_html_blocks():
    assert [t for place, t in op10_html.blocks(PAGE) if place == op10_html.ARTICLE] == [
        "A & B", "one two three boldx", "four <5 é", "i", "ii", "last"]
    assert op10_html.blocks(None) == op10_html.blocks("") == []
    assert op10_html.blocks("a < b <") == [(0, "a < b <")]
    page = "<body><p title='a hidden class=ad role'>x</p><p hidden>h</p><p aria-hidden=true>h</p><div class='post-body'><p>y<article class='comment'>no</article><article class='post has-sidebar'>z</article></div>"
    assert op10_html.blocks(page) == [(op10_html.OPEN, "x"), (op10_html.CONTAINER, "y"), (op10_html.ARTICLE, "z")]
    assert op10_html.blocks("<p title='x > y'>q</p><!-- <p>no</p> --><p data-x=\"un>closed</p>r") is not None


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        got = sorted(op10_html.shared(a, b))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert len(got) == table[-1][-1]
        rest = iter(b)
        assert all(a[i] in rest for i in got)


def test_pages_of_the_tables(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = QUERIES["op10_html"](spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r.url == pages[r.page_id].url and r.text == brute.article_text(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_pages_without_article_lose_shared_lines(spark):
    body = "<body><p>Welcome to us</p><p>{}</p><p>{}</p><p>All rights</p></body>"
    rows = [(1, "http://h.org/a/1", body.format("one", "uno")), (2, "http://h.org/a/2", body.format("two", "due")), (3, "http://h.org/b/3", body.format("three", "tre")),
            (4, "http://alone.org/", body.format("four", "quattro")), (5, None, body.format("five", "cinque")), (6, "http://h.org/a/0", None), (None, "http://z.org", PAGE),
            (7, "http://same.org/x", body.format("same", "same")), (7, "http://same.org/x", body.format("same", "same"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "1 as at", "2 as tie", "'p' as path")
    got = {}
    for r in op10_html.main_text(pages).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[2] == ["two\ndue"] and got[3] == ["three\ntre"] and got[4] == ["Welcome to us\nfour\nquattro\nAll rights"]
    assert got[1] == ["Welcome to us\none\nuno\nAll rights"] and got[6] == [""]        # nearest page before 1 is empty
    assert got[5] == ["Welcome to us\nfive\ncinque\nAll rights"] and got[7] == ["", ""] and got[None][0].startswith("A & B")
    assert op10_html.main_text(pages.where("false")).count() == 0


def test_open_pages_meet_the_nearest_page_with_lines(spark):
    body = "<body><p>Welcome to us</p>{}<p>All rights</p></body>"
    rows = [(1, "http://m.org/a", body.format("<article><p>story one</p></article>")), (2, "http://m.org/b", body.format("<p>open two</p>")),
            (3, "http://e.org/a", "<body><nav>x</nav></body>"), (4, "http://e.org/b", body.format("<p>open four</p>")), (5, "http://e.org/c", ""),
            (6, "http://e.org/d", body.format("<p>open six</p>"))]
    got = {r.page_id: r.text for r in op10_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "story one", 2: "open two", 3: "", 4: "open four", 5: "", 6: "open six"}


def test_copies_of_a_page_keep_their_article(spark):
    body = "<body><p>Welcome to us</p>{}<p>All rights</p></body>"
    story = [f"line {i} of a story that many pages carry" for i in range(20)]
    near = [*story[:9], "line 9 edited", *story[10:]]
    full = lambda lines: body.format("".join(f"<p>{x}</p>" for x in lines))
    rows = ([(i, f"http://c.org/a?x={i}", full(story)) for i in range(5)] + [(5, "http://c.org/a?x=5", full(near)), (6, "http://c.org/b", full(["other"]))]
            + [(10 + i, f"http://c.org/k?x={i}", full(story)) for i in range(3)] + [(20, "http://d.org/1", full(story)), (21, "http://d.org/2", full(near))])
    got = {r.page_id: r.text for r in op10_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    alone = lambda lines: "\n".join(["Welcome to us", *lines, "All rights"])
    want = {**{i: "\n".join(story) for i in (*range(5), 10, 11, 12)}, 5: "\n".join(near), 6: "other", 20: alone(story), 21: alone(near)}
    assert got == want


@pytest.mark.parametrize("block", [1, 12])
def test_runs_of_copies_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(op10_html, "RUN_BLOCK", block)
    names = "aaaaabbcaaaaaaaaad"
    rows = [(i, "h" if i < 14 else "k", i, "u", i, [x * 9]) for i, x in enumerate(names)]
    placed = spark.createDataFrame(rows, "page_id long, host string, at long, url string, tie long, lines array<string>")
    want, start = {}, 0
    for i, x in enumerate(names):
        start = i if not i or i == 14 or names[i - 1] != x else start
        want[i] = start
    assert {r["at"]: r["start"] for r in op10_html._with_runs(placed).collect()} == want


def test_class_names_of_wrappers_do_not_empty_the_page():
    story = "<article><h1>Title</h1><p>the story of the page</p></article>"
    lines = [(op10_html.ARTICLE, "Title"), (op10_html.ARTICLE, "the story of the page")]
    for wrapper in ('div class="layout has-sidebar"', 'div id="page" class="with-menu"', 'section class="social-science"', 'div class="no-nav"',
                    'div class="layout-sidebar"', 'div class="sidebar"', 'div class="share-buttons"', 'div class="page-header"'):
        assert op10_html.blocks(f"<body><div class='site-footer'>f</div><{wrapper}>{story}</{wrapper.split()[0]}>") == lines, wrapper
    for wrapper in ('div class="sidebar-left"', 'div class="site-header"', 'div id="cookie-banner"', 'div class="post-comments"', "div class='ad-slot-3'",
                    "div class='main-nav'", "div class='related-posts'", "ul class='menu'"):
        assert op10_html.blocks(f"<body><{wrapper}><p>x</p></{wrapper.split()[0]}>{story}") == lines, wrapper
    for wrapper in ('div class="comments"', 'div class="related"', "aside", "div class='ads'"):       # what these hold is never the main text
        assert op10_html.blocks(f"<body><p>open body</p><{wrapper}>{story}</{wrapper.split()[0]}>") == [(op10_html.OPEN, "open body")], wrapper
    teaser = "<div class='sidebar'><article>a teaser</article></div>"
    assert op10_html.blocks(teaser + story) == lines and op10_html.blocks(f"{teaser}<p>a body of more text</p>") == [(0, "a body of more text")]


def test_edited_short_notices_are_found_as_by_full_alignment(spark):
    from itertools import combinations

    from citylens.llm.tokens import words

    rows, want = [], set()
    index = op1_licenses.TemplateIndex(op1_licenses.TEMPLATES)
    for name, text in op1_licenses.TEMPLATES.items():
        template = text.split()
        if len(words(text)) >= 2 * (op1_licenses.GRAM + op1_licenses.WINNOW):
            continue
        for k in (1, 2):
            for places in combinations(range(len(template)), k):
                for edit in (lambda w: ["xx"], lambda w: [], lambda w: [w, "xx"]):
                    edited = [x for i, w in enumerate(template) for x in (edit(w) if i in places else [w])]
                    rows.append((len(rows), " ".join(["noise", "of", "the", *edited, "and", "the", "rest"])))
    rows += [(len(rows), "Distributed under the MIT License"), (len(rows) + 1, "Released under an MIT licence"), (len(rows) + 2, "Released under a MIT License")]
    for i, text in rows:
        ids = np.array([index.vocabulary.get(w, -1) for w in words(text)])
        for name, template in zip(index.names, index.words):
            if len(template) < 14 and len(op1_licenses.align(template, ids, -len(template), len(ids))) >= 0.8 * len(template):
                want.add((i, name))
    got = {(r.doc_id, r.license) for r in op1_licenses.scan_licenses(documents(spark, rows)).collect()}
    n = len(rows)
    assert got == want and {(n - 3, "MIT-notice"), (n - 1, "MIT-notice")} <= got and (n - 2, "MIT-notice") not in got


@pytest.mark.parametrize("most", [300, 20_000])
def test_a_family_of_near_copies_is_dealt_to_bounded_keys(spark, most):
    from pyspark.sql import functions as F

    rng = random.Random(most)
    base = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(30)}
    while len(fps) < 400:
        x = base
        for _ in range(rng.randint(0, 7)):
            x ^= 1 << rng.choice([rng.randrange(64), rng.randrange(28, 36)])
        fps.add(x)
    fps = sorted(fps, key=signed)
    table = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    last = 0
    for bits, rows in op7_simhash.dealt_levels(table, 4, most):
        low, last = 64 - bits, bits
        cost = F.expr(f"case when shiftrightunsigned(fp, {low}) = key then {1 + low + low * low // 4} else 33 end")
        assert not low or (rows.groupBy("key").agg(F.sum(cost).alias("n")).agg(F.max("n")).first()[0] or 0) <= most
    assert last == 64 if most == 300 else 10 <= last <= 64
    roots = {r.node: r.root for r in connected_components(op7_simhash.links(table, 4, most)).collect()}
    assert [roots.get(signed(x), signed(x)) for x in fps] == [signed(fps[r]) for r in brute.components(fps)]


def test_variants_by_any_prefix_are_the_same():
    rng = random.Random(9)
    fps = np.array([rng.getrandbits(64) for _ in range(4)], dtype=np.uint64)
    for f in fps:
        odd, all_bits = int(f).bit_count() & 1, range(64)
        pairs = [(i, j) for i in all_bits for j in range(i) if i // 32 == j // 32] if odd else []
        want = {int(f)} | {int(f) ^ 1 << i for i in all_bits} | {int(f) ^ (1 << i | 1 << j) for i, j in pairs}
        for prefix in (4, 16, 28, 34, 40, 58, 64):
            keys = np.array(sorted({v >> (64 - prefix) for v in want}), dtype=np.uint64)
            got, _, flips = op7_simhash._variants(np.full(keys.size, f), keys, prefix)
            assert sorted(map(int, got)) == sorted(want), prefix
            assert all((int(v) ^ int(f)).bit_count() == n for v, n in zip(got, flips))


def test_the_whole_unlabelled_pool_takes_part(spark):
    from functools import partial

    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, 12 + i % 7)) + ("!" * 5 if i % 2 else ""), "en", f"src{i % 2}") for i in range(4_600)]
    docs = documents(spark, [*rows, rows[7], (None, "x")]).select("doc_id", "text", "source", "lang", "n_chars")
    known = spark.createDataFrame([(i,) for i in range(100)], "doc_id long")
    pool = op5_quality.SparkPool(docs, known)
    assert pool.size == 4_500
    x = [v.astype(np.float32).astype(np.float64) for v in op5_quality._features([r for r in docs.where("doc_id >= 100").orderBy("doc_id").collect()])]
    y = (np.arange(4_500) % 2).astype(float)
    views = [op5_quality.Logistic(v[:80], y[:80], np.ones(80)) for v in x]
    local = op5_quality.LocalPool(x)
    local.fine = np.array([r.f for r in docs.where("doc_id >= 100").orderBy("doc_id").selectExpr("int(pmod(xxhash64(doc_id), 64)) as f").collect()])
    first = op5_quality.Round([m.beta for m in views])
    counts = [p.total(partial(op5_quality._count, views, [first], 0)) for p in (pool, local)]
    assert np.array_equal(*counts) and counts[0].sum() > 4_000
    first.cuts = [[op5_quality._cut(c, 225) for c in counts[0].reshape(2, -1)]]
    to, label = op5_quality._handed([first], [m._design(v) for m, v in zip(views, x)], local.fine)
    assert 300 < (to == 1).sum() <= 450 and np.array_equal(label[to == 1], y[to == 1])
    assert np.allclose(*(p.total(partial(op5_quality._sums, views, [first])) for p in (pool, local)))


def test_the_outermost_content_element_holds_the_text(spark):
    body = "<p>a body of many words</p><p>and more of them</p>"
    rows = [(1, "<main><h1>Title</h1><p>lead</p><article>body</article></main><p>out</p>"), (2, f"<article>teaser</article><div class='content'>{body}</div>"),
            (3, f"<article>{body}</article><div class='content'>less</div>"), (4, "<article>one</article><p>x</p><article>two</article>")]
    pages = spark.createDataFrame([(i, f"http://h{i}.org/", f"<body>{x}</body>") for i, x in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in op10_html.main_text(pages).collect()}
    assert got == {1: "Title\nlead\nbody", 2: "a body of many words\nand more of them", 3: "a body of many words\nand more of them", 4: "one\ntwo"}
