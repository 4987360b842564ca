"""Columns of the input that are named like working columns come back untouched; keys that are NULL do not gather; forms."""

from pyspark.sql import functions as F

from citylens.llm import op3_mixing, op4_exact_dedup, op6_urls, op7_simhash, op8_secrets, op9_decontaminate, op10_html
from tests.llm.conftest import documents

NAMES = ["_r_key", "_r_id", "_r_spans", "_r__r_id", "own_key", "OWN_ID", "own_id_", "other_key", "other_id", "Spans", "sha", "root", "component_id", "i"]
TEXT = "one two three four five six seven eight nine ten eleven"
ROWS = [(1, "a b c"), (2, "a b c"), (2, "a b c"), (None, "x y z"), (None, "x y z"), (3, None), (4, ""), (5, "before " + TEXT + " after"), (6, TEXT)]


def named(spark):
    docs = documents(spark, ROWS).select("doc_id", "text", "lang", "source", "n_chars")
    return docs.withColumns({n: F.concat(F.lit(f"{n}="), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES})


def untouched(df, docs):
    assert df.columns == docs.columns
    rows = df.collect()
    assert rows and all(r[n] == f"{n}={'none' if r.doc_id is None else r.doc_id}" for r in rows for n in NAMES)
    return rows


def test_row_returning_forms_keep_all_columns(spark):
    docs = named(spark)
    bench = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    kept = untouched(op4_exact_dedup.drop_exact_duplicates(docs), docs)
    assert sorted((r.text or "") for r in kept) == sorted({t or "" for _, t in ROWS})
    untouched(op7_simhash.drop_near_duplicates(docs), docs)
    assert len(untouched(op9_decontaminate.drop_contaminated(docs, bench), docs)) == len(ROWS) - 2
    cut = untouched(op9_decontaminate.remove_contaminated_spans(docs, bench), docs)
    assert {r.text for r in cut if r.doc_id in (5, 6)} == {"before  after", ""}
    mixed = op3_mixing.mix_documents(docs.withColumn("MIX_hash", F.lit("mine")))
    assert mixed.columns == [*docs.columns, "mix_epoch", "mix_take_tokens"]
    untouched(mixed.drop("mix_epoch", "mix_take_tokens"), docs)


def test_texts_without_parts_do_not_gather(spark):
    rows = [(i, f"plain text number {i}") for i in range(400)] + [(1000, "login = bob99 then pwd: hunter2 end")]
    out = op8_secrets.find_secrets(documents(spark, rows).repartition(8))
    assert out.count() == 401
    places = out.where("doc_id < 1000").groupBy(F.spark_partition_id()).count().collect()
    assert len(places) > 2 and max(r["count"] for r in places) < 300
    assert "login:0:13" in out.where("doc_id = 1000").first().spans


def test_form_around_an_article_keeps_it(spark):
    page = "<body><form id='aspnetForm'><nav>menu</nav><article><h1>Title</h1><p>Body text.</p><form>Write a comment <input></form></article></form></body>"
    plain = "<body><article><p>Body text.</p></article><form><p>Sign up here</p></form></body>"
    lines = [[line for _, line in op10_html.blocks(p)] for p in (page, plain)]
    assert lines == [["Title", "Body text."], ["Body text."]]


def test_long_urls_ask_for_few_keys(spark):
    long = ".".join(["a"] * 16_000) + ".example.net"
    urls = [(1, f"http://{long}/en/x"), (2, f"http://{long}/" + "p" * 100_000), (3, "http://a.org/fr/")]
    assert len(op6_urls.candidate_keys(long, "/en/x", [1, 4], [1, 2])) == 5
    got = {r.page_id: (r.rule, r.verdict) for r in op6_urls.judge(spark.createDataFrame(urls, "page_id long, url string"), op6_urls.default_rules(spark),
                                                                 spark.createDataFrame([], "url string")).collect()}
    assert got == {1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: ("org/fr/", "allow")}
