"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylens.llm import (
    op1_licenses, op2_langid, op3_mixing, op4_exact_dedup, op5_quality, op6_urls, op7_simhash, op8_secrets, op9_decontaminate,
    op10_html, op11_fim, op12_merkle, op13_suffixes,
)
from citylens.llm.common import materialise, table
from citylens.llm.oracles import ORACLES  # noqa: F401  (re-exported with QUERIES)


def op1_licenses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op2_langid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_langid.identify(table(spark, sf_dir, "documents"))


def op3_mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts are read once for their token counts; the mix itself runs on a narrow table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", op3_mixing.n_tokens().alias("n_tokens"))
    mixed = op3_mixing.mix(materialise(docs, "mix-tokens"), op3_mixing.document_levels(), op3_mixing.WEIGHTS)
    return mixed.select("doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"),
                        F.col("mix_source").alias("source"), F.col("mix_epoch").alias("epoch"), "n_tokens",
                        F.col("mix_take_tokens").alias("take_tokens"))


def op4_exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_urls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return op6_urls.judge(pages, op6_urls.default_rules(spark), op6_urls.pages_of_listed_labels(pages))


def op7_simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_secrets.find_secrets(table(spark, sf_dir, "documents"))


def op9_decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_html.main_text(table(spark, sf_dir, "pages"))


def op11_fim_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_fim.fill_in_middle(table(spark, sf_dir, "documents"))


def op12_merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op12_merkle.manifest(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "siblings"), 256).alias("proof_sha256"),
                       "folded_root", "verified")


def op13_suffixes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op13_suffixes.repeated_strings(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses_query,
    "op2_langid": op2_langid_query,
    "op3_mixing": op3_mixing_query,
    "op4_exact_dedup": op4_exact_dedup_query,
    "op5_quality": op5_quality_query,
    "op6_urls": op6_urls_query,
    "op7_simhash": op7_simhash_query,
    "op8_secrets": op8_secrets_query,
    "op9_decontaminate": op9_decontaminate_query,
    "op10_html": op10_html_query,
    "op11_fim": op11_fim_query,
    "op12_merkle": op12_merkle_query,
    "op13_suffixes": op13_suffixes_query,
}
