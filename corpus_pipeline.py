"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citylens.llm import op2_langid, op3_mixing, op4_exact_dedup, op7_simhash, op9_decontaminate
from citylens.llm.common import materialise, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go (no letters, or none of the learned languages)."""
    return op2_langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return op4_exact_dedup.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays."""
    return op7_simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return op9_decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows selected to the target weights, once per epoch, with ``mix_epoch`` and ``mix_take_tokens``."""
    return op3_mixing.mix_documents(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("simhash", near_dedup),
          ("decontaminate", decontaminate), ("mix", mix)]

#: Language ID learns a model and SimHash links transitively: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
