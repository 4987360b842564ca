"""Shared helpers of the training-data operators: tables, scratch tables, row selection."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylens.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage and survives lost executors; every call takes a fresh folder.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4 (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def free_name(docs: DataFrame, wanted: str) -> str:
    """A name for a working column that ``docs`` does not have (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def keep_one_row_each(docs: DataFrame, verdict: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that ``verdict`` keeps, with the columns of ``docs``.

    ``verdict`` has one row per (id, hash of the text) as ``doc_id``, ``text_key``
    (``xxhash64`` of the text, NULL as empty), ``kept`` and ``n_rows``, the
    number of document rows behind it.  A kept key with several identical rows
    yields one of them.  Only rows that go and the (usually absent) repeated
    keys are joined, so the documents move at most once.
    """
    cols = docs.columns
    key, of, r_key, r_of = (free_name(docs, n) for n in ("own_key", "own_id", "other_key", "other_id"))
    keyed = docs.withColumns({key: F.xxhash64(text_or_empty(text_col)), of: F.col(id_col)})
    special = verdict.where(~F.col("kept") | (F.col("n_rows") > 1)).select(F.col("doc_id").alias(r_of), F.col("text_key").alias(r_key), "kept")

    def met(rows: DataFrame, how: str) -> DataFrame:          # NULL ids meet, too
        rows = rows.select(r_of, r_key)
        return keyed.join(rows, keyed[of].eqNullSafe(rows[r_of]) & (keyed[key] == rows[r_key]), how)

    stay = met(special, "left_anti").select(*cols)
    repeated = special.where("kept")
    if repeated.isEmpty():
        return stay
    return stay.unionByName(met(repeated, "left_semi").dropDuplicates([of, key]).select(*cols))
