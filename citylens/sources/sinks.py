"""Sinks: append-only history, rerun-safe upsert, model table (SNK-1 .. SNK-3).

Paths live under the shared checkpoint folder (``spark.checkpoint.dir``)
or wherever the caller points; nothing is written to machine-local
temporary folders.  Writes are atomic per job (Spark's commit protocol),
so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylens.functions.timeutil import date_text
from citylens.operators.windows import latest_per_key
from citylens.session import delete_folder, move_folder, path_exists, scratch_path


def commit_run(df: DataFrame, path: str, run_date: str, run: str | int) -> None:
    """The rows of one run as folder ``run_date=<day>/run=<key>`` of a history: staged, then put in place.

    A rerun (a retry, a second load of a day) replaces the rows of its own run
    and no others.  Rows are written beside the history first, under a name that
    readers skip; only a finished write is renamed into place, so readers never
    see a part of a run.  A crash between the two renames leaves the run out
    until its retry, never doubled.
    """
    spark = df.sparkSession
    staged, old, final = f"{path}/_staged-{uuid.uuid4().hex}", f"{path}/_replaced-{uuid.uuid4().hex}", f"{path}/run_date={run_date}/run={run}"
    df.write.parquet(staged)
    if path_exists(spark, final):
        move_folder(spark, final, old)
    move_folder(spark, staged, final)
    delete_folder(spark, old)


def append_history(df: DataFrame, path: str, as_of: int, key_cols: list[str] | None = None,
                   key: str = "primary_key", run: str | int | None = None) -> None:
    """Append rows under a never-repeating key (natural key + run epoch),
    partitioned by run date so reads of a day prune to one folder (SNK-1).

    ``run`` names the run within its day (default: its epoch); a repeated run
    replaces its own rows (:func:`commit_run`).
    """
    out = df
    if key_cols:
        out = out.withColumn(key, F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols],
                                              F.lit(str(int(as_of)))))
    commit_run(out, path, date_text(as_of), int(as_of) if run is None else run)


def upsert_by_key(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key across the stored and the incoming rows (SNK-2).

    Top-1 per key: Spark keeps one row per key and task before the shuffle
    (window group limit), so a hot key stays small.  Persist the result to a *new* location
    (or a dynamic partition overwrite of other partitions) — never overwrite
    the input being read.
    """
    both = old.unionByName(new, allowMissingColumns=True)
    return latest_per_key(both, keys, order)


def write_upserted(spark: SparkSession, merged: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write an upsert result; with partitions, only touched ones are replaced."""
    w = merged.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def save_model(model: DataFrame, spark: SparkSession, path: str | None = None) -> str:
    """Store the per-(route, cell) coefficients as a Parquet table (SNK-3)."""
    path = path or scratch_path(spark, "dwell-model")
    model.write.mode("overwrite").parquet(path)
    return path


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
