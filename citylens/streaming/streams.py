"""Streaming operators (ST-1 .. ST-5).

The batch jobs re-scan a trailing window on a schedule; here the same
products are incremental queries: event-time watermarks bound state, and
append mode emits a window only once it can no longer change.  Sources and
sinks are files; checkpoints live under ``spark.checkpoint.dir`` so a
restarted query (or a lost executor) resumes exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylens.functions import hexgrid as H
from citylens.session import scratch_path, use_utc
from citylens.sources import upsert as U
from citylens.sources.fixtures import read_table, spark_text, tables_of


# ------------------------------------------------------------------ sources / sinks
def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a file stream (schema taken from the files)."""
    # A file stream lists a folder or a glob; a one-character class turns a
    # single-file table into a glob that matches exactly that table.
    path = f"{sf_dir.rstrip('/')}/{name}.parque[t]"
    r = spark.readStream.schema(read_table(spark, sf_dir, name).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def stream_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A fixture view over streaming sources (same SQL as the batch view)."""
    use_utc(spark)
    return spark.sql(spark_text(view), **{t: stream_table(spark, sf_dir, t) for t in tables_of(view)})


def run_available_now(df: DataFrame, name: str, mode: str = "append", path: str | None = None,
                      timeout_s: int | None = None) -> str:
    """Process everything currently available, write it to Parquet, stop.

    Waits until the backlog is done (``timeout_s`` may bound the wait).
    Returns the sink folder (read it back as a batch table)."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"stream-{name}")
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", path).option("checkpointLocation", path + "-ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception():
        raise q.exception()
    return path


def run_foreach_batch(df: DataFrame, name: str, fn: Callable[[DataFrame, int], None],
                      timeout_s: int | None = None, checkpoint: str | None = None) -> None:
    spark = df.sparkSession
    ck = checkpoint or scratch_path(spark, f"stream-{name}-ckpt")
    q = df.writeStream.foreachBatch(fn).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception():
        raise q.exception()


# ------------------------------------------------------------------ operators
def stream_dwell(pings: DataFrame, watermark: str = "1 hour", window: str = "15 minutes",
                 grid: H.HexGrid = H.COARSE) -> DataFrame:
    """Dwell and ping count per (trip, route, cell, tumbling window) (ST-1)."""
    p = H.with_cell(pings.select("trip_id", "route_id", "obs_ts", "obs_epoch", "latitude", "longitude"),
                    "latitude", "longitude", "cell", grid)
    g = p.withWatermark("obs_ts", watermark).groupBy("trip_id", "route_id", "cell", F.window("obs_ts", window))
    out = g.agg((F.max("obs_epoch") - F.min("obs_epoch")).alias("dwell_time"), F.count(F.lit(1)).alias("n_pings"))
    return out.select("trip_id", "route_id", "cell", F.unix_timestamp("window.start").alias("window_start"),
                      F.unix_timestamp("window.end").alias("window_end"), "dwell_time", "n_pings")


def stream_density(pings: DataFrame, size: str, slide: str, watermark: str = "1 hour",
                   grid: H.HexGrid = H.COARSE) -> DataFrame:
    """Pings per cell over sliding windows (ST-2)."""
    p = H.with_cell(pings.select("obs_ts", "latitude", "longitude"), "latitude", "longitude", "cell", grid)
    g = p.withWatermark("obs_ts", watermark).groupBy("cell", F.window("obs_ts", size, slide))
    out = g.agg(F.count(F.lit(1)).alias("count"))
    return out.select("cell", F.unix_timestamp("window.start").alias("window_start"),
                      F.unix_timestamp("window.end").alias("window_end"), "count")


def sessions(pings: DataFrame, gap: str, watermark: str = "1 hour",
             keys: tuple[str, ...] = ("trip_id", "vehicle_label")) -> DataFrame:
    """Bursts of messages per tracker split by a silence of ``gap`` (ST-3)."""
    g = pings.withWatermark("obs_ts", watermark).groupBy(*keys, F.session_window("obs_ts", gap))
    out = g.agg(F.count(F.lit(1)).alias("n_messages"), F.min("obs_epoch").alias("first_epoch"),
                F.max("obs_epoch").alias("last_epoch"))
    return out.select(*keys, F.unix_timestamp("session_window.start").alias("session_start"),
                      F.unix_timestamp("session_window.end").alias("session_end"),
                      "n_messages", "first_epoch", "last_epoch")


def stream_latest(readings: DataFrame, keys: list[str], order: list[str], name: str = "latest",
                  path: str | None = None, bucket_rows: int = U.BUCKET_ROWS) -> str | None:
    """Newest row per key kept across micro-batches (ST-4).

    Every micro-batch is merged into an upsert table (:mod:`citylens.sources.upsert`)
    and committed as the version of its batch id.  A restarted query that runs
    its last batch again finds it committed, or the table as it was before.  A
    stored bucket that cannot be read fails the batch.  Returns the table's
    folder for :func:`read_latest`, or ``None`` when nothing new was committed.
    """
    base = path or scratch_path(readings.sparkSession, f"stream-{name}")
    ran: list[int] = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        if U.merge(batch, base, keys, order, batch_id, bucket_rows):
            ran.append(batch_id)

    run_foreach_batch(readings, name, merge, checkpoint=f"{base}-ckpt")
    return base if ran else None


def read_latest(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame | None:
    """Rows of a :func:`stream_latest` table (of a kept version); ``None`` if there is none yet, any other failure is raised."""
    return U.read_upserted(spark, path, schema, version)


def dedup_stream(src: DataFrame, key: str, ts: str = "obs_ts", watermark: str = "1 hour") -> DataFrame:
    """Repeated message ids dropped within the watermark (ST-5)."""
    return src.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])
