"""Trailing windows from stored partial aggregates (P-2, P-6, P-11 without re-reading).

A job that runs every hour over the last weeks need not read the weeks again:
each run aggregates the hours that are new to mergeable partials, stores them
by hour, drops the hours that have left the window, and the product merges the
hours that are there.  Partials:

* pings per cell (P-11): counts add up;
* first ping, last ping and number of pings per (trip, route, cell) (P-6): the
  dwell of a group is the span over its hours, and the group's newest ping,
  which P-6 leaves out, lies in its newest hour;
* a KLL sketch of the delays per trip (P-2, AG-11, W-6): sketches merge, the
  median's rank error stays within the sketch's bound (exact up to ``k`` values).

Windows are whole hours, ``[end - hours, end)``.  An hour is stored as one
folder and replaced as a whole when it is read again; the last ``reopen``
hours before a run are, so that late pings count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylens.functions import hexgrid as H
from citylens.functions.timeutil import hour_of_week
from citylens.operators.clean import drop_null_rows
from citylens.plans.dwell import DWELL_KEYS, fit_slot_lasso
from citylens.session import delete_folder, list_names, path_exists, write_text
from citylens.sources.scans import scan_window

HOUR = 3600
#: Accuracy of the delay sketches: values a sketch keeps about.
SKETCH_K = 200


def _hour() -> Column:
    return F.expr(f"obs_epoch - pmod(obs_epoch, {HOUR})").alias("hour")


# ------------------------------------------------------------------ partials of a stretch of pings
def density_partials(pings: DataFrame, grid: H.HexGrid = H.COARSE) -> DataFrame:
    """Pings per (cell, hour), of the pings that P-11 counts."""
    p = drop_null_rows(pings.select("ping_id", "trip_id", "route_id", "license_plate", "obs_epoch", "latitude", "longitude"))
    return H.with_cell(p, "latitude", "longitude", "cell", grid).groupBy("cell", _hour()).agg(F.count("*").alias("n"))


def dwell_partials(pings: DataFrame, grid: H.HexGrid = H.COARSE) -> DataFrame:
    """First and last ping and number of pings per (trip, route, cell, hour), of the pings that P-6 learns from."""
    p = drop_null_rows(pings.select("ping_id", "obs_epoch", "trip_id", "route_id", "trip_direction", "license_plate", "latitude", "longitude"))
    return H.with_cell(p, "latitude", "longitude", "cell", grid).groupBy(*DWELL_KEYS, _hour()).agg(
        F.min("obs_epoch").alias("first_ping"), F.max("obs_epoch").alias("last_ping"), F.count("*").alias("n"))


def delay_partials(pings: DataFrame) -> DataFrame:
    """A sketch of the delays per (trip, hour)."""
    p = pings.where("trip_id is not null and trip_delay is not null")
    return p.groupBy("trip_id", _hour()).agg(F.kll_sketch_agg_double("trip_delay", F.lit(SKETCH_K)).alias("sketch"))


# ------------------------------------------------------------------ the store
def advance(pings: DataFrame, path: str, end: int, hours: int, partials: Callable[[DataFrame], DataFrame], reopen: int = 1) -> int:
    """Bring the partials under ``path`` to the window of ``hours`` before ``end`` (a whole hour).

    Only pings from the returned epoch on are read (a bound on the event
    time, so it reaches the scan).  A repeated run replaces the hours it reads.
    """
    spark = pings.sparkSession
    end -= end % HOUR
    start = end - hours * HOUR
    done = [int(n.rpartition("/")[2]) for n in list_names(spark, f"{path}/_runs/*")]
    since = max(start, min(end, max(done)) - reopen * HOUR) if done else start
    fresh = partials(scan_window(pings, "obs_epoch", since, end, closed=False))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour").parquet(path)
    for folder in list_names(spark, f"{path}/hour=*"):
        if int(folder.rpartition("=")[2]) < start:
            delete_folder(spark, folder)
    if not path_exists(spark, f"{path}/_runs/{end}"):
        write_text(spark, f"{path}/_runs/{end}", str(since))
    return since


def window_partials(spark: SparkSession, path: str, end: int, hours: int, like: DataFrame) -> DataFrame:
    """The stored partials of the window (columns as in ``like``); only its hours' folders are read."""
    end -= end % HOUR
    if not list_names(spark, f"{path}/hour=*"):
        return like.where("false")
    return spark.read.schema(like.schema).parquet(path).where(F.col("hour").between(end - hours * HOUR, end - HOUR))


# ------------------------------------------------------------------ products of the stored partials
def density_of(partials: DataFrame) -> DataFrame:
    """Pings per cell (the counts of P-11)."""
    return partials.groupBy("cell").agg(F.sum("n").alias("count"))


def slot_means_of(partials: DataFrame) -> DataFrame:
    """Mean dwell per (cell, route, hour-of-week), as ``slot_means`` of the window's pings."""
    spans = partials.groupBy(*DWELL_KEYS).agg((F.max("last_ping") - F.min("first_ping")).alias("dwell"), F.max("hour").alias("newest"))
    rows = partials.join(spans, DWELL_KEYS).withColumn("kept", F.col("n") - (F.col("hour") == F.col("newest")).cast("long"))
    rows = rows.where("kept > 0").withColumn("time_slot", hour_of_week("hour"))
    return rows.groupBy("cell", "route_id", "time_slot").agg(
        (F.sum(F.col("dwell") * F.col("kept")).cast("double") / F.sum("kept")).alias("dwell_time"))


def dwell_model_of(partials: DataFrame, alpha: float = 1.0) -> DataFrame:
    """P-6 from the stored partials."""
    return fit_slot_lasso(slot_means_of(partials), alpha)


def delay_medians_of(partials: DataFrame, rank: float = 0.5) -> DataFrame:
    """Median (or another rank) of the delays per trip, from the merged sketches, and the number of delays."""
    merged = partials.groupBy("trip_id").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select("trip_id", F.kll_sketch_get_quantile_double("sketch", F.lit(rank)).alias("trip_delay"),
                         F.kll_sketch_get_n_double("sketch").alias("n_delays"))
