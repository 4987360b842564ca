"""Network quality products: coverage black spots, faulty trackers (P-9, P-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.functions import hexgrid as H
from citylens.functions import scalar as S
from citylens.functions.timeutil import observe_time_micros
from citylens.operators.aggregates import global_bounds
from citylens.operators.clean import drop_null_rows
from citylens.operators.joins import existing, unmatched
from citylens.operators.windows import count_over, gap_seconds, surrogate_key
from citylens.session import ensure_checkpoint_dir
from citylens.sources.scans import scan_status, scan_window


def completed_trips(status: DataFrame, window=(None, None), ts: str = "observe_ts") -> DataFrame:
    """Distinct trip ids with a COMPLETED status row in the window (SRC-3)."""
    return scan_status(status, ts, "COMPLETED", *window).select("trip_id").distinct()


def network_black_spots(routes: DataFrame, pings: DataFrame, status: DataFrame, as_of: int,
                        status_window=(None, None), ping_window=(None, None),
                        grid: H.HexGrid = H.COARSE, offset_minutes: int = 330) -> DataFrame:
    """P-9: route points in cells where no completed trip ever reported.

    weight = route points in the cell, bucketed 1..5 between the global
    min and max weight (scalar subqueries).
    """
    done = completed_trips(status, status_window)
    p = existing(scan_window(pings, "obs_epoch", *ping_window), done)
    p = drop_null_rows(p.select("trip_id", "obs_epoch", "route_id", "latitude", "longitude"))
    seen = H.with_cell(p, "latitude", "longitude", "cell", grid).select("cell")
    r = drop_null_rows(routes.select("point_id", "route_id", "latitude", "longitude"))
    r = H.with_cell(r, "latitude", "longitude", "cell", grid)
    # route points in dark cells: bounded by the route network, used three
    # times below (weights, global range, output) -> computed once
    ensure_checkpoint_dir(routes.sparkSession)
    dark = unmatched(r, seen, "cell").checkpoint(eager=True)
    dark = count_over(dark, ["cell"], "route_id", "raw_weight")
    wmin, wmax = global_bounds(dark, "raw_weight")
    dark = H.with_boundary(dark, "cell", "ring", grid)
    return dark.select(
        "cell", "route_id", "latitude", "longitude",
        S.minmax_bucket("raw_weight", wmin, wmax).alias("weight"),
        surrogate_key("cell", "point_id", F.lit(int(as_of))).alias("primary_key"),
        S.ring_text("ring").alias("polygon"),
        S.polygon_json("ring").alias("coordinates"),
        observe_time_micros(as_of, offset_minutes).alias("observe_time"),
    )


def faulty_trackers(pings: DataFrame, status: DataFrame, as_of: int, limit: float = 110,
                    status_window=(None, None), ping_window=(None, None),
                    offset_minutes: int = 330) -> DataFrame:
    """P-10: per (trip, plate) counts of healthy and faulty message gaps.

    A gap is the time since the previous message of the same
    (trip, vehicle); the first message and gaps above ``limit`` count as
    faults.  Trips are restricted with a semi join, so repeated status rows
    do not duplicate pings.
    """
    done = completed_trips(status, status_window)
    p = existing(scan_window(pings, "obs_epoch", *ping_window), done)
    p = gap_seconds(p.select("ping_id", "trip_id", "vehicle_label", "license_plate", "obs_epoch"),
                    ["trip_id", "vehicle_label"], "obs_epoch", "ping_id")
    p = p.withColumn("fault", S.fault_flag("gap", limit))
    g = p.groupBy("trip_id", "license_plate").agg(
        F.count_if(F.col("fault") == 0).cast("int").alias("not_faulty_count"),
        F.count_if(F.col("fault") == 1).cast("int").alias("faulty_count"))
    return g.select(
        F.col("trip_id").cast("string").alias("trip_id"), "license_plate", "not_faulty_count", "faulty_count",
        S.is_faulty("not_faulty_count", "faulty_count").alias("is_faulty"),
        observe_time_micros(as_of, offset_minutes).alias("observed_time"),
        S.daily_key("trip_id", as_of).alias("primary_key"),
    )
