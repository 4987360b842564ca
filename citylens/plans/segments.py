"""Road-segment traffic (P-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.functions import hexgrid as H
from citylens.functions import scalar as S
from citylens.functions.timeutil import epoch_micros, hour_of_week
from citylens.operators.clean import drop_sentinel
from citylens.operators.spatial import snap_to_segment
from citylens.operators.windows import order_code, surrogate_key
from citylens.sources.scans import scan_window

DWELL_CAP_S = 86400


def segment_table(vertices: DataFrame) -> DataFrame:
    """One row per segment: ordered [lon, lat] vertex list and length."""
    pts = F.array_sort(F.collect_list(F.struct("vseq", "longitude", "latitude")))
    g = vertices.groupBy("segment_id").agg(pts.alias("_v"), F.max("length").alias("length"))
    return g.select("segment_id", "length",
                    F.transform("_v", lambda p: F.array(p["longitude"], p["latitude"])).alias("coords"))


def segment_dwell(snapped: DataFrame, segments: DataFrame, cap_s: int = DWELL_CAP_S) -> DataFrame:
    """Per (trip, route, segment): first/last ping, straight distance, travel
    time, speed and length-scaled dwell, capped (AG-13).

    One pass over the pings: grouped with direction and plate, everything that
    the first and last ping give is numeric, so it is a hash aggregate, combined
    map-side; the few rows per segment that remain then meet by ping order.
    """
    keys = ["trip_id", "route_id", "segment"]
    p = snapped.withColumn("_at", order_code(snapped, "obs_epoch", "ping_id"))
    part = p.groupBy(*keys, "trip_direction", "license_plate").agg(
        F.min("_at").alias("_lo"), F.max("_at").alias("_hi"), F.min("obs_epoch").alias("t0"), F.max("obs_epoch").alias("t1"),
        *[F.min_by(c, "_at").alias(f"{c}0") for c in ("latitude", "longitude")],
        *[F.max_by(c, "_at").alias(f"{c}1") for c in ("latitude", "longitude")])
    first = F.struct(F.col("t0").alias("obs_epoch"), F.col("latitude0").alias("latitude"), F.col("longitude0").alias("longitude"),
                     "trip_direction", "license_plate")
    last = F.struct(F.col("t1").alias("obs_epoch"), F.col("latitude1").alias("latitude"), F.col("longitude1").alias("longitude"))
    g = part.groupBy(*keys).agg(F.min_by(first, "_lo").alias("a"), F.max_by(last, "_hi").alias("b"))
    g = g.join(segments.select(F.col("segment_id").alias("segment"), "length", "coords"), "segment", "left")
    dist = S.euclid("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    travel = F.col("b.obs_epoch") - F.col("a.obs_epoch")
    speed = F.try_divide(dist, travel.cast("double"))
    dwell = F.when(speed > 0, F.col("length") / speed).otherwise(F.lit(0.0))
    return g.select(
        F.col("b.obs_epoch").alias("obs_epoch"), "trip_id", "route_id",
        F.col("a.trip_direction").alias("trip_direction"), F.col("a.license_plate").alias("license_plate"),
        "segment", "coords", travel.alias("travel_time"),
        F.floor(F.least(dwell, F.lit(float(cap_s)))).cast("int").alias("sb_dwell_int"),
    )


def segment_traffic(pings: DataFrame, vertices: DataFrame, as_of: int, window=(None, None),
                    max_ring: int = 4, grid: H.HexGrid = H.FINE) -> DataFrame:
    """P-8: dwell and traffic category per (trip, route, road segment)."""
    p = scan_window(pings, "obs_epoch", *window).select(
        "ping_id", "obs_epoch", "trip_id", "route_id", "trip_direction", "license_plate", "latitude", "longitude")
    snapped = drop_sentinel(snap_to_segment(p, vertices, max_ring, grid), "segment")
    d = segment_dwell(snapped, segment_table(vertices))
    return d.select(
        epoch_micros("obs_epoch").alias("observationDateTime"),
        F.col("trip_id").cast("string").alias("trip_id"), "route_id", "trip_direction", "license_plate",
        "segment",
        F.col("travel_time").cast("double").alias("dwell_time"),
        F.col("sb_dwell_int").cast("double").alias("sb_dwell_time"),
        hour_of_week("obs_epoch").cast("string").alias("time_slot"),
        S.traffic_category("sb_dwell_int").alias("category"),
        S.polygon_json("coords").alias("geojson"),
        surrogate_key("trip_id", "route_id", "segment", "obs_epoch").alias("primary_key"),
    )
