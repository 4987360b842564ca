"""Streaming keys (ST-1 .. ST-5): each runs the incremental query over the
table files with an ``availableNow`` trigger and returns the sink read back.
Oracles keep only windows / sessions final at the end watermark
(max event time - delay), which is what append mode emits."""

from __future__ import annotations

from pyspark.sql import functions as F

from citylens.catalog.hexsql import cell_sql
from citylens.catalog.q_products import LATEST_SQL
from citylens.catalog.q_trips import STATUS_CTE, TH
from citylens.catalog.registry import AS_OF, GAP_S, OFFSET_MIN, register
from citylens.functions import hexgrid as H
from citylens.session import scratch_path
from citylens.sources import upsert as U
from citylens.sources.fixtures import duckdb_with, view
from citylens.streaming import streams as ST
from citylens.streaming import trip_status as TS

DAY = 86400
DELAY_S = 2 * DAY
WM = f"(SELECT max(epoch_ms(obs_ts)) FROM v_pings) - {DELAY_S * 1000}"
PC = f"pc AS (SELECT *, {cell_sql('latitude', 'longitude', H.COARSE)} AS cell FROM v_pings)"


def _pings(spark, sf):
    return ST.stream_view(spark, sf, "v_pings")


@register("stream_tumbling_dwell", duckdb_with("v_pings") + "," + PC + f""",
w AS (SELECT trip_id, route_id, cell, floor(obs_epoch / {DAY}) * {DAY} AS window_start,
             max(obs_epoch) - min(obs_epoch) AS dwell_time, count(*) AS n_pings FROM pc GROUP BY ALL)
SELECT trip_id, route_id, cell, cast(window_start AS bigint) AS window_start,
       cast(window_start + {DAY} AS bigint) AS window_end, dwell_time, n_pings
FROM w WHERE (window_start + {DAY}) * 1000 <= {WM}""")
def q_stream_dwell(spark, sf):
    path = ST.run_available_now(ST.stream_dwell(_pings(spark, sf), f"{DELAY_S} seconds", "1 day"), "dwell")
    return spark.read.parquet(path)


@register("stream_sliding_density", duckdb_with("v_pings") + "," + PC + f""",
ws AS (SELECT cell, floor(obs_epoch / {DAY // 2}) * {DAY // 2} AS s FROM pc
       UNION ALL SELECT cell, floor(obs_epoch / {DAY // 2}) * {DAY // 2} - {DAY // 2} FROM pc)
SELECT cell, cast(s AS bigint) AS window_start, cast(s + {DAY} AS bigint) AS window_end, count(*) AS count
FROM ws WHERE (s + {DAY}) * 1000 <= {WM} GROUP BY ALL""")
def q_stream_density(spark, sf):
    path = ST.run_available_now(ST.stream_density(_pings(spark, sf), "1 day", "12 hours", f"{DELAY_S} seconds"),
                                "density")
    return spark.read.parquet(path)


@register("stream_session_gaps", duckdb_with("v_pings") + f""",
o AS (SELECT trip_id, vehicle_label, obs_epoch, epoch_us(obs_ts) AS us,
             epoch_us(obs_ts) - lag(epoch_us(obs_ts)) OVER (PARTITION BY trip_id, vehicle_label ORDER BY obs_ts) AS d FROM v_pings),
s AS (SELECT *, sum(CASE WHEN d IS NULL OR d >= {GAP_S * 1_000_000} THEN 1 ELSE 0 END)
               OVER (PARTITION BY trip_id, vehicle_label ORDER BY us ROWS UNBOUNDED PRECEDING) AS sid FROM o),
g AS (SELECT trip_id, vehicle_label, min(us) AS us0, max(us) + {GAP_S * 1_000_000} AS us1, count(*) AS n_messages,
             min(obs_epoch) AS first_epoch, max(obs_epoch) AS last_epoch FROM s GROUP BY trip_id, vehicle_label, sid)
SELECT trip_id, vehicle_label, cast(floor(us0 / 1000000) AS bigint) AS session_start,
       cast(floor(us1 / 1000000) AS bigint) AS session_end, n_messages, first_epoch, last_epoch
FROM g WHERE us1 / 1000 <= {WM}""")
def q_stream_sessions(spark, sf):
    path = ST.run_available_now(ST.sessions(_pings(spark, sf), f"{GAP_S} seconds", f"{DELAY_S} seconds"), "sessions")
    return spark.read.parquet(path)


@register("stream_latest_upsert", duckdb_with("v_readings") + "," + LATEST_SQL + """
SELECT sensor_id, cast(floor(epoch(obs_ts)) AS bigint) AS obs_epoch, k1, k2, k3, co2, co, no2, so2, pm10, pm2p5 FROM latest""")
def q_stream_latest(spark, sf):
    src = ST.stream_view(spark, sf, "v_readings").na.drop()
    out = ST.read_latest(spark, ST.stream_latest(src, ["sensor_id"], ["obs_ts", "k1", "k2", "k3"]), src.schema)
    return out.withColumn("obs_epoch", F.unix_timestamp("obs_ts")).drop("obs_ts")


@register("upsert_table_batches", duckdb_with("v_readings") + "," + LATEST_SQL + """
SELECT sensor_id, cast(floor(epoch(obs_ts)) AS bigint) AS obs_epoch, k1, k2, k3, co2, co, no2, so2, pm10, pm2p5 FROM latest""")
def q_upsert_batches(spark, sf):
    """The readings in three batches by order number, in buckets of few rows that split as sensors come."""
    src = view(spark, sf, "v_readings").na.drop()
    path = scratch_path(spark, "upsert-table")
    for version in range(3):
        U.merge(src.where(F.col("k1") % 3 == version), path, ["sensor_id"], ["obs_ts", "k1", "k2", "k3"], version, bucket_rows=20)
    return U.read_upserted(spark, path, src.schema).withColumn("obs_epoch", F.unix_timestamp("obs_ts")).drop("obs_ts")


@register("stream_dedup", duckdb_with("v_pings") + "SELECT ping_id, trip_id, obs_epoch FROM v_pings")
def q_stream_dedup(spark, sf):
    a = _pings(spark, sf).select("ping_id", "trip_id", "obs_epoch", "obs_ts")
    b = _pings(spark, sf).select("ping_id", "trip_id", "obs_epoch", "obs_ts")
    d = ST.dedup_stream(a.unionByName(b), "ping_id", "obs_ts", f"{DELAY_S} seconds")
    path = ST.run_available_now(d.select("ping_id", "trip_id", "obs_epoch"), "dedup")
    return spark.read.parquet(path)


# the clock of the streamed status is the last watermark
_CLOCK = f"(SELECT max(obs_epoch) - {DELAY_S} FROM v_pings)"


@register("stream_trip_status", STATUS_CTE.replace(str(AS_OF), _CLOCK) + f"""
SELECT cast(trip_id AS varchar) AS trip_id, status, license_plate, trip_time,
       coalesce(last_ping, end_time) * 1000000 AS "observationDateTime", mlat AS latitude, mlon AS longitude,
       ({_CLOCK} + {OFFSET_MIN * 60}) * 1000000 AS observe_time,
       cast(trip_id AS varchar) || strftime(make_timestamp({_CLOCK} * 1000000), '%Y-%m-%d') AS primary_key
FROM status_all""")
def q_stream_trip_status(spark, sf):
    path = TS.run_trip_status(_pings(spark, sf), view(spark, sf, "v_schedule"), watermark=f"{DELAY_S} seconds")
    return TS.current_status(spark, path, OFFSET_MIN, TH)
