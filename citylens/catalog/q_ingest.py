"""Ingest (SRC-5..8, SRC-10, P-13, P-14), sink (SNK-1, SNK-2), UDF and related scalar keys."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylens.catalog.q_trips import STATUS_CTE, _run
from citylens.catalog.registry import AS_OF, register
from citylens.functions import scalar as S
from citylens.functions.timeutil import date_text, epoch_seconds
from citylens.operators import udf as U
from citylens.plans import feeds as FE
from citylens.sources import ingest as I
from citylens.sources import sinks as K
from citylens.sources.fixtures import duckdb_with, view
from citylens.session import scratch_path

DAY = date_text(AS_OF)
SHIFT_US = 330 * 60 * 1_000_000

TT_SQL = f"""tt AS (SELECT TRY_CAST(json_extract_string(rec, '$.trip_id') AS INTEGER) AS trip_id,
       TRY_CAST(json_extract_string(rec, '$.trip_details.stop_sequence') AS INTEGER) AS stop_sequence,
       TRY_CAST(json_extract_string(rec, '$.trip_details.stop_id') AS INTEGER) AS stop_id,
       epoch_us(CAST('{DAY} ' || json_extract_string(rec, '$.trip_details.arrival_time') AS TIMESTAMP)) AS arrival_time,
       epoch_us(CAST('{DAY} ' || json_extract_string(rec, '$.trip_details.departure_time') AS TIMESTAMP)) AS departure_time
FROM v_timetable_json)"""


def _tt(spark, sf):
    return I.flatten_timetable(view(spark, sf, "v_timetable_json"), DAY)


@register("ingest_timetable_json", duckdb_with("v_timetable_json") + "," + TT_SQL + "\nSELECT * FROM tt")
def q_tt(spark, sf):
    return _tt(spark, sf)


@register("dt_service_datetime", duckdb_with("v_timetable_json") + "," + TT_SQL + """
SELECT trip_id, stop_sequence, arrival_time // 1000000 AS arrival_epoch FROM tt""")
def q_service_dt(spark, sf):
    from citylens.functions.timeutil import service_ts
    r = view(spark, sf, "v_timetable_json").select(F.from_json("rec", I.TIMETABLE_SCHEMA).alias("r"))
    return r.select(F.col("r.trip_id").try_cast("int").alias("trip_id"),
                    F.col("r.trip_details.stop_sequence").try_cast("int").alias("stop_sequence"),
                    epoch_seconds(service_ts(DAY, F.col("r.trip_details.arrival_time"))).alias("arrival_epoch"))


@register("timetable_load", duckdb_with("v_timetable_json") + "," + TT_SQL + """
SELECT *, sha256(concat_ws(chr(1), cast(trip_id AS varchar), cast(stop_sequence AS varchar),
                           cast(arrival_time AS varchar))) AS primary_key FROM tt""")
def q_tt_load(spark, sf):
    return _stored_timetable(spark, sf).drop("run_date", "run")


def _stored_timetable(spark, sf):
    path = scratch_path(spark, "timetable")
    FE.timetable_load(view(spark, sf, "v_timetable_json"), path, AS_OF)
    return spark.read.parquet(path)


_TYPES = "\n".join(f"WHEN {k} THEN '{v}'" for k, v in S.INCIDENT_TYPES.items())
INC_SQL = f"""r AS (SELECT unnest(json_extract(rec, '$.resourceSets[0].resources[*]')) AS j FROM v_incident_json),
inc AS (SELECT CAST(json_extract(j, '$.point.coordinates[0]') AS DOUBLE) AS latitude,
       CAST(json_extract(j, '$.point.coordinates[1]') AS DOUBLE) AS longitude,
       json_extract_string(j, '$.description') AS description,
       CAST(regexp_extract(json_extract_string(j, '$.end'), '^/?Date\\((-?\\d+)', 1) AS BIGINT) * 1000 + {SHIFT_US} AS "end",
       TRY_CAST(json_extract_string(j, '$.icon') AS INTEGER) AS icon,
       CAST(json_extract(j, '$.incidentId') AS BIGINT) AS "incidentId",
       CAST(json_extract(j, '$.isEndTimeBackfilled') AS BOOLEAN) AS "isEndTimeBackfilled",
       CAST(NULLIF(regexp_extract(json_extract_string(j, '$.lastModified'), '^/?Date\\((-?\\d+)', 1), '') AS BIGINT) * 1000
         + {SHIFT_US} AS "lastModified",
       CAST(json_extract(j, '$.roadClosed') AS BOOLEAN) AS "roadClosed",
       TRY_CAST(json_extract_string(j, '$.severity') AS INTEGER) AS severity,
       TRY_CAST(json_extract_string(j, '$.source') AS INTEGER) AS source,
       CAST(regexp_extract(json_extract_string(j, '$.start'), '^/?Date\\((-?\\d+)', 1) AS BIGINT) * 1000 + {SHIFT_US} AS start,
       coalesce(json_extract_string(j, '$.title'), '') AS title,
       CAST(json_extract(j, '$.toPoint.coordinates[0]') AS DOUBLE) AS "toPoint_latitude",
       CAST(json_extract(j, '$.toPoint.coordinates[1]') AS DOUBLE) AS "toPoint_longitude",
       TRY_CAST(json_extract_string(j, '$.type') AS INTEGER) AS type_int,
       CASE TRY_CAST(json_extract_string(j, '$.type') AS INTEGER) {_TYPES} END AS type_string,
       CAST(json_extract(j, '$.verified') AS BOOLEAN) AS verified
FROM r)"""
INC = duckdb_with("v_incident_json") + "," + INC_SQL


def _inc(spark, sf):
    return I.flatten_incidents(view(spark, sf, "v_incident_json"))


@register("ingest_incidents_json", INC + "\nSELECT * FROM inc")
def q_inc(spark, sf):
    return _inc(spark, sf)


@register("str_epoch_text", INC + f"""
SELECT "incidentId", start - {SHIFT_US} AS start_us FROM inc""")
def q_epoch_text(spark, sf):
    r = view(spark, sf, "v_incident_json").select(F.from_json("rec", I.INCIDENT_SCHEMA).alias("p"))
    r = r.select(F.inline(F.get(F.col("p.resourceSets"), 0)["resources"])).select("incidentId", F.col("start").alias("t"))
    return r.select("incidentId", S.parse_epoch_text("t").alias("start_us"))


@register("map_code_to_label", INC + """
SELECT "incidentId", type_int, type_string FROM inc""")
def q_code_label(spark, sf):
    return _inc(spark, sf).select("incidentId", "type_int", "type_string")


@register("fill_missing_text", INC + """
SELECT "incidentId", title FROM inc""")
def q_fill_text(spark, sf):
    return _inc(spark, sf).select("incidentId", "title")


@register("incident_load", INC + """
SELECT *, sha256(concat_ws(chr(1), cast("incidentId" AS varchar), cast(start AS varchar))) AS primary_key FROM inc""")
def q_inc_load(spark, sf):
    path = scratch_path(spark, "incidents")
    FE.incident_load(view(spark, sf, "v_incident_json"), path, AS_OF)
    return spark.read.parquet(path).drop("run_date", "run")


_TYPE_ROWS = " UNION ALL ".join(f"SELECT {k} AS type_int, '{v}' AS type_string" for k, v in S.INCIDENT_TYPES.items())


@register("rows_to_df", INC + f""",
dim AS ({_TYPE_ROWS})
SELECT dim.type_int, dim.type_string, count(inc.type_int) AS n FROM dim LEFT JOIN inc USING (type_int)
GROUP BY dim.type_int, dim.type_string""")
def q_rows(spark, sf):
    from citylens.sources.scans import rows_to_df
    schema = T.StructType([T.StructField("type_int", T.IntegerType()), T.StructField("type_string", T.StringType())])
    dim = rows_to_df(spark, sorted(S.INCIDENT_TYPES.items()), schema)
    counts = _inc(spark, sf).groupBy("type_int").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(counts, "type_int", "left").select("type_int", "type_string",
                                                       F.coalesce("n", F.lit(0)).alias("n"))


@register("read_sensor_csv", duckdb_with("v_sensors") + """
SELECT 'S' || cast(sensor_id AS varchar) AS sensor_id, longitude, latitude,
       'Sensor ' || cast(sensor_id AS varchar) || ', Main Road' AS address FROM v_sensors""")
def q_csv(spark, sf):
    return _sensors_from_csv(spark, sf)


def _sensors_from_csv(spark, sf):
    s = view(spark, sf, "v_sensors").select(
        F.concat(F.lit("S"), F.col("sensor_id").cast("string")).alias("id"), "longitude", "latitude",
        F.concat(F.lit("Sensor "), F.col("sensor_id").cast("string"), F.lit(", Main Road")).alias("address"))
    return I.read_sensors(spark, I.write_sensor_csv(spark, s))


# ------------------------------------------------------------------ sinks
PINGS = duckdb_with("v_pings")
_UPSERT_SQL = STATUS_CTE + """, v_status_history AS (""" + duckdb_with("v_status_history")[len("WITH v_status_history AS ("):].rstrip("\n") + f""",
u AS (SELECT trip_id, status, cast(floor(epoch(observe_ts)) AS bigint) AS observe_epoch FROM v_status_history
      UNION ALL SELECT DISTINCT trip_id, status, {AS_OF} FROM classified)
SELECT trip_id, status, observe_epoch FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY observe_epoch DESC, status DESC) AS rn FROM u) WHERE rn = 1"""


@register("sink_append_history", PINGS + f"""
SELECT ping_id, trip_id, obs_epoch, concat_ws('|', cast(ping_id AS varchar), '{AS_OF}') AS primary_key, '{DAY}' AS run_date
FROM v_pings
UNION ALL
SELECT ping_id, trip_id, obs_epoch, concat_ws('|', cast(ping_id AS varchar), '{AS_OF + 900}') AS primary_key, '{DAY}' AS run_date
FROM v_pings""")
def q_append(spark, sf):
    p = view(spark, sf, "v_pings").select("ping_id", "trip_id", "obs_epoch")
    path = scratch_path(spark, "history")
    for run in (AS_OF, AS_OF + 900):
        K.append_history(p, path, run, ["ping_id"])
    back = spark.read.parquet(path).drop("run")
    return back.withColumn("run_date", F.col("run_date").cast("string"))


@register("sink_upsert_by_key", _UPSERT_SQL)
def q_upsert(spark, sf):
    old = view(spark, sf, "v_status_history").select("trip_id", "status",
                                                    epoch_seconds("observe_ts").alias("observe_epoch"))
    c = _run(spark, sf).classified.where(F.col("first_ping").isNotNull())
    new = c.select("trip_id", "status", F.lit(AS_OF).cast("long").alias("observe_epoch")).distinct()
    merged = K.upsert_by_key(old, new, ["trip_id"], ["observe_epoch", "status"])
    path = scratch_path(spark, "status-upsert")
    K.write_upserted(spark, merged, path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ UDF extension points
@register("udf_grouped_map", PINGS + """
SELECT trip_id, min(obs_epoch) AS first_ping, max(obs_epoch) AS last_ping, count(*) AS n_pings FROM v_pings GROUP BY trip_id""")
def q_grouped(spark, sf):
    # groups are (trip, week bucket) so no trip reaches pandas whole; the
    # per-bucket partials are merged natively
    p = view(spark, sf, "v_pings").select("trip_id", "obs_epoch",
                                          F.floor(F.col("obs_epoch") / (7 * 86400)).alias("bucket"))
    part = U.apply_grouped(p, ["trip_id", "bucket"], U.trip_span, U.TRIP_SPAN_SCHEMA)
    return part.groupBy("trip_id").agg(F.min("first_ping").alias("first_ping"), F.max("last_ping").alias("last_ping"),
                                       F.sum("n_pings").alias("n_pings"))


@register("udf_grouped_stream", PINGS + """,
g AS (SELECT CASE WHEN trip_id % 3 = 0 THEN 'hot' ELSE vehicle_label END AS label, obs_epoch FROM v_pings),
l AS (SELECT label, obs_epoch - lag(obs_epoch) OVER (PARTITION BY label ORDER BY obs_epoch) AS gap FROM g)
SELECT label, max(gap) AS longest_gap, count(*) AS n_messages FROM l GROUP BY label""")
def q_grouped_stream(spark, sf):
    """One label has a third of all messages; its group passes as batches."""
    label = F.when(F.col("trip_id") % 3 == 0, "hot").otherwise(F.col("vehicle_label")).alias("label")
    return U.apply_grouped_stream(view(spark, sf, "v_pings").select(label, "obs_epoch"), ["label"], U.longest_silence, U.SILENCE_SCHEMA, ["obs_epoch"])


@register("udf_scalar_vectorised", PINGS + """
SELECT ping_id, cast((isodow(make_timestamp(obs_epoch * 1000000)) - 1) * 24 + hour(make_timestamp(obs_epoch * 1000000))
                     AS integer) AS time_slot FROM v_pings""")
def q_vectorised(spark, sf):
    how = U.vectorised(U.hour_of_week_pd, "int")
    return view(spark, sf, "v_pings").select("ping_id", how("obs_epoch").alias("time_slot"))


# ------------------------------------------------------------------ repeated runs
@register("timetable_load_twice", duckdb_with("v_timetable_json") + "," + TT_SQL + """
SELECT *, sha256(concat_ws(chr(1), cast(trip_id AS varchar), cast(stop_sequence AS varchar),
                           cast(arrival_time AS varchar))) AS primary_key FROM tt""")
def q_tt_twice(spark, sf):
    """A day's timetable loaded twice, the second time an hour later, has the rows of one load."""
    path = scratch_path(spark, "timetable-twice")
    for as_of in (AS_OF, AS_OF + 3600):
        FE.timetable_load(view(spark, sf, "v_timetable_json"), path, as_of)
    return spark.read.parquet(path).drop("run_date", "run")


@register("incident_load_retried", INC + """
SELECT *, sha256(concat_ws(chr(1), cast("incidentId" AS varchar), cast("start" AS varchar))) AS primary_key FROM inc""")
def q_incidents_retried(spark, sf):
    """A retried incident run replaces its own rows."""
    path = scratch_path(spark, "incidents-retried")
    for _ in range(2):
        FE.incident_load(view(spark, sf, "v_incident_json"), path, AS_OF)
    return spark.read.parquet(path).drop("run_date", "run")
