"""Products fed by the stored output of other products, and frames with NULL keys.

Each chain key writes the producer's output, reads it back and gives it to the
consumer with the consumer's window set.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from citylens.catalog.hexsql import cell_sql, polygon_json_sql, ring_text_sql
from citylens.catalog.q_ingest import DAY, TT_SQL, _sensors_from_csv, _stored_timetable
from citylens.catalog.q_products import MODEL_SQL, PANEL_SQL, RES, SURF_SQL, _model, _r6, dwell_rows_sql
from citylens.catalog.q_spatial import CO, DARK, NEAREST, OBS_US, SLOT_S, brute_polyfill_sql, v, with_
from citylens.catalog.q_spatial import _region_cells
from citylens.catalog.q_trips import DAY_TXT, STATUS_CTE, TH, TRIP_STATUS_SQL, _inputs
from citylens.catalog.registry import AS_OF, GAP_S, WEEK_S, register
from citylens.functions import hexgrid as H
from citylens.operators import spatial as SP
from citylens.operators.clean import extreme_rows
from citylens.plans import dwell as D
from citylens.plans import feeds as FE
from citylens.plans import quality as Q
from citylens.plans import surface as SU
from citylens.plans import trips as P
from citylens.session import scratch_path
from citylens.sources.fixtures import duckdb_text, duckdb_with
from citylens.sources.ingest import read_region

ME = H.MEDIUM
STATUS_WINDOW = (AS_OF - WEEK_S, AS_OF)
PING_WINDOW = (AS_OF - WEEK_S, AS_OF)
_STATUS_BODY = STATUS_CTE[len(duckdb_with("v_pings", "v_schedule")):]
_TRIP_STATUS_BODY = TRIP_STATUS_SQL[len(duckdb_with("v_pings", "v_schedule")):]


def _stored(df, name):
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ P-13 -> P-1
@register("chain_timetable_status", duckdb_with("v_pings", "v_timetable_json") + "," + TT_SQL + """,
v_schedule AS (SELECT trip_id, stop_sequence, stop_id, arrival_time // 1000000 AS arrival_epoch,
               departure_time // 1000000 AS departure_epoch FROM tt)""" + _TRIP_STATUS_BODY)
def q_chain_timetable(spark, sf):
    sch = FE.schedule_of_timetable(_stored_timetable(spark, sf).where(F.col("run_date") == DAY))
    return P.trip_status(v(spark, sf, "v_pings"), sch, AS_OF, thresholds=TH)


# ------------------------------------------------------------------ P-1 -> P-9, P-10
def _status_table(spark, sf):
    live, sch = _inputs(spark, sf)
    return P.status_history(_stored(P.trip_status(live, sch, AS_OF, thresholds=TH), "status"))


def _bounds(spark):
    from datetime import datetime, timezone
    return tuple(datetime.fromtimestamp(t, timezone.utc).replace(tzinfo=None) for t in STATUS_WINDOW)


_FROM_STATUS = f""",
v_status_history AS (SELECT trip_id, status, make_timestamp({AS_OF} * 1000000) AS observe_ts FROM status_all)"""
_IN_WINDOW = f"(SELECT * FROM v_pings WHERE obs_epoch BETWEEN {PING_WINDOW[0]} AND {PING_WINDOW[1]})"


@register("chain_status_blackspots", duckdb_with("v_pings", "v_schedule", "v_routes") + _STATUS_BODY.rstrip() + _FROM_STATUS + f""",
{DARK.replace("FROM v_pings p", f"FROM {_IN_WINDOW} p")},
wt AS (SELECT *, count(route_id) OVER (PARTITION BY cell) AS w FROM dark),
mm AS (SELECT min(w) AS lo, max(w) AS hi FROM wt)
SELECT cell, route_id, latitude, longitude,
       coalesce(cast(floor(4e0 * (w - lo) / CASE WHEN hi = lo THEN NULL ELSE hi - lo END) + 1 AS integer), 1) AS weight,
       sha256(concat_ws(chr(1), cast(cell AS varchar), cast(point_id AS varchar), '{AS_OF}')) AS primary_key,
       {ring_text_sql('cell', CO)} AS polygon, {polygon_json_sql('cell', CO)} AS coordinates, {OBS_US} AS observe_time
FROM wt, mm""")
def q_chain_blackspots(spark, sf):
    return Q.network_black_spots(v(spark, sf, "v_routes"), v(spark, sf, "v_pings"), _status_table(spark, sf), AS_OF,
                                 _bounds(spark), PING_WINDOW)


@register("chain_status_trackers", duckdb_with("v_pings", "v_schedule") + _STATUS_BODY.rstrip() + _FROM_STATUS + f""",
done AS (SELECT DISTINCT trip_id FROM v_status_history WHERE status = 'COMPLETED'),
gp AS (SELECT p.*, obs_epoch - lag(obs_epoch) OVER (PARTITION BY trip_id, vehicle_label ORDER BY obs_epoch, ping_id) AS gap
       FROM {_IN_WINDOW} p WHERE EXISTS (SELECT 1 FROM done d WHERE d.trip_id = p.trip_id)),
fc AS (SELECT trip_id, license_plate, cast(count(*) FILTER (WHERE NOT (gap IS NULL OR gap > {GAP_S})) AS integer) AS not_faulty_count,
              cast(count(*) FILTER (WHERE gap IS NULL OR gap > {GAP_S}) AS integer) AS faulty_count
       FROM gp GROUP BY trip_id, license_plate)
SELECT cast(trip_id AS varchar) AS trip_id, license_plate, not_faulty_count, faulty_count,
       not_faulty_count < faulty_count AS is_faulty, {OBS_US} AS observed_time,
       cast(trip_id AS varchar) || '{DAY_TXT}' AS primary_key FROM fc""")
def q_chain_trackers(spark, sf):
    return Q.faulty_trackers(v(spark, sf, "v_pings"), _status_table(spark, sf), AS_OF, GAP_S, _bounds(spark), PING_WINDOW)


# ------------------------------------------------------------------ P-5 -> P-7
@register("chain_delay_forecast", with_("v_pings", "v_region", extra=PANEL_SQL) + f""",
z AS (SELECT cell, trip_direction, sum(smoothed * [0.1e0, 0.2e0, 0.3e0, 0.4e0][slot + 1]) AS z FROM sm GROUP BY ALL)
SELECT {(AS_OF + 270 * 60) * 1_000_000} AS "observationDateTime", cell, trip_direction,
       round(CASE WHEN z * 501e0 - 1e0 < 0 THEN -1e0 ELSE z * 501e0 - 1e0 END, 6) AS predicted_dwell_time,
       sha256(concat_ws(chr(1), '{AS_OF}', cast(cell AS varchar), trip_direction)) AS primary_key FROM z""")
def q_chain_forecast(spark, sf):
    delays = _stored(D.cell_delay(v(spark, sf, "v_pings"), _model(spark, sf), AS_OF), "cell-delay")
    dwell = D.dwell_of_delays(delays, AS_OF, 4, SLOT_S)
    return _r6(D.cell_dwell_forecast(dwell, _region_cells(spark, sf), AS_OF, 4, SLOT_S), "predicted_dwell_time")


# ------------------------------------------------------------------ region file -> P-11
# A file with a polygon with a hole, an unclosed ring and a multipolygon, as (feature, ring, [lon, lat]).
REGION_FILE = (
    '{"type":"FeatureCollection","features":['
    '{"type":"Feature","properties":{"id":"a"},"geometry":{"type":"Polygon","coordinates":'
    '[[[72.68,21.08],[72.8,21.08],[72.8,21.2],[72.68,21.2],[72.68,21.08]],[[72.71,21.11],[72.76,21.11],[72.76,21.16],[72.71,21.16],[72.71,21.11]]]}},'
    '{"type":"Feature","properties":{"id":"b"},"geometry":{"type":"Polygon","coordinates":[[[72.82,21.08],[72.9,21.08],[72.86,21.15]]]}},'
    '{"type":"Feature","properties":{},"geometry":{"type":"MultiPolygon","coordinates":'
    '[[[[72.82,21.2],[72.85,21.2],[72.85,21.24],[72.82,21.24],[72.82,21.2]]],[[[72.9,21.2],[72.93,21.21],[72.9,21.24],[72.9,21.2]]]]}}]}')
_RINGS = [("a", "0-0-0", [(72.68, 21.08), (72.8, 21.08), (72.8, 21.2), (72.68, 21.2), (72.68, 21.08)]),
          ("a", "0-0-1", [(72.71, 21.11), (72.76, 21.11), (72.76, 21.16), (72.71, 21.16), (72.71, 21.11)]),
          ("b", "1-0-0", [(72.82, 21.08), (72.9, 21.08), (72.86, 21.15)]),
          ("2", "2-0-0", [(72.82, 21.2), (72.85, 21.2), (72.85, 21.24), (72.82, 21.24), (72.82, 21.2)]),
          ("2", "2-1-0", [(72.9, 21.2), (72.93, 21.21), (72.9, 21.24), (72.9, 21.2)])]
_VERTICES = ", ".join(f"('{f}', '{r}', {i}, {y!r}e0, {x!r}e0)" for f, r, pts in _RINGS for i, (x, y) in enumerate(pts))
_FILE_SQL = f"fv(region_id, ring_id, vseq, latitude, longitude) AS (VALUES {_VERTICES})"
# the brute-force oracle works on closed rings of one key each; even-odd over a feature's rings is the parity of their sum
_FILE_CELLS = _FILE_SQL + """,
fclosed AS (SELECT * FROM fv UNION ALL SELECT region_id, ring_id, max(vseq) + 1, arg_min(latitude, vseq), arg_min(longitude, vseq)
            FROM fv GROUP BY ALL), """ + brute_polyfill_sql("fr", "fclosed", "ring_id", CO).strip() + """,
fcells AS (SELECT region_id, cell FROM fr JOIN (SELECT DISTINCT region_id, ring_id FROM fv) USING (ring_id)
           GROUP BY ALL HAVING count(*) % 2 = 1)"""


def _region_file(spark):
    path = scratch_path(spark, "region-file")
    spark.createDataFrame([(REGION_FILE,)], "value string").coalesce(1).write.text(path)
    return read_region(spark, path)


@register("polyfill_region_file", with_("v_pings", extra=_FILE_CELLS) + f""",
pc AS (SELECT {cell_sql('latitude', 'longitude', CO)} AS cell, count(*) AS n FROM v_pings GROUP BY 1)
SELECT region_id, cell, coalesce(n, 0) AS n_pings FROM fcells LEFT JOIN pc USING (cell)""")
def q_region_file_cells(spark, sf):
    cells = SP.polyfill(_region_file(spark), CO)
    counts = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO).groupBy("cell").agg(F.count("*").alias("n"))
    return cells.join(counts, "cell", "left").select("region_id", "cell", F.coalesce("n", F.lit(0)).alias("n_pings"))


@register("chain_region_density", with_("v_pings", extra=_FILE_CELLS) + f""",
cnt AS (SELECT {cell_sql('latitude', 'longitude', CO)} AS cell, count(*) AS count FROM v_pings
        WHERE obs_epoch BETWEEN {AS_OF - 7 * 86400} AND {AS_OF} GROUP BY 1),
f AS (SELECT coalesce(a.cell, b.cell) AS cell, coalesce(b.count, 0) AS count FROM (SELECT DISTINCT cell FROM fcells) a
      FULL OUTER JOIN cnt b ON a.cell = b.cell)
SELECT cell, cast(count AS integer) AS count, {polygon_json_sql('cell', CO)} AS coordinates, {OBS_US} AS "observationDateTime" FROM f""")
def q_chain_density(spark, sf):
    return SU.ping_density_map(v(spark, sf, "v_pings"), _region_file(spark), AS_OF, 7)


# ------------------------------------------------------------------ sensor CSV -> P-12
@register("chain_sensors_surface", with_("v_readings", "v_sensors", extra=SURF_SQL.replace(
    "FROM latest l JOIN v_sensors s USING (sensor_id)",
    "FROM (SELECT * REPLACE ('S' || cast(sensor_id AS varchar) AS sensor_id) FROM latest) l "
    "JOIN (SELECT * REPLACE ('S' || cast(sensor_id AS varchar) AS sensor_id) FROM v_sensors) s USING (sensor_id)")) + f""",
zc AS (SELECT z.*, m.mx, m.my, greatest(z.value, CASE WHEN pollutant = 'co2' THEN 200e0 ELSE 0e0 END) AS weight
       FROM z JOIN m USING (i, j))
SELECT pollutant, i, j, round(weight, 6) AS weight, {polygon_json_sql(cell_sql('my', 'mx', ME), ME)} AS coodinates,
       sha256(concat_ws(chr(1), pollutant, cast(i AS varchar), cast(j AS varchar), '{AS_OF}')) AS primary_key,
       {OBS_US} AS "observationDateTime" FROM zc""")
def q_chain_surface(spark, sf):
    readings = v(spark, sf, "v_readings").withColumn("sensor_id", F.concat(F.lit("S"), F.col("sensor_id").cast("string")))
    return _r6(SU.air_quality_surface(readings, _sensors_from_csv(spark, sf), AS_OF, RES, nearest=NEAREST), "weight")


# ------------------------------------------------------------------ two runs of the status job
_LATER = AS_OF + 4 * 3600
_JOB_STATUS = ["trip_status", "trip_status_live", "completed_trip_with_delay", "live_trip_with_delay",
               "completed_trip_with_deviation", "live_trip_with_deviation"]


def _run_sql(as_of: int) -> str:
    """The status rows of a run at ``as_of`` over the week of pings before it."""
    body = _STATUS_BODY.replace(str(AS_OF), str(as_of)).rstrip().rstrip(")").rstrip()
    return body + ")"


def _job_sql(name: str, as_of: int) -> str:
    live = f"(SELECT * FROM v_all_pings WHERE obs_epoch BETWEEN {as_of - WEEK_S} AND {as_of})"
    obs = (as_of + 330 * 60) * 1_000_000
    return f"""{name} AS (WITH v_pings AS (SELECT * FROM {live}){_run_sql(as_of)},
  st AS (SELECT DISTINCT trip_id, status FROM status_all WHERE status IN ('COMPLETED', 'LIVE')),
  pp AS (SELECT p.trip_id, p.trip_delay, p.license_plate, st.status FROM v_pings p JOIN st USING (trip_id)),
  med AS (SELECT trip_id, status, quantile_disc(trip_delay, 0.5) AS d FROM pp GROUP BY trip_id, status)
  SELECT CASE WHEN coalesce(last_ping, end_time) >= {as_of - 86400} THEN 'trip_status' END AS output, cast(trip_id AS varchar) AS trip_id,
         status, license_plate, {obs} AS observe_time, NULL AS detail FROM status_all
  UNION ALL SELECT 'trip_status_live', cast(trip_id AS varchar), status, license_plate, {obs}, NULL FROM status_all
  UNION ALL SELECT lower(status) || '_trip_with_delay', cast(trip_id AS varchar), status, license_plate, {obs}, cast(d AS varchar)
    FROM (SELECT DISTINCT trip_id, status, license_plate FROM pp) JOIN med USING (trip_id, status)
  UNION ALL SELECT DISTINCT lower(status) || '_trip_with_deviation', cast(trip_id AS varchar), status, license_plate, {obs},
    '[' || array_to_string(eta_stops, ', ') || ']' FROM classified WHERE status IN ('COMPLETED', 'LIVE') AND eta_stops_count <> common_stops_count)"""


@register("trip_status_job_daily", f"""
WITH v_all_pings AS ({duckdb_text('v_pings')}), v_schedule AS ({duckdb_text('v_schedule')}),
{_job_sql('r1', AS_OF)},
{_job_sql('r2', _LATER)}
SELECT output, trip_id, status, license_plate, observe_time, detail FROM r1 WHERE output IS NOT NULL AND output <> 'trip_status_live'
UNION ALL SELECT output, trip_id, status, license_plate, observe_time, detail FROM r2 WHERE output IS NOT NULL""")
def q_status_job(spark, sf):
    """Both runs fall on one day: the later run's rows replace the earlier ones in
    the daily table, the other five outputs append."""
    live, sch = _inputs(spark, sf)
    out = scratch_path(spark, "status-job")
    for as_of in (AS_OF, _LATER):
        paths = P.trip_status_job(live, sch, as_of, out, (as_of - WEEK_S, as_of), thresholds=TH, recent_minutes=24 * 60)
    rows = None
    for name in _JOB_STATUS:
        t = spark.read.parquet(paths[name])
        detail = F.col("trip_delay") if name.endswith("delay") else F.col("eta_stops") if name.endswith("deviation") else F.lit(None)
        part = t.select(F.lit(name).alias("output"), "trip_id", "status", "license_plate", "observe_time",
                        detail.cast("string").alias("detail"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


# ------------------------------------------------------------------ NULL keys and coordinates
# Pings that lose a route, a trip, an id or their coordinates.
_HOLED = {"route_id": 7, "trip_id": 11, "ping_id": 13, "latitude": 17}
_HOLED_SQL = "v_pings AS (SELECT " + "* REPLACE (" + ", ".join(
    f"CASE WHEN obs_epoch % {n} = 0 THEN NULL ELSE {c} END AS {c}" for c, n in _HOLED.items()) + ") FROM v_whole)"

# the model is trained on complete pings only
_FULL_SQL = "v_full AS (SELECT * FROM v_pings WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _HOLED) + ")"


def _holed(spark, sf):
    p = v(spark, sf, "v_pings")
    return p.withColumns({c: F.when(F.col("obs_epoch") % n != 0, F.col(c)) for c, n in _HOLED.items()})


@register("cell_delay_null_keys", f"WITH v_whole AS ({duckdb_text('v_pings')}), {_HOLED_SQL}, {_FULL_SQL}, {MODEL_SQL.replace('FROM v_pings', 'FROM v_full')}, "
          + dwell_rows_sql() + f""",
scored AS (SELECT d.*, m.coef, m.intercept, m.intercept + m.coef * d.time_slot AS predicted_dwell_time
           FROM drows d LEFT JOIN model2 m USING (route_id, cell) WHERE latitude IS NOT NULL)
SELECT cast(ping_id AS varchar) AS primary_key, obs_epoch, cast(trip_id AS varchar) AS trip_id, route_id, cell,
       cast(dwell_time AS double) AS dwell_time, {polygon_json_sql('cell', CO)} AS geojson,
       round(predicted_dwell_time, 6) AS predicted_dwell_time FROM scored""")
def q_cell_delay_nulls(spark, sf):
    p = _holed(spark, sf)
    out = D.cell_delay(p, D.cell_dwell_model(p, AS_OF), AS_OF)
    return _r6(out.select("primary_key", F.expr("observationDateTime div 1000000").alias("obs_epoch"), "trip_id", "route_id", "cell",
                          "dwell_time", "geojson", "predicted_dwell_time"), "predicted_dwell_time")


@register("extreme_rows_null_keys", f"WITH v_whole AS ({duckdb_text('v_pings')}), {_HOLED_SQL}" + """,
w AS (SELECT *, max(obs_epoch) OVER (PARTITION BY trip_id) AS mx, min(obs_epoch) OVER (PARTITION BY trip_id) AS mn FROM v_pings)
SELECT ping_id, trip_id, obs_epoch FROM w WHERE obs_epoch = mx OR obs_epoch = mn""")
def q_extreme_nulls(spark, sf):
    return extreme_rows(_holed(spark, sf), ["trip_id"], {"mx": ("max", "obs_epoch"), "mn": ("min", "obs_epoch")}).select(
        "ping_id", "trip_id", "obs_epoch")
