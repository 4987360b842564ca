"""Trip products P-1 .. P-4 and the scan/join/aggregate keys they exercise."""

from __future__ import annotations

from citylens.catalog.registry import AS_OF, LATE_S, OFFSET_MIN, register
from citylens.functions.timeutil import date_text
from citylens.plans import trips as P
from citylens.sources.fixtures import duckdb_with, view

TH = P.TripThresholds(late_s=LATE_S)
OBS_US = (AS_OF + OFFSET_MIN * 60) * 1_000_000
DAY_TXT = date_text(AS_OF)


def _inputs(spark, sf):
    return view(spark, sf, "v_pings"), view(spark, sf, "v_schedule")


def _run(spark, sf):
    live, sch = _inputs(spark, sf)
    return P.trip_run(live, sch, AS_OF, thresholds=TH)


# Oracle: the reference's own formulation (partition windows, extreme rows,
# distinct), independent of the library's aggregate-first plan.
STATUS_CTE = duckdb_with("v_pings", "v_schedule") + f""",
sch AS (SELECT * FROM v_schedule WHERE trip_id IS NOT NULL AND stop_sequence IS NOT NULL AND stop_id IS NOT NULL
        AND arrival_epoch IS NOT NULL AND departure_epoch IS NOT NULL),
env AS (SELECT trip_id, min(departure_epoch) AS start_time, max(arrival_epoch) AS end_time FROM sch GROUP BY trip_id),
sch_stops AS (SELECT trip_id, list_sort(list(DISTINCT stop_id)) AS sch_stops FROM sch GROUP BY trip_id),
eta_w AS (SELECT *, min(obs_epoch) OVER w AS mn, max(obs_epoch) OVER w AS mx, max(latitude) OVER w AS mlat,
                 min(longitude) OVER w AS mlon, min(actual_start_epoch) OVER w AS mst
          FROM v_pings WINDOW w AS (PARTITION BY trip_id)),
eta_env AS (SELECT DISTINCT trip_id, license_plate, mn, mx, mlat, mlon FROM eta_w
            WHERE obs_epoch = mn OR obs_epoch = mx OR latitude = mlat OR longitude = mlon
              OR actual_start_epoch = mst),
eta_stops AS (SELECT p.trip_id, list_sort(list(DISTINCT p.last_stop_id)) AS eta_stops FROM v_pings p
              WHERE EXISTS (SELECT 1 FROM sch s WHERE s.trip_id = p.trip_id) GROUP BY p.trip_id),
prog AS (SELECT e.trip_id, e.eta_stops, s.sch_stops, list_sort(list_intersect(e.eta_stops, s.sch_stops)) AS common_stops
         FROM eta_stops e JOIN sch_stops s USING (trip_id)),
prog2 AS (SELECT *, cast(len(sch_stops) AS INTEGER) AS sch_stops_count, cast(len(eta_stops) AS INTEGER) AS eta_stops_count,
                 cast(len(common_stops) AS INTEGER) AS common_stops_count, len(common_stops) / len(sch_stops) AS percent
          FROM prog),
merged AS (SELECT env.trip_id, env.start_time, env.end_time, eta_env.license_plate, eta_env.mn, eta_env.mx,
                  eta_env.mlat, eta_env.mlon, prog2.*  EXCLUDE (trip_id),
                  abs(CASE WHEN env.end_time = env.start_time THEN NULL
                           ELSE (eta_env.mx - eta_env.mn) / (env.end_time - env.start_time) END) AS ratio
           FROM env JOIN eta_env USING (trip_id) JOIN prog2 USING (trip_id)),
classified AS (SELECT *, (end_time - start_time) / 60e0 AS trip_time,
       CASE WHEN percent < 0.6 AND ratio <= 0.6 THEN 'LIVE'
            WHEN percent < 0.6 AND ratio > 0.6 THEN 'INCOMPLETE'
            WHEN percent >= 0.6 AND abs(mx - end_time) < {LATE_S} AND abs(mn - start_time) < {LATE_S} THEN 'COMPLETED'
            WHEN (percent >= 0.6 AND abs(mx - end_time) >= {LATE_S}) OR abs(mn - start_time) >= {LATE_S} THEN 'LATE'
            ELSE 'MISSED' END AS status
       FROM merged),
unstarted AS (SELECT env.* FROM env WHERE NOT EXISTS (SELECT 1 FROM v_pings p WHERE p.trip_id = env.trip_id)),
status_all AS (
  SELECT trip_id, status, license_plate, trip_time, mx AS last_ping, end_time, mlat, mlon FROM classified
  UNION ALL
  SELECT trip_id, CASE WHEN {AS_OF} < start_time OR {AS_OF} <= end_time THEN 'NOT STARTED'
                       WHEN {AS_OF} > end_time THEN 'MISSED' END,
         NULL, NULL, NULL, end_time, NULL, NULL FROM unstarted)
"""

TRIP_STATUS_SQL = STATUS_CTE + f"""
SELECT cast(trip_id AS varchar) AS trip_id, status, license_plate, trip_time,
       coalesce(last_ping, end_time) * 1000000 AS "observationDateTime", mlat AS latitude, mlon AS longitude,
       {OBS_US} AS observe_time, cast(trip_id AS varchar) || '{DAY_TXT}' AS primary_key
FROM status_all
"""


@register("trip_status", TRIP_STATUS_SQL)
def q_trip_status(spark, sf):
    live, sch = _inputs(spark, sf)
    return P.trip_status(live, sch, AS_OF, thresholds=TH)


# ------------------------------------------------------------------ P-2, P-3, P-4
@register("trip_delay_by_status", STATUS_CTE + f""",
st AS (SELECT DISTINCT trip_id, status FROM status_all WHERE status IN ('COMPLETED', 'LIVE')),
pp AS (SELECT p.trip_id, p.trip_delay, p.license_plate, st.status FROM v_pings p JOIN st USING (trip_id)),
med AS (SELECT trip_id, status, quantile_disc(trip_delay, 0.5) AS trip_delay FROM pp GROUP BY trip_id, status)
SELECT cast(trip_id AS varchar) AS trip_id, med.trip_delay, pl.license_plate,
       cast(trip_id AS varchar) || '{AS_OF}' AS primary_key, {OBS_US} AS observe_time, status
FROM (SELECT DISTINCT trip_id, status, license_plate FROM pp) pl JOIN med USING (trip_id, status)
""")
def q_trip_delay(spark, sf):
    live, _ = _inputs(spark, sf)
    st = P.status_rows(_run(spark, sf), AS_OF)
    return P.trip_delay(st, live, ["COMPLETED", "LIVE"], AS_OF)


@register("trip_deviation_by_status", STATUS_CTE + f"""
SELECT DISTINCT cast(trip_id AS varchar) AS trip_id,
       '[' || array_to_string(eta_stops, ', ') || ']' AS eta_stops,
       '[' || array_to_string(sch_stops, ', ') || ']' AS sch_stops,
       '[' || array_to_string(common_stops, ', ') || ']' AS common_stops,
       eta_stops_count, sch_stops_count, common_stops_count, {OBS_US} AS observe_time, license_plate,
       cast(trip_id AS varchar) || '{AS_OF}' AS primary_key, status
FROM classified WHERE status IN ('COMPLETED', 'LIVE') AND eta_stops_count <> common_stops_count
""")
def q_trip_deviation(spark, sf):
    run = _run(spark, sf)
    return P.trip_deviation(run, ["COMPLETED", "LIVE"], AS_OF)


@register("scheduled_terminals", duckdb_with("v_schedule") + f""",
w AS (SELECT *, max(arrival_epoch) OVER (PARTITION BY trip_id) AS end_time,
             min(departure_epoch) OVER (PARTITION BY trip_id) AS start_time FROM v_schedule),
ext AS (SELECT * FROM w WHERE arrival_epoch = end_time OR departure_epoch = start_time),
t AS (SELECT trip_id, list(stop_id ORDER BY stop_sequence, stop_id)[1] AS start_stop,
             CASE WHEN count(*) > 1 THEN list(stop_id ORDER BY stop_sequence DESC, stop_id DESC)[1] END AS end_stop,
             min(start_time) AS start_time, min(end_time) AS end_time
      FROM ext GROUP BY trip_id)
SELECT cast(trip_id AS varchar) AS trip_id, cast(start_stop AS varchar) AS start_stop, cast(end_stop AS varchar) AS end_stop,
       start_time * 1000000 AS start_time, end_time * 1000000 AS end_time,
       cast(trip_id AS varchar) || '{DAY_TXT}' AS primary_key, {OBS_US} AS observed_time
FROM t
""")
def q_scheduled_terminals(spark, sf):
    _, sch = _inputs(spark, sf)
    return P.scheduled_terminals(sch, AS_OF)
