"""Scan / projection / join / aggregate / window / scalar keys over the
trip-related fixtures (SRC-1..4, PRJ-*, JN-1..6, AG-*, W-*, SO-*, SET-1/3, SC-*)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from citylens.catalog.q_trips import DAY_TXT, STATUS_CTE, _inputs, _run
from citylens.catalog.registry import AS_OF, OFFSET_MIN, WEEK_S, register
from citylens.functions import scalar as S
from citylens.functions import timeutil as TU
from citylens.operators import aggregates as AG
from citylens.operators import clean as C
from citylens.operators import joins as J
from citylens.operators import sets as SE
from citylens.operators import windows as W
from citylens.plans import trips as P
from citylens.sources import scans as SC
from citylens.sources.fixtures import duckdb_with, view

PINGS = duckdb_with("v_pings")
SCH = duckdb_with("v_schedule")
HIST = duckdb_with("v_status_history")
PS = duckdb_with("v_pings", "v_schedule")


def _pings(spark, sf):
    return view(spark, sf, "v_pings")


def _sch(spark, sf):
    return view(spark, sf, "v_schedule")


def _hist(spark, sf):
    return view(spark, sf, "v_status_history")


# ------------------------------------------------------------------ scans
@register("scan_window_closed", PINGS + f"""
SELECT ping_id, trip_id, obs_epoch FROM v_pings WHERE obs_epoch BETWEEN {AS_OF - WEEK_S} AND {AS_OF}""")
def q_scan_closed(spark, sf):
    return SC.scan_window(_pings(spark, sf), "obs_epoch", AS_OF - WEEK_S, AS_OF).select(
        "ping_id", "trip_id", "obs_epoch")


@register("scan_window_half_open", SCH + f"""
SELECT trip_id, stop_sequence, arrival_epoch FROM v_schedule
WHERE arrival_epoch >= {AS_OF - WEEK_S} AND arrival_epoch < {AS_OF}""")
def q_scan_half_open(spark, sf):
    return SC.scan_window(_sch(spark, sf), "arrival_epoch", AS_OF - WEEK_S, AS_OF, closed=False).select(
        "trip_id", "stop_sequence", "arrival_epoch")


@register("scan_window_status", HIST + """
SELECT trip_id, cast(floor(epoch(observe_ts)) AS bigint) AS observe_epoch FROM v_status_history
WHERE observe_ts BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1997-12-31 00:00:00' AND status = 'COMPLETED'""")
def q_scan_status(spark, sf):
    df = SC.scan_status(_hist(spark, sf), "observe_ts", "COMPLETED", datetime(1996, 1, 1), datetime(1997, 12, 31))
    return df.select("trip_id", TU.epoch_seconds("observe_ts").alias("observe_epoch"))


@register("scan_full", duckdb_with("v_routes") + "SELECT point_id, route_id, latitude, longitude FROM v_routes")
def q_scan_full(spark, sf):
    view(spark, sf, "v_routes").createOrReplaceTempView("citylens_bus_route")
    return SC.scan_full(spark, "citylens_bus_route").select("point_id", "route_id", "latitude", "longitude")


# ------------------------------------------------------------------ projections / filters
@register("project_swap_latlon", PINGS + """
SELECT ping_id, trip_id, longitude AS latitude, latitude AS longitude FROM v_pings""")
def q_swap(spark, sf):
    return C.normalise_pings(_pings(spark, sf), ["ping_id", "trip_id"], swapped=True)


@register("cast_lenient", PINGS + """
SELECT ping_id, TRY_CAST(substr(route_id, 2) AS INTEGER) AS route_no, TRY_CAST(license_plate AS INTEGER) AS plate_no,
       TRY_CAST(vehicle_label AS BIGINT) AS vehicle_no FROM v_pings""")
def q_cast(spark, sf):
    df = _pings(spark, sf).select("ping_id", F.expr("substring(route_id, 2)").alias("route_no"),
                                  F.col("license_plate").alias("plate_no"), F.col("vehicle_label").alias("vehicle_no"))
    return C.cast_cols(df, {"route_no": "int", "plate_no": "int", "vehicle_no": "bigint"})


@register("drop_null_rows", STATUS_CTE + """
SELECT trip_id, status, license_plate, mlat AS latitude FROM status_all
WHERE trip_id IS NOT NULL AND status IS NOT NULL AND license_plate IS NOT NULL AND mlat IS NOT NULL""")
def q_dropna(spark, sf):
    c = _run(spark, sf).classified.select("trip_id", "status", "license_plate",
                                          F.col("max_latitude").alias("latitude"))
    return C.drop_null_rows(c)


@register("filter_by_category", HIST + """
SELECT trip_id, status FROM v_status_history WHERE status = 'COMPLETED'""")
def q_filter_cat(spark, sf):
    return C.filter_by(_hist(spark, sf), "status", "COMPLETED").select("trip_id", "status")


@register("filter_recent", STATUS_CTE + f"""
SELECT cast(trip_id AS varchar) AS trip_id, status, license_plate, coalesce(last_ping, end_time) * 1000000 AS "observationDateTime"
FROM status_all WHERE coalesce(last_ping, end_time) * 1000000 >= {(AS_OF - WEEK_S) * 1_000_000}""")
def q_recent(spark, sf):
    st = P.status_rows(_run(spark, sf), AS_OF).select("trip_id", "status", "license_plate", "observationDateTime")
    return C.recent(st, "observationDateTime", AS_OF, minutes=WEEK_S // 60)


@register("filter_extreme_rows", SCH + """,
w AS (SELECT *, max(arrival_epoch) OVER (PARTITION BY trip_id) AS mx, min(departure_epoch) OVER (PARTITION BY trip_id) AS mn
      FROM v_schedule)
SELECT trip_id, stop_sequence, stop_id FROM w WHERE arrival_epoch = mx OR departure_epoch = mn""")
def q_extreme(spark, sf):
    return C.extreme_rows(_sch(spark, sf), ["trip_id"], {"mx": ("max", "arrival_epoch"),
                                                          "mn": ("min", "departure_epoch")}).select(
        "trip_id", "stop_sequence", "stop_id")


# ------------------------------------------------------------------ joins
ENV_SQL = """env AS (SELECT trip_id, min(departure_epoch) AS start_time, max(arrival_epoch) AS end_time
                     FROM v_schedule GROUP BY trip_id)"""
PLATES_SQL = """eta_w AS (SELECT *, min(obs_epoch) OVER w AS first_ping, max(obs_epoch) OVER w AS last_ping,
                 max(latitude) OVER w AS max_latitude, min(longitude) OVER w AS min_longitude,
                 min(actual_start_epoch) OVER w AS actual_start
                 FROM v_pings WINDOW w AS (PARTITION BY trip_id)),
plates AS (SELECT DISTINCT trip_id, license_plate, first_ping, last_ping, max_latitude, min_longitude, actual_start FROM eta_w
           WHERE obs_epoch = first_ping OR obs_epoch = last_ping OR latitude = max_latitude OR longitude = min_longitude
              OR actual_start_epoch = actual_start)"""


@register("join_inner_chain", PS + f""", {ENV_SQL}, {PLATES_SQL}
SELECT trip_id, license_plate, start_time, end_time, first_ping, last_ping FROM env JOIN plates USING (trip_id)""")
def q_inner_chain(spark, sf):
    live, sch = _inputs(spark, sf)
    env = P.timetable_envelope(sch).drop("sch_stops")
    pl = P.plate_envelope(live).select("trip_id", "license_plate", "first_ping", "last_ping")
    return J.inner_chain(env, pl)


@register("join_left_anti_from_null", PS + f""", {ENV_SQL}
SELECT trip_id, start_time, end_time FROM env e WHERE NOT EXISTS (SELECT 1 FROM v_pings p WHERE p.trip_id = e.trip_id)""")
def q_anti(spark, sf):
    live, sch = _inputs(spark, sf)
    return J.unmatched(P.timetable_envelope(sch).drop("sch_stops"), live)


@register("join_left_enrich", PINGS + """, v_status_history AS (""" + HIST[len("WITH v_status_history AS ("):].rstrip("\n") + """
SELECT h.trip_id, pl.license_plate FROM v_status_history h
LEFT JOIN (SELECT DISTINCT trip_id, license_plate FROM v_pings) pl USING (trip_id) WHERE h.status = 'LATE'""")
def q_enrich(spark, sf):
    late = C.filter_by(_hist(spark, sf), "status", "LATE").select("trip_id")
    pl = _pings(spark, sf).select("trip_id", "license_plate").distinct()
    return J.enrich(late, pl)


@register("join_full_outer", PS + """
SELECT coalesce(a.trip_id, b.trip_id) AS trip_id, a.n_pings, b.n_stops
FROM (SELECT trip_id, count(*) AS n_pings FROM v_pings GROUP BY trip_id) a
FULL OUTER JOIN (SELECT trip_id, count(*) AS n_stops FROM v_schedule GROUP BY trip_id) b ON a.trip_id = b.trip_id""")
def q_outer(spark, sf):
    live, sch = _inputs(spark, sf)
    return J.merge_outer(AG.count_by(live, ["trip_id"], "n_pings"), AG.count_by(sch, ["trip_id"], "n_stops"))


@register("join_semi_existence", PINGS + """, v_status_history AS (""" + HIST[len("WITH v_status_history AS ("):].rstrip("\n") + """
SELECT ping_id, trip_id FROM v_pings p
WHERE EXISTS (SELECT 1 FROM v_status_history h WHERE h.trip_id = p.trip_id AND h.status = 'COMPLETED')""")
def q_semi(spark, sf):
    done = C.filter_by(_hist(spark, sf), "status", "COMPLETED")
    return J.existing(_pings(spark, sf), done).select("ping_id", "trip_id")


# ------------------------------------------------------------------ aggregates
@register("agg_collect_stops", SCH + """
SELECT trip_id, cast(len(list(DISTINCT stop_id)) AS INTEGER) AS n_stops,
       '[' || array_to_string(list_sort(list(DISTINCT stop_id)), ', ') || ']' AS stops
FROM v_schedule GROUP BY trip_id""")
def q_collect(spark, sf):
    st = AG.collect_sorted_set(_sch(spark, sf), ["trip_id"], "stop_id", "stops")
    return st.select("trip_id", F.size("stops").alias("n_stops"), S.array_text("stops").alias("stops"))


@register("agg_first_last_stop", SCH + """
SELECT trip_id, list(stop_id ORDER BY stop_sequence, stop_id)[1] AS first_stop,
       list(stop_id ORDER BY stop_sequence DESC, stop_id DESC)[1] AS last_stop FROM v_schedule GROUP BY trip_id""")
def q_first_last(spark, sf):
    return AG.first_last_by(_sch(spark, sf), ["trip_id"], "stop_id", "stop_sequence", "first_stop", "last_stop")


@register("agg_conditional_count", PINGS + """
SELECT trip_id, license_plate, count(*) FILTER (WHERE trip_delay > 25) AS high_delay,
       count(*) FILTER (WHERE trip_delay <= 25) AS low_delay FROM v_pings GROUP BY trip_id, license_plate""")
def q_cond_count(spark, sf):
    return AG.conditional_counts(_pings(spark, sf), ["trip_id", "license_plate"],
                                 {"high_delay": F.col("trip_delay") > 25, "low_delay": F.col("trip_delay") <= 25})


@register("agg_global_minmax", PINGS + """
SELECT min(obs_epoch) AS lo, max(obs_epoch) AS hi FROM v_pings""")
def q_minmax(spark, sf):
    return AG.global_minmax(_pings(spark, sf), "obs_epoch")


@register("agg_dedup_subset", PINGS + """
SELECT trip_id, license_plate, arg_min(obs_epoch, (obs_epoch, ping_id)) AS obs_epoch,
       arg_min(ping_id, (obs_epoch, ping_id)) AS ping_id FROM v_pings GROUP BY trip_id, license_plate""")
def q_dedup(spark, sf):
    df = _pings(spark, sf).select("trip_id", "license_plate", "obs_epoch", "ping_id")
    return AG.dedup_first(df, ["trip_id", "license_plate"], ["obs_epoch", "ping_id"])


@register("agg_distinct", PINGS + "SELECT DISTINCT route_id, trip_direction FROM v_pings")
def q_distinct(spark, sf):
    return _pings(spark, sf).select("route_id", "trip_direction").distinct()


@register("agg_trip_envelope", SCH + f""", {ENV_SQL} SELECT * FROM env""")
def q_envelope(spark, sf):
    return P.timetable_envelope(_sch(spark, sf)).drop("sch_stops")


@register("agg_live_envelope", PINGS + f""", {PLATES_SQL} SELECT * FROM plates""")
def q_live_env(spark, sf):
    return P.plate_envelope(_pings(spark, sf)).drop("eta_stops")


@register("agg_median_delay", PINGS + """,
med AS (SELECT trip_id, quantile_disc(trip_delay, 0.5) AS trip_delay FROM v_pings GROUP BY trip_id)
SELECT DISTINCT p.trip_id, p.license_plate, med.trip_delay FROM v_pings p JOIN med USING (trip_id)""")
def q_median(spark, sf):
    live = _pings(spark, sf)
    all_trips = live.select("trip_id", F.lit("LIVE").alias("status")).distinct()
    return P.trip_delay(all_trips, live, "LIVE", AS_OF).select(
        F.col("trip_id").cast("long").alias("trip_id"), "license_plate", "trip_delay")


PROGRESS_SQL = """ss AS (SELECT trip_id, list_sort(list(DISTINCT stop_id)) AS sch_stops FROM v_schedule GROUP BY trip_id),
es AS (SELECT trip_id, list_sort(list(DISTINCT last_stop_id)) AS eta_stops FROM v_pings GROUP BY trip_id),
prog AS (SELECT trip_id, sch_stops, eta_stops, list_sort(list_intersect(eta_stops, sch_stops)) AS common_stops
         FROM ss JOIN es USING (trip_id))"""


def _progress(spark, sf):
    live, sch = _inputs(spark, sf)
    env = P.timetable_envelope(sch)
    es = AG.collect_sorted_set(live, ["trip_id"], "last_stop_id", "eta_stops")
    return P.stop_progress(env.join(es, "trip_id"))


@register("agg_common_stop_ratio", PS + f""", {PROGRESS_SQL}
SELECT trip_id, cast(len(sch_stops) AS INTEGER) AS sch_stops_count, cast(len(eta_stops) AS INTEGER) AS eta_stops_count,
       cast(len(common_stops) AS INTEGER) AS common_stops_count, len(common_stops) / len(sch_stops) AS percent FROM prog""")
def q_progress(spark, sf):
    return _progress(spark, sf).select("trip_id", "sch_stops_count", "eta_stops_count", "common_stops_count", "percent")


@register("set_array_intersect", PS + f""", {PROGRESS_SQL}
SELECT trip_id, '[' || array_to_string(common_stops, ', ') || ']' AS common_stops FROM prog""")
def q_intersect(spark, sf):
    return _progress(spark, sf).select("trip_id", S.array_text("common_stops").alias("common_stops"))


@register("cond_deviation_flag", PS + f""", {PROGRESS_SQL}
SELECT trip_id, CASE WHEN len(eta_stops) = len(common_stops) THEN 0 ELSE 1 END AS deviation_status FROM prog""")
def q_dev_flag(spark, sf):
    return _progress(spark, sf).select("trip_id", S.deviates("eta_stops_count", "common_stops_count")
                                       .alias("deviation_status"))


@register("str_array_text", PINGS + """
SELECT trip_id, '[' || array_to_string(list_sort(list(DISTINCT last_stop_id)), ', ') || ']' AS eta_stops
FROM v_pings GROUP BY trip_id""")
def q_arr_text(spark, sf):
    es = AG.collect_sorted_set(_pings(spark, sf), ["trip_id"], "last_stop_id", "eta_stops")
    return es.select("trip_id", S.array_text("eta_stops").alias("eta_stops"))


@register("arr_size_get", SCH + """,
ss AS (SELECT trip_id, list_sort(list(DISTINCT stop_id)) AS s FROM v_schedule GROUP BY trip_id)
SELECT trip_id, cast(len(s) AS INTEGER) AS n_stops, s[1] AS first_stop, s[2] AS second_stop, s[101] AS stop_100 FROM ss""")
def q_size_get(spark, sf):
    st = AG.collect_sorted_set(_sch(spark, sf), ["trip_id"], "stop_id", "s")
    return st.select("trip_id", F.size("s").alias("n_stops"), S.element("s", 0).alias("first_stop"),
                     S.element("s", 1).alias("second_stop"), S.element("s", 100).alias("stop_100"))


# ------------------------------------------------------------------ windows
@register("win_partition_minmax", SCH + """
SELECT trip_id, stop_sequence, max(arrival_epoch) OVER (PARTITION BY trip_id) AS end_time,
       min(departure_epoch) OVER (PARTITION BY trip_id) AS start_time FROM v_schedule""")
def q_win_minmax(spark, sf):
    df = _sch(spark, sf)
    return W.partition_minmax(df, ["trip_id"], {"end_time": ("max", "arrival_epoch"),
                                                "start_time": ("min", "departure_epoch")}).select(
        "trip_id", "stop_sequence", "end_time", "start_time")


@register("win_lag_gap", PINGS + """
SELECT ping_id, obs_epoch - lag(obs_epoch) OVER (PARTITION BY trip_id, vehicle_label ORDER BY obs_epoch, ping_id) AS gap
FROM v_pings""")
def q_lag(spark, sf):
    return W.gap_seconds(_pings(spark, sf), ["trip_id", "vehicle_label"], "obs_epoch", "ping_id").select(
        "ping_id", "gap")


@register("win_percentile", PINGS + """
SELECT ping_id, trip_id, quantile_disc(trip_delay, 0.5) OVER (PARTITION BY trip_id) AS median FROM v_pings""")
def q_win_pct(spark, sf):
    return W.percentile_over(_pings(spark, sf), ["trip_id"], "trip_delay").select("ping_id", "trip_id", "median")


@register("win_surrogate_key", PINGS + """
SELECT ping_id, sha256(concat_ws(chr(1), cast(ping_id AS varchar), cast(trip_id AS varchar),
                                  cast(obs_epoch AS varchar))) AS primary_key FROM v_pings""")
def q_key(spark, sf):
    return _pings(spark, sf).select("ping_id", W.surrogate_key("ping_id", "trip_id", "obs_epoch").alias("primary_key"))


# ------------------------------------------------------------------ sorts, sets
@register("sort_total", PINGS + "SELECT ping_id, obs_epoch FROM v_pings ORDER BY obs_epoch DESC, ping_id")
def q_sort(spark, sf):
    return _pings(spark, sf).select("ping_id", "obs_epoch").orderBy(F.desc("obs_epoch"), "ping_id")


@register("sort_multi_key", SCH + """
SELECT trip_id, '[' || array_to_string(list(stop_id ORDER BY stop_sequence, stop_id), ', ') || ']' AS stop_order
FROM v_schedule GROUP BY trip_id""")
def q_sort_multi(spark, sf):
    ordered = _sch(spark, sf).groupBy("trip_id").agg(
        F.array_sort(F.collect_list(F.struct("stop_sequence", "stop_id"))).alias("s"))
    return ordered.select("trip_id", S.array_text(F.transform("s", lambda x: x["stop_id"])).alias("stop_order"))


@register("set_union_all", PINGS + """
SELECT ping_id, trip_direction FROM v_pings WHERE trip_direction = 'UP'
UNION ALL SELECT ping_id, trip_direction FROM v_pings WHERE trip_direction = 'DN'""")
def q_union(spark, sf):
    p = _pings(spark, sf).select("ping_id", "trip_direction")
    return SE.union_all(p.where(F.col("trip_direction") == "UP"), p.where(F.col("trip_direction") == "DN"))


# ------------------------------------------------------------------ scalar
@register("str_concat_key", HIST + f"""
SELECT trip_id, cast(trip_id AS varchar) || '{DAY_TXT}' AS daily_key, cast(trip_id AS varchar) || '{AS_OF}' AS run_key
FROM v_status_history""")
def q_keys(spark, sf):
    return _hist(spark, sf).select("trip_id", S.daily_key("trip_id", AS_OF).alias("daily_key"),
                                   S.run_key("trip_id", AS_OF).alias("run_key"))


@register("str_concat_ws_coalesce", PS + f""", {ENV_SQL}
SELECT e.trip_id, coalesce(l.last_ping, e.end_time) AS "observationDateTime" FROM env e
LEFT JOIN (SELECT trip_id, max(obs_epoch) AS last_ping FROM v_pings GROUP BY trip_id) l USING (trip_id)""")
def q_coalesce(spark, sf):
    live, sch = _inputs(spark, sf)
    last = live.groupBy("trip_id").agg(F.max("obs_epoch").alias("last_ping"))
    env = J.enrich(P.timetable_envelope(sch), last)
    return env.select("trip_id", S.first_present("last_ping", "end_time").alias("observationDateTime"))


@register("dt_epoch_seconds", PINGS + """
SELECT ping_id, cast(floor(epoch(obs_ts)) AS bigint) AS epoch_s,
       cast(floor(epoch(to_timestamp(obs_epoch)::timestamp)) AS bigint) AS round_trip FROM v_pings""")
def q_epoch(spark, sf):
    p = _pings(spark, sf)
    return p.select("ping_id", TU.epoch_seconds("obs_ts").alias("epoch_s"),
                    TU.epoch_seconds(TU.from_epoch_seconds("obs_epoch")).alias("round_trip"))


@register("dt_epoch_micros_offset", PINGS + f"""
SELECT ping_id, epoch_us(obs_ts + INTERVAL {OFFSET_MIN} MINUTE) AS observe_us,
       epoch_us(make_timestamp({AS_OF * 1_000_000}) + INTERVAL {OFFSET_MIN} MINUTE) AS run_us FROM v_pings""")
def q_micros(spark, sf):
    p = _pings(spark, sf)
    return p.select("ping_id", F.unix_micros(F.col("obs_ts") + F.make_dt_interval(mins=F.lit(OFFSET_MIN)))
                    .alias("observe_us"), TU.observe_time_micros(AS_OF, OFFSET_MIN).alias("run_us"))


@register("dt_minutes_between", PINGS + """
SELECT trip_id, (max(obs_epoch) - min(obs_epoch)) / 60e0 AS minutes FROM v_pings GROUP BY trip_id""")
def q_minutes(spark, sf):
    g = _pings(spark, sf).groupBy("trip_id").agg(F.max("obs_epoch").alias("b"), F.min("obs_epoch").alias("a"))
    return g.select("trip_id", TU.minutes_between("b", "a").alias("minutes"))


@register("dt_hour_of_week", PINGS + """
SELECT ping_id, cast((isodow(make_timestamp(obs_epoch * 1000000)) - 1) * 24 + hour(make_timestamp(obs_epoch * 1000000))
                     AS integer) AS time_slot FROM v_pings""")
def q_how(spark, sf):
    return _pings(spark, sf).select("ping_id", TU.hour_of_week("obs_epoch").alias("time_slot"))


_SPECS = ["day", "15m", "4hh", "7d", "2w", "3d@", "1w@"]


def _bounds_sql():
    midnight, clock = AS_OF // 86400 * 86400, 5 * 3600 + 30 * 60
    bounds = {"day": midnight + clock, "15m": AS_OF - 900, "4hh": AS_OF // 3600 * 3600 - 4 * 3600, "7d": AS_OF - 7 * 86400,
              "2w": AS_OF - 14 * 86400, "3d@": midnight - 3 * 86400 + clock, "1w@": midnight - 7 * 86400 + clock}
    parts = []
    for spec in _SPECS:
        a, b = bounds[spec], AS_OF // 3600 * 3600 if spec == "4hh" else AS_OF
        parts.append(f"SELECT '{spec}' AS spec, {a} AS start_s, {b} AS end_s, count(*) AS n FROM v_pings "
                     f"WHERE obs_epoch BETWEEN {a} AND {b}")
    return PINGS + "\nUNION ALL\n".join(parts)


@register("dt_window_bounds", _bounds_sql())
def q_bounds(spark, sf):
    p = _pings(spark, sf)
    outs = []
    for spec in _SPECS:
        a, b = TU.window_bounds(AS_OF, spec, "05:30:00")
        outs.append(SC.scan_window(p, "obs_epoch", a, b).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(spec).alias("spec"), F.lit(a).alias("start_s"), F.lit(b).alias("end_s"), "n"))
    return SE.union_all(*outs)


@register("math_scale_unscale", PINGS + """
SELECT ping_id, (trip_delay + 1) / 501e0 AS scaled, ((trip_delay + 1) / 501e0) * 501e0 - 1 AS unscaled,
       CASE WHEN trip_delay - 20 < 0 THEN -1e0 ELSE trip_delay - 20 END AS cleaned FROM v_pings""")
def q_scale(spark, sf):
    p = _pings(spark, sf)
    return p.select("ping_id", S.scale("trip_delay").alias("scaled"), S.unscale(S.scale("trip_delay")).alias("unscaled"),
                    S.clean_negative(F.col("trip_delay") - 20).alias("cleaned"))


@register("math_euclid", PINGS + """,
g AS (SELECT trip_id, arg_min(latitude, (obs_epoch, ping_id)) AS lat0, arg_min(longitude, (obs_epoch, ping_id)) AS lon0,
             arg_max(latitude, (obs_epoch, ping_id)) AS lat1, arg_max(longitude, (obs_epoch, ping_id)) AS lon1,
             max(obs_epoch) - min(obs_epoch) AS travel_time FROM v_pings GROUP BY trip_id)
SELECT trip_id, sqrt(pow(lat0 - lat1, 2) + pow(lon0 - lon1, 2)) AS dist,
       CASE WHEN travel_time = 0 THEN NULL ELSE sqrt(pow(lat0 - lat1, 2) + pow(lon0 - lon1, 2)) / travel_time END AS speed
FROM g""")
def q_euclid(spark, sf):
    o = F.struct("obs_epoch", "ping_id")
    pt = F.struct("latitude", "longitude")
    g = _pings(spark, sf).groupBy("trip_id").agg(F.min_by(pt, o).alias("a"), F.max_by(pt, o).alias("b"),
                                                 (F.max("obs_epoch") - F.min("obs_epoch")).alias("tt"))
    d = S.euclid("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    return g.select("trip_id", d.alias("dist"), F.try_divide(d, F.col("tt").cast("double")).alias("speed"))


@register("cond_trip_status", STATUS_CTE + """
SELECT DISTINCT trip_id, status FROM classified""")
def q_cond_status(spark, sf):
    c = _run(spark, sf).classified
    return c.where(F.col("first_ping").isNotNull()).select("trip_id", "status").distinct()


@register("cond_trip_status_unstarted", STATUS_CTE + f"""
SELECT trip_id, CASE WHEN {AS_OF} < start_time OR {AS_OF} <= end_time THEN 'NOT STARTED'
                     WHEN {AS_OF} > end_time THEN 'MISSED' END AS status FROM unstarted""")
def q_cond_unstarted(spark, sf):
    c = _run(spark, sf).classified
    return c.where(F.col("first_ping").isNull()).select("trip_id", "status")
