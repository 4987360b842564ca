"""Dwell (P-5..P-7), road segments (P-8) and air-quality surface (P-12) keys."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from citylens.catalog.hexsql import cell_sql, polygon_json_sql, q_sql, r_sql
from citylens.catalog.q_spatial import NEAREST, REGION_CELLS, RES, SLOT_S, TRAIN, v, with_, _region_cells
from citylens.catalog.registry import AS_OF, OFFSET_MIN, register
from citylens.functions import hexgrid as H
from citylens.functions import scalar as S
from citylens.operators import spatial as SP
from citylens.operators import windows as W
from citylens.plans import dwell as D
from citylens.plans import segments as SG
from citylens.plans import surface as SU
from citylens.session import ensure_checkpoint_dir
from citylens.sources import sinks as K
from citylens.sources.fixtures import duckdb_text, read_table

CO, ME, FI = H.COARSE, H.MEDIUM, H.FINE
OBS_US = (AS_OF + OFFSET_MIN * 60) * 1_000_000
HOW = "cast((isodow(make_timestamp({e} * 1000000)) - 1) * 24 + hour(make_timestamp({e} * 1000000)) AS integer)"


def dwell_rows_sql(lo=None, hi=None, name="drows") -> str:
    where = f"WHERE obs_epoch BETWEEN {lo} AND {hi}" if lo is not None else ""
    return f"""{name}_p AS (SELECT *, {cell_sql('latitude', 'longitude', CO)} AS cell FROM v_pings {where}),
{name}_w AS (SELECT *, max(obs_epoch) OVER g - min(obs_epoch) OVER g AS dwell_time,
                row_number() OVER (PARTITION BY trip_id, route_id, cell ORDER BY obs_epoch DESC, ping_id DESC) AS rn
             FROM {name}_p WINDOW g AS (PARTITION BY trip_id, route_id, cell)),
{name} AS (SELECT *, {HOW.format(e='obs_epoch')} AS time_slot FROM {name}_w WHERE rn > 1)"""


MODEL_SQL = dwell_rows_sql(*TRAIN, name="trows") + """,
tmeans AS (SELECT cell, route_id, time_slot, avg(dwell_time) AS dwell_time FROM trows GROUP BY ALL),
tg AS (SELECT cell, route_id, covar_pop(dwell_time, time_slot) AS c, var_pop(time_slot) AS v, avg(time_slot) AS mx,
              avg(dwell_time) AS my, count(*) AS n_slots FROM tmeans GROUP BY ALL),
model AS (SELECT route_id, cell, CASE WHEN v > 0 THEN sign(c) * greatest(abs(c) - 1e0, 0e0) / v ELSE 0e0 END AS coef,
                 my, mx, n_slots FROM tg),
model2 AS (SELECT route_id, cell, coef, my - coef * mx AS intercept, n_slots FROM model)"""


def _rows(spark, sf, window=(None, None)):
    return D.cell_dwell_rows(v(spark, sf, "v_pings"), window)


def _model(spark, sf):
    return D.cell_dwell_model(v(spark, sf, "v_pings"), AS_OF)


def _r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


# ------------------------------------------------------------------ dwell windows
@register("win_dwell_in_cell", with_("v_pings") + f"""
SELECT ping_id, cell, max(obs_epoch) OVER g - min(obs_epoch) OVER g AS dwell_time
FROM (SELECT *, {cell_sql('latitude', 'longitude', CO)} AS cell FROM v_pings) WINDOW g AS (PARTITION BY trip_id, route_id, cell)""")
def q_dwell_in_cell(spark, sf):
    p = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO)
    return W.span_over(p, D.DWELL_KEYS, "obs_epoch").select("ping_id", "cell", "dwell_time")


@register("win_drop_latest", with_("v_pings", extra=dwell_rows_sql()) + "\nSELECT ping_id, cell FROM drows")
def q_drop_latest(spark, sf):
    p = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO)
    return W.drop_latest(p.select("ping_id", "obs_epoch", *D.DWELL_KEYS), D.DWELL_KEYS, ["obs_epoch", "ping_id"]).select(
        "ping_id", "cell")


@register("cond_cap_sentinel", with_("v_pings", extra=dwell_rows_sql()) + """
SELECT ping_id, CASE WHEN dwell_time > 259200 THEN -1e0 ELSE dwell_time END AS dwell_capped FROM drows""")
def q_cap(spark, sf):
    return _rows(spark, sf).select("ping_id", S.cap_sentinel("dwell_time", 259200).cast("double").alias("dwell_capped"))


@register("agg_avg_by_slot", with_("v_pings", extra=dwell_rows_sql(*TRAIN)) + """
SELECT cell, route_id, time_slot, round(avg(dwell_time), 6) AS dwell_time FROM drows GROUP BY ALL""")
def q_avg_slot(spark, sf):
    return _r6(D.slot_means(_rows(spark, sf, TRAIN)), "dwell_time")


@register("agg_lasso_fit", with_("v_pings", extra=dwell_rows_sql()) + """,
means AS (SELECT cell, route_id, time_slot, avg(dwell_time) AS y FROM drows GROUP BY ALL),
g AS (SELECT cell, route_id, covar_pop(y, time_slot) AS c, var_pop(time_slot) AS v, avg(time_slot) AS mx, avg(y) AS my,
             count(*) AS n_slots FROM means GROUP BY ALL),
m AS (SELECT *, CASE WHEN v > 0 THEN sign(c) * greatest(abs(c) - 1e0, 0e0) / v ELSE 0e0 END AS coef FROM g)
SELECT route_id, cell, round(coef, 6) AS coef, round(my - coef * mx, 6) AS intercept, n_slots FROM m""")
def q_lasso(spark, sf):
    return _r6(D.fit_slot_lasso(D.slot_means(_rows(spark, sf))), "coef", "intercept")


@register("cell_dwell_model", with_("v_pings", extra=MODEL_SQL) + """
SELECT route_id, cell, round(coef, 6) AS coef, round(intercept, 6) AS intercept, n_slots FROM model2""")
def q_model(spark, sf):
    return _r6(_model(spark, sf), "coef", "intercept")


@register("sink_model_table", with_("v_pings", extra=MODEL_SQL) + """
SELECT route_id, cell, round(coef, 6) AS coef, round(intercept, 6) AS intercept, n_slots FROM model2""")
def q_model_sink(spark, sf):
    from citylens.sources.sinks import load_model, save_model
    path = save_model(_model(spark, sf), spark)
    return _r6(load_model(spark, path), "coef", "intercept")


SCORED = MODEL_SQL + "," + dwell_rows_sql() + """,
scored AS (SELECT d.*, m.coef, m.intercept, m.intercept + m.coef * d.time_slot AS predicted_dwell_time
           FROM drows d LEFT JOIN model2 m USING (route_id, cell))"""


@register("join_model_lookup", with_("v_pings", extra=SCORED) + """
SELECT ping_id, round(predicted_dwell_time, 6) AS predicted_dwell_time FROM scored""")
def q_lookup(spark, sf):
    s = D.score(_rows(spark, sf), _model(spark, sf))
    return _r6(s.select("ping_id", "predicted_dwell_time"), "predicted_dwell_time")


@register("cell_delay", with_("v_pings", extra=SCORED) + f"""
SELECT cast(ping_id AS varchar) AS primary_key, obs_epoch * 1000000 AS "observationDateTime",
       cast(trip_id AS varchar) AS trip_id, route_id, trip_direction, cell, license_plate,
       cast(dwell_time AS double) AS dwell_time, cast(time_slot AS varchar) AS time_slot,
       {polygon_json_sql('cell', CO)} AS geojson, round(predicted_dwell_time, 6) AS predicted_dwell_time,
       round(dwell_time - predicted_dwell_time, 6) AS delay FROM scored""")
def q_cell_delay(spark, sf):
    out = D.cell_delay(v(spark, sf, "v_pings"), _model(spark, sf), AS_OF)
    return _r6(out, "predicted_dwell_time", "delay")


# ------------------------------------------------------------------ forecast
END = (AS_OF // SLOT_S) * SLOT_S
START = END - 4 * SLOT_S
PANEL_SQL = dwell_rows_sql() + "," + REGION_CELLS + f""",
obs AS (SELECT cell, trip_direction, cast(floor((obs_epoch - {START}) / {SLOT_S}) AS integer) AS slot,
               avg(dwell_time) AS mean_dwell FROM drows
        WHERE obs_epoch >= {START} AND obs_epoch < {END} AND trip_direction IN ('DN', 'UP') GROUP BY ALL),
skel AS (SELECT cell, d.dir AS trip_direction, cast(s.slot AS integer) AS slot
         FROM (SELECT DISTINCT cell FROM regc), (VALUES ('DN'), ('UP')) d(dir), range(4) s(slot)),
panel AS (SELECT skel.*, coalesce(obs.mean_dwell, -1e0) AS mean_dwell FROM skel LEFT JOIN obs USING (cell, trip_direction, slot)),
rc AS (SELECT DISTINCT cell FROM regc),
nb AS (SELECT a.cell, b.cell AS nb FROM rc a, rc b
       WHERE (abs({q_sql('b.cell')} - {q_sql('a.cell')}) + abs({r_sql('b.cell')} - {r_sql('a.cell')})
              + abs({q_sql('b.cell')} - {q_sql('a.cell')} + {r_sql('b.cell')} - {r_sql('a.cell')})) / 2 <= 1),
deg AS (SELECT cell, cast(count(*) * 2 + 1 AS double) AS deg FROM nb GROUP BY cell),
sp AS (SELECT cell, trip_direction, slot, (mean_dwell + 1e0) / 501e0 AS x FROM panel),
sums AS (SELECT nb.cell, sp.slot, sum(sp.x / sqrt(da.deg * db.deg)) AS s FROM nb JOIN sp ON sp.cell = nb.nb
         JOIN deg da ON da.cell = nb.cell JOIN deg db ON db.cell = nb.nb GROUP BY ALL),
sm AS (SELECT sp.cell, sp.trip_direction, sp.slot, sums.s + sp.x / deg.deg AS smoothed
       FROM sp JOIN sums USING (cell, slot) JOIN deg USING (cell))"""


@register("agg_hourly_panel", with_("v_pings", "v_region", extra=PANEL_SQL) + """
SELECT cell, trip_direction, slot, round(mean_dwell, 6) AS mean_dwell FROM panel""")
def q_panel(spark, sf):
    p = D.hourly_panel(_rows(spark, sf), _region_cells(spark, sf), AS_OF, 4, SLOT_S)
    return _r6(p, "mean_dwell")


@register("join_cell_neighbours", with_("v_pings") + f""",
pc AS (SELECT DISTINCT {cell_sql('latitude', 'longitude', CO)} AS cell FROM v_pings)
SELECT a.cell, b.cell AS nb FROM pc a, pc b
WHERE (abs({q_sql('b.cell')} - {q_sql('a.cell')}) + abs({r_sql('b.cell')} - {r_sql('a.cell')})
       + abs({q_sql('b.cell')} - {q_sql('a.cell')} + {r_sql('b.cell')} - {r_sql('a.cell')})) / 2 <= 1""")
def q_neighbours(spark, sf):
    cells = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO).select("cell")
    return SP.present_neighbours(cells, 1).select("cell", "nb")


@register("agg_neighbour_smooth", with_("v_pings", "v_region", extra=PANEL_SQL) + """
SELECT cell, trip_direction, slot, round(smoothed, 6) AS smoothed FROM sm""")
def q_smooth(spark, sf):
    p = D.hourly_panel(_rows(spark, sf), _region_cells(spark, sf), AS_OF, 4, SLOT_S)
    return _r6(D.graph_smooth(p.withColumn("mean_dwell", S.scale("mean_dwell"))), "smoothed")


@register("cell_dwell_forecast", with_("v_pings", "v_region", extra=PANEL_SQL) + f""",
z AS (SELECT cell, trip_direction, sum(smoothed * [0.1e0, 0.2e0, 0.3e0, 0.4e0][slot + 1]) AS z FROM sm GROUP BY ALL)
SELECT {(AS_OF + 270 * 60) * 1_000_000} AS "observationDateTime", cell, trip_direction,
       round(CASE WHEN z * 501e0 - 1e0 < 0 THEN -1e0 ELSE z * 501e0 - 1e0 END, 6) AS predicted_dwell_time,
       sha256(concat_ws(chr(1), '{AS_OF}', cast(cell AS varchar), trip_direction)) AS primary_key FROM z""")
def q_forecast(spark, sf):
    out = D.cell_dwell_forecast(_rows(spark, sf), _region_cells(spark, sf), AS_OF, 4, SLOT_S)
    return _r6(out, "predicted_dwell_time")


# ------------------------------------------------------------------ segments (P-8)
COVER_SQL = f"""sl AS (SELECT *, lead(latitude) OVER w AS la, lead(longitude) OVER w AS lo FROM v_segment_vertices
       WINDOW w AS (PARTITION BY segment_id ORDER BY vseq)),
sn AS (SELECT *, coalesce(greatest(cast(ceil(greatest(abs(la - latitude) * {FI.ky!r}, abs(lo - longitude) * {FI.kx!r}) / {FI.edge_m / 2.0!r}) AS integer), 1), 1)
         AS n FROM sl),
sk AS (SELECT *, unnest(range(0, n)) AS k FROM sn),
sv AS (SELECT segment_id, coalesce(latitude + (la - latitude) * k / n, latitude) AS latitude,
              coalesce(longitude + (lo - longitude) * k / n, longitude) AS longitude FROM sk),
cov AS (SELECT DISTINCT {cell_sql('latitude', 'longitude', FI)} AS vcell, segment_id FROM sv)"""
SNAP_SQL = COVER_SQL + f""",
pp AS (SELECT ping_id, latitude, longitude, {cell_sql('latitude', 'longitude', FI)} AS pcell FROM v_pings),
pd AS (SELECT pp.ping_id, pp.latitude, pp.longitude, cov.segment_id,
              {q_sql('cov.vcell')} - {q_sql('pp.pcell')} AS dq, {r_sql('cov.vcell')} - {r_sql('pp.pcell')} AS dr FROM pp, cov),
cand AS (SELECT *, (abs(dq) + abs(dr) + abs(dq + dr)) / 2 AS ring FROM pd WHERE (abs(dq) + abs(dr) + abs(dq + dr)) / 2 <= 4),
best AS (SELECT *, min(ring) OVER (PARTITION BY ping_id) AS r0 FROM cand),
c2 AS (SELECT DISTINCT ping_id, latitude, longitude, segment_id FROM best WHERE ring = r0),
dd AS (SELECT c2.ping_id, c2.segment_id,
              min(sqrt(pow(v.longitude - c2.longitude, 2) + pow(v.latitude - c2.latitude, 2))) AS dist
       FROM c2 JOIN v_segment_vertices v USING (segment_id) GROUP BY ALL),
pick AS (SELECT ping_id, arg_min(segment_id, (dist, segment_id)) AS segment FROM dd GROUP BY ping_id)"""

SEGDWELL_SQL = SNAP_SQL + """,
snapped AS (SELECT p.*, pick.segment FROM v_pings p JOIN pick USING (ping_id)),
g AS (SELECT trip_id, route_id, segment,
             arg_min(obs_epoch, (obs_epoch, ping_id)) AS a_t, arg_min(latitude, (obs_epoch, ping_id)) AS a_lat,
             arg_min(longitude, (obs_epoch, ping_id)) AS a_lon, arg_min(trip_direction, (obs_epoch, ping_id)) AS a_dir,
             arg_min(license_plate, (obs_epoch, ping_id)) AS a_plate,
             arg_max(obs_epoch, (obs_epoch, ping_id)) AS b_t, arg_max(latitude, (obs_epoch, ping_id)) AS b_lat,
             arg_max(longitude, (obs_epoch, ping_id)) AS b_lon FROM snapped GROUP BY ALL),
seg AS (SELECT segment_id AS segment, max(length) AS length,
               list([longitude, latitude] ORDER BY vseq) AS coords FROM v_segment_vertices GROUP BY segment_id),
c1 AS (SELECT g.*, s.length, s.coords, sqrt(pow(a_lat - b_lat, 2) + pow(a_lon - b_lon, 2)) AS dist, b_t - a_t AS travel
       FROM g LEFT JOIN seg s USING (segment)),
c2s AS (SELECT *, CASE WHEN travel = 0 THEN NULL ELSE dist / travel END AS speed FROM c1),
c3 AS (SELECT *, cast(floor(least(CASE WHEN speed > 0 THEN length / speed ELSE 0e0 END, 86400e0)) AS integer) AS sbi FROM c2s)"""


def _snapped(spark, sf):
    p = v(spark, sf, "v_pings").select("ping_id", "obs_epoch", "trip_id", "route_id", "trip_direction",
                                       "license_plate", "latitude", "longitude")
    return SP.snap_to_segment(p, v(spark, sf, "v_segment_vertices"))


@register("explode_segments", with_("v_segment_vertices") + f"""
SELECT segment_id, vseq, {cell_sql('latitude', 'longitude', FI)} AS cell FROM v_segment_vertices""")
def q_explode_segments(spark, sf):
    vt = SG.segment_table(v(spark, sf, "v_segment_vertices"))
    ex = vt.select("segment_id", F.posexplode("coords").alias("vseq", "pt"))
    ex = ex.select("segment_id", "vseq", F.col("pt")[1].alias("latitude"), F.col("pt")[0].alias("longitude"))
    return SP.segment_cells(ex, FI).select("segment_id", "vseq", "cell")


@register("segment_cover_cells", with_("v_segment_vertices", extra=COVER_SQL) + """
SELECT vcell AS cell, segment_id FROM cov""")
def q_cover(spark, sf):
    return SP.segment_cover(v(spark, sf, "v_segment_vertices"))


@register("join_nearest_segment", with_("v_pings", "v_segment_vertices", extra=SNAP_SQL) + """
SELECT p.ping_id, pick.segment FROM v_pings p LEFT JOIN pick USING (ping_id)""")
def q_snap(spark, sf):
    return _snapped(spark, sf).select("ping_id", "segment")


@register("filter_sentinel", with_("v_pings", "v_segment_vertices", extra=SNAP_SQL) + """
SELECT ping_id, segment FROM pick WHERE segment IS NOT NULL""")
def q_sentinel(spark, sf):
    from citylens.operators.clean import drop_sentinel
    return drop_sentinel(_snapped(spark, sf), "segment").select("ping_id", "segment")


@register("agg_segment_dwell", with_("v_pings", "v_segment_vertices", extra=SEGDWELL_SQL) + """
SELECT trip_id, route_id, segment, travel AS travel_time, sbi AS sb_dwell_int FROM c3""")
def q_segdwell(spark, sf):
    from citylens.operators.clean import drop_sentinel
    d = SG.segment_dwell(drop_sentinel(_snapped(spark, sf), "segment"),
                         SG.segment_table(v(spark, sf, "v_segment_vertices")))
    return d.select("trip_id", "route_id", "segment", "travel_time", "sb_dwell_int")


@register("segment_traffic", with_("v_pings", "v_segment_vertices", extra=SEGDWELL_SQL) + f"""
SELECT b_t * 1000000 AS "observationDateTime", cast(trip_id AS varchar) AS trip_id, route_id, a_dir AS trip_direction,
       a_plate AS license_plate, segment, cast(travel AS double) AS dwell_time, cast(sbi AS double) AS sb_dwell_time,
       cast({HOW.format(e='b_t')} AS varchar) AS time_slot,
       CASE WHEN sbi < 60 THEN 1 WHEN sbi < 180 THEN 2 WHEN sbi < 300 THEN 3 WHEN sbi < 600 THEN 4 ELSE 5 END AS category,
       '{{"type": "Polygon", "geometry": {{"type": "Polygon", "coordinates": [' ||
       '[' || array_to_string(list_transform(coords, lambda p: printf('[%.6f, %.6f]', p[1], p[2])), ', ') || ']' || '] }}}}' AS geojson,
       sha256(concat_ws(chr(1), cast(trip_id AS varchar), route_id, cast(segment AS varchar), cast(b_t AS varchar))) AS primary_key
FROM c3""")
def q_segment_traffic(spark, sf):
    return SG.segment_traffic(v(spark, sf, "v_pings"), v(spark, sf, "v_segment_vertices"), AS_OF)


# ------------------------------------------------------------------ air quality (P-12)
LATEST_SQL = """latest AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY obs_ts DESC, k1 DESC, k2 DESC, k3 DESC) AS rn
    FROM v_readings WHERE sensor_id IS NOT NULL AND obs_ts IS NOT NULL AND k1 IS NOT NULL AND k2 IS NOT NULL
      AND k3 IS NOT NULL AND co2 IS NOT NULL AND co IS NOT NULL AND no2 IS NOT NULL AND so2 IS NOT NULL
      AND pm10 IS NOT NULL AND pm2p5 IS NOT NULL) WHERE rn = 1)"""
SURF_SQL = LATEST_SQL + f""",
loc AS (SELECT l.*, s.latitude, s.longitude FROM latest l JOIN v_sensors s USING (sensor_id)),
vals AS (UNPIVOT (SELECT sensor_id, co2, co, no2, so2, pm10, pm2p5 FROM loc)
         ON co2, co, no2, so2, pm10, pm2p5 INTO NAME pollutant VALUE value),
bb AS (SELECT min(longitude) AS x0, max(longitude) AS x1, min(latitude) AS y0, max(latitude) AS y1 FROM loc),
m AS (SELECT cast(i AS INTEGER) AS i, cast(j AS INTEGER) AS j, x0 + (x1 - x0) * j / {float(RES - 1)!r}e0 AS mx,
             y0 + (y1 - y0) * i / {float(RES - 1)!r}e0 AS my
      FROM bb, range({RES}) t(i), range({RES}) u(j)),
pr AS (SELECT * EXCLUDE (rn) FROM (SELECT m.i, m.j, m.mx, m.my, loc.sensor_id,
         sqrt(pow(m.mx - loc.longitude, 2) + pow(m.my - loc.latitude, 2)) AS dist,
         row_number() OVER (PARTITION BY m.i, m.j ORDER BY sqrt(pow(m.mx - loc.longitude, 2) + pow(m.my - loc.latitude, 2)), loc.sensor_id) AS rn
       FROM m, loc) WHERE rn <= {NEAREST}),
rows AS (SELECT i, min(my) AS y FROM m GROUP BY i),
ch AS (SELECT r.i, CASE WHEN b.latitude - a.latitude <= 1e-9 THEN [least(a.longitude, b.longitude), greatest(a.longitude, b.longitude)]
                        ELSE [a.longitude + (r.y - a.latitude) * (b.longitude - a.longitude) / (b.latitude - a.latitude)] END AS xs
       FROM rows r, loc a, loc b WHERE a.latitude <= b.latitude AND a.latitude - 1e-9 <= r.y AND r.y <= b.latitude + 1e-9),
ext AS (SELECT i, min(list_min(xs)) AS xa, max(list_max(xs)) AS xb FROM ch GROUP BY i),
hull AS (SELECT m.i, m.j FROM m JOIN ext USING (i) WHERE m.mx >= xa - 1e-9 AND m.mx <= xb + 1e-9),
z AS (SELECT p.i, p.j, vals.pollutant,
             coalesce(avg(vals.value) FILTER (WHERE p.dist = 0),
                      sum(CASE WHEN p.dist > 0 THEN 1e0 / pow(p.dist, 2e0) END * vals.value)
                      / sum(CASE WHEN p.dist > 0 THEN 1e0 / pow(p.dist, 2e0) END)) AS value
      FROM pr p JOIN hull USING (i, j) JOIN vals USING (sensor_id) GROUP BY ALL)"""


def _latest(spark, sf):
    return SU.latest_readings(v(spark, sf, "v_readings"))


@register("win_latest_per_key", with_("v_readings", extra=LATEST_SQL) + """
SELECT sensor_id, cast(floor(epoch(obs_ts)) AS bigint) AS obs_epoch, k1, k2, k3, co2, co, no2, so2, pm10, pm2p5 FROM latest""")
def q_latest(spark, sf):
    from citylens.functions.timeutil import epoch_seconds
    return _latest(spark, sf).withColumn("obs_epoch", epoch_seconds("obs_ts")).drop("obs_ts")


@register("geo_unpivot_measures", with_("v_readings", extra=LATEST_SQL) + """
SELECT sensor_id, pollutant, value FROM (UNPIVOT (SELECT sensor_id, co2, co, no2, so2, pm10, pm2p5 FROM latest)
  ON co2, co, no2, so2, pm10, pm2p5 INTO NAME pollutant VALUE value)""")
def q_unpivot(spark, sf):
    l = _latest(spark, sf).select("sensor_id", *SU.POLLUTANT_FLOORS)
    return SP.unpivot_measures(l, ["sensor_id"], list(SU.POLLUTANT_FLOORS))


@register("math_clamp_floor", with_("v_readings", extra=LATEST_SQL) + """
SELECT sensor_id, pollutant, greatest(value, CASE WHEN pollutant = 'co2' THEN 200e0 ELSE 0e0 END) AS value
FROM (UNPIVOT (SELECT sensor_id, co2, co, no2, so2, pm10, pm2p5 FROM latest)
  ON co2, co, no2, so2, pm10, pm2p5 INTO NAME pollutant VALUE value)""")
def q_clamp(spark, sf):
    l = _latest(spark, sf).select("sensor_id", *SU.POLLUTANT_FLOORS)
    u = SP.unpivot_measures(l, ["sensor_id"], list(SU.POLLUTANT_FLOORS))
    fl = F.create_map(*[x for k, val in SU.POLLUTANT_FLOORS.items() for x in (F.lit(k), F.lit(val))])
    return u.withColumn("value", S.clamp_floor("value", fl[F.col("pollutant")]))


@register("geo_mesh", with_("v_readings", "v_sensors", extra=SURF_SQL) + "\nSELECT i, j, mx, my FROM m")
def q_mesh(spark, sf):
    loc = _latest(spark, sf).join(v(spark, sf, "v_sensors"), "sensor_id")
    return SP.mesh(loc, RES)


def _located(spark, sf):
    ensure_checkpoint_dir(spark)
    return _latest(spark, sf).join(v(spark, sf, "v_sensors"), "sensor_id").checkpoint(eager=True)


def _pairs(loc, grid):
    return SP.nearest_sensors(grid, loc, NEAREST, ["i", "j"], carry=list(SU.POLLUTANT_FLOORS))


@register("join_grid_x_sensors", with_("v_readings", "v_sensors", extra=SURF_SQL) + """
SELECT i, j, sensor_id FROM pr""")
def q_grid_pairs(spark, sf):
    loc = _located(spark, sf)
    return _pairs(loc, SP.mesh(loc, RES)).select("i", "j", "sensor_id")


@register("geo_in_hull", with_("v_readings", "v_sensors", extra=SURF_SQL) + "\nSELECT i, j FROM hull")
def q_hull(spark, sf):
    loc = _located(spark, sf)
    return SP.in_hull(SP.mesh(loc, RES), SP.convex_hull(loc)).select("i", "j")


@register("geo_interpolate", with_("v_readings", "v_sensors", extra=SURF_SQL) + """
SELECT i, j, pollutant, round(value, 6) AS value FROM z""")
def q_idw(spark, sf):
    loc, meas = _located(spark, sf), list(SU.POLLUTANT_FLOORS)
    grid = SP.in_hull(SP.mesh(loc, RES), SP.convex_hull(loc))
    wide = SP.idw(_pairs(loc, grid), ["i", "j"], meas)
    return _r6(SP.unpivot_measures(wide, ["i", "j"], meas), "value")


@register("air_quality_surface", with_("v_readings", "v_sensors", extra=SURF_SQL) + f""",
zc AS (SELECT z.*, m.mx, m.my, greatest(z.value, CASE WHEN pollutant = 'co2' THEN 200e0 ELSE 0e0 END) AS weight
       FROM z JOIN m USING (i, j))
SELECT pollutant, i, j, round(weight, 6) AS weight,
       {polygon_json_sql(cell_sql('my', 'mx', ME), ME)} AS coodinates,
       sha256(concat_ws(chr(1), pollutant, cast(i AS varchar), cast(j AS varchar), '{AS_OF}')) AS primary_key,
       {OBS_US} AS "observationDateTime" FROM zc""")
def q_surface(spark, sf):
    out = SU.air_quality_surface(v(spark, sf, "v_readings"), v(spark, sf, "v_sensors"), AS_OF, RES, nearest=NEAREST)
    return _r6(out, "weight")


# ---------------------------------------------------------------- sensors of uneven density (JN-9), smooth surface (SP-7)
# the parts in a town of a hundredth of a degree, one far away; the suppliers stand between
CLUSTER_SQL = """SELECT p_partkey AS sensor_id, CASE WHEN p_partkey = 1 THEN 25e0 ELSE 18.5e0 + 0.01e0 * ((p_partkey * 61) % 1009) / 1009e0 END AS latitude,
  CASE WHEN p_partkey = 1 THEN 80.2e0 ELSE 73.8e0 + 0.01e0 * ((p_partkey * 37) % 1013) / 1013e0 END AS longitude FROM {part}"""
SPOTS_SQL = """SELECT s_suppkey AS spot, 73.7e0 + 0.2e0 * ((s_suppkey * 7919) % 1000) / 1000e0 AS mx,
  18.4e0 + CASE WHEN s_suppkey % 3 = 0 THEN 5e0 ELSE 0.2e0 END * ((s_suppkey * 104729) % 1000) / 1000e0 AS my FROM {supplier}"""


def _tables(spark, sf, sql):
    return spark.sql(sql, **{t: read_table(spark, sf, t) for t in ("part", "supplier") if "{" + t + "}" in sql})


@register("join_nearest_clustered", f"""WITH s AS ({CLUSTER_SQL.replace("{part}", "part")}), p AS ({SPOTS_SQL.replace("{supplier}", "supplier")})
SELECT spot, sensor_id, rn AS place FROM (SELECT spot, sensor_id, row_number() OVER (PARTITION BY spot
  ORDER BY sqrt(pow(mx - longitude, 2) + pow(my - latitude, 2)), sensor_id) AS rn FROM p, s) WHERE rn <= 5""")
def q_nearest_clustered(spark, sf):
    near = SP.nearest_sensors(_tables(spark, sf, SPOTS_SQL), _tables(spark, sf, CLUSTER_SQL), 5, ["spot"])
    place = F.row_number().over(Window.partitionBy("spot").orderBy("dist", "sensor_id"))
    return near.select("spot", "sensor_id", place.cast("long").alias("place"))


LEVELS = 3


def _spline_sql(levels: int, base: int) -> str:
    """The lattice sums level by level; rows are (sensor, pollutant), a lattice node is (a, b)."""
    weight = lambda t, k: ["pow(1 - {0}, 3) / 6", "(3 * pow({0}, 3) - 6 * pow({0}, 2) + 4) / 6",
                           "(-3 * pow({0}, 3) + 3 * pow({0}, 2) + 3 * {0} + 1) / 6", "pow({0}, 3) / 6"][k].format(t)
    bx, by = (f"CASE {k} " + " ".join(f"WHEN {i} THEN {weight(t, i)}" for i in range(4)) + " END" for t, k in (("s", "k"), ("t", "m")))
    near = lambda rows, n: f"""(SELECT *, si + k AS a, ti + m AS b, ({bx}) * ({by}) AS w FROM (SELECT *, u - si AS s, v - ti AS t FROM (SELECT *,
      greatest(least(floor(u), {n - 1}), 0) AS si, greatest(least(floor(v), {n - 1}), 0) AS ti FROM (SELECT r.*, (x - x0) / (x1 - x0) * {n} AS u, (y - y0) / (y1 - y0) * {n} AS v
      FROM {rows} r, bb))), range(4) kk(k), range(4) mm(m))"""  # noqa: E731
    out = ["""av AS (SELECT pollutant, avg(value) AS mean FROM vals GROUP BY pollutant)""",
           """r0 AS (SELECT sensor_id, pollutant, longitude AS x, latitude AS y, value - mean AS z FROM vals JOIN av USING (pollutant) JOIN loc USING (sensor_id))""",
           """g AS (SELECT i, j, mx AS x, my AS y FROM m JOIN hull USING (i, j))"""]
    for n in range(levels):
        cells = base * 2 ** n
        out.append(f"e{n} AS (SELECT * FROM {near(f'r{n}', cells)})")
        out.append(f"""l{n} AS (SELECT pollutant, a, b, sum(w * w * w * z / al) / nullif(sum(w * w), 0) AS phi
  FROM (SELECT *, sum(w * w) OVER (PARTITION BY sensor_id, pollutant) AS al FROM e{n}) GROUP BY pollutant, a, b)""")
        out.append(f"""r{n + 1} AS (SELECT sensor_id, pollutant, any_value(x) AS x, any_value(y) AS y, any_value(z) - sum(w * phi) AS z
  FROM e{n} JOIN l{n} USING (pollutant, a, b) GROUP BY sensor_id, pollutant)""")
    parts = " UNION ALL ".join(f"SELECT i, j, pollutant, w * phi AS f FROM {near('g', base * 2 ** n)} JOIN l{n} USING (a, b)" for n in range(levels))
    out.append(f"fit AS (SELECT i, j, pollutant, sum(f) AS f FROM ({parts}) GROUP BY i, j, pollutant)")
    out.append("z2 AS (SELECT g.i, g.j, pollutant, mean + coalesce(f, 0) AS value, g.x AS mx, g.y AS my FROM g CROSS JOIN av LEFT JOIN fit USING (i, j, pollutant))")
    return ",\n" + ",\n".join(out)


SPLINE_SQL = SURF_SQL + _spline_sql(LEVELS, 4)


@register("geo_smooth_surface", with_("v_readings", "v_sensors", extra=SPLINE_SQL) + """
SELECT i, j, pollutant, round(value, 6) AS value FROM z2""")
def q_smooth_surface(spark, sf):
    loc, meas = _located(spark, sf), list(SU.POLLUTANT_FLOORS)
    grid = SP.in_hull(SP.mesh(loc, RES), SP.convex_hull(loc))
    return _r6(SP.unpivot_measures(SP.smooth_surface(grid, loc, ["i", "j"], meas, LEVELS), ["i", "j"], meas), "value")


@register("air_quality_smooth_surface", with_("v_readings", "v_sensors", extra=SPLINE_SQL) + f""",
zc AS (SELECT *, greatest(value, CASE WHEN pollutant = 'co2' THEN 200e0 ELSE 0e0 END) AS weight FROM z2)
SELECT pollutant, i, j, round(weight, 6) AS weight,
       {polygon_json_sql(cell_sql('my', 'mx', ME), ME)} AS coodinates,
       sha256(concat_ws(chr(1), pollutant, cast(i AS varchar), cast(j AS varchar), '{AS_OF}')) AS primary_key,
       {OBS_US} AS "observationDateTime" FROM zc""")
def q_smooth_product(spark, sf):
    out = SU.air_quality_surface(v(spark, sf, "v_readings"), v(spark, sf, "v_sensors"), AS_OF, RES, levels=LEVELS)
    return _r6(out, "weight")


# ---------------------------------------------------------------- text message ids
TEXT_IDS = duckdb_text("v_pings").replace("select event_id as ping_id", "select 'u-' || cast(event_id as string) as ping_id", 1)


def _text_pings(spark, sf):
    return v(spark, sf, "v_pings").withColumn("ping_id", F.concat(F.lit("u-"), F.col("ping_id").cast("string")))


@register("cell_dwell_text_ids", f"""WITH v_pings AS ({TEXT_IDS}), {dwell_rows_sql()}
SELECT ping_id, trip_id, cell, dwell_time, time_slot FROM drows""")
def q_text_ids(spark, sf):
    return D.cell_dwell_rows(_text_pings(spark, sf)).select("ping_id", "trip_id", "cell", "dwell_time", "time_slot")


# ---------------------------------------------------------------- nearest stretch (JN-8 by distance to the line)
MAX_M = 60.0
_AWAY = """sqrt(pow(px - t * ax, 2) + pow(py - t * ay, 2))"""


@register("join_nearest_stretch", with_("v_pings", "v_segment_vertices", extra=f"""
st AS (SELECT segment_id, longitude AS x1, latitude AS y1, lead(longitude) OVER w AS x2, lead(latitude) OVER w AS y2
       FROM v_segment_vertices WINDOW w AS (PARTITION BY segment_id ORDER BY vseq)),
spot AS (SELECT DISTINCT latitude, longitude FROM v_pings),
pr AS (SELECT *, greatest(0, least(1, (px * ax + py * ay) / (ax * ax + ay * ay))) AS t FROM (SELECT latitude, longitude, segment_id,
       (x2 - x1) * {FI.kx!r}e0 AS ax, (y2 - y1) * {FI.ky!r}e0 AS ay, (longitude - x1) * {FI.kx!r}e0 AS px, (latitude - y1) * {FI.ky!r}e0 AS py
       FROM spot, st WHERE x2 IS NOT NULL)),
best AS (SELECT latitude, longitude, min(struct_pack(m := {_AWAY}, s := segment_id)) AS b FROM pr GROUP BY ALL)""") + f"""
SELECT ping_id, CASE WHEN b.m <= {MAX_M} THEN b.s END AS segment, round(CASE WHEN b.m <= {MAX_M} THEN b.m END, 4) AS segment_m
FROM v_pings JOIN best USING (latitude, longitude)""")
def q_nearest_stretch(spark, sf):
    out = SP.snap_to_stretch(v(spark, sf, "v_pings").select("ping_id", "latitude", "longitude"), v(spark, sf, "v_segment_vertices"), MAX_M)
    return out.select("ping_id", "segment", F.round("segment_m", 4).alias("segment_m"))


# ---------------------------------------------------------------- learned lag weights (P-7)
FIT_SLOTS = 60
_FIT_START = END - FIT_SLOTS * SLOT_S
_COLS = [f"x{i}" for i in range(5)] + ["y"]
LAG_ROWS_SQL = dwell_rows_sql() + "," + REGION_CELLS + f""",
obs AS (SELECT cell, trip_direction, cast(floor((obs_epoch - {_FIT_START}) / {SLOT_S}) AS integer) AS slot, avg(dwell_time) AS mean_dwell FROM drows
        WHERE obs_epoch >= {_FIT_START} AND obs_epoch < {END} AND trip_direction IN ('DN', 'UP') GROUP BY ALL),
skel AS (SELECT cell, d.dir AS trip_direction, cast(s.slot AS integer) AS slot
         FROM (SELECT DISTINCT cell FROM regc), (VALUES ('DN'), ('UP')) d(dir), range({FIT_SLOTS}) s(slot)),
sc AS (SELECT skel.*, obs.mean_dwell IS NOT NULL AS seen, (coalesce(obs.mean_dwell, -1e0) + 1e0) / 501e0 AS x FROM skel LEFT JOIN obs USING (cell, trip_direction, slot)),
lags AS (SELECT lag(x, 4) OVER w AS x0, lag(x, 3) OVER w AS x1, lag(x, 2) OVER w AS x2, lag(x, 1) OVER w AS x3, 1e0 AS x4, x AS y, seen
         FROM sc WINDOW w AS (PARTITION BY cell, trip_direction ORDER BY slot)),
lr AS (SELECT * FROM lags WHERE seen AND x0 IS NOT NULL)"""


def _lag_rows(spark, sf):
    panel = D.hourly_panel(_rows(spark, sf), _region_cells(spark, sf), AS_OF, FIT_SLOTS, SLOT_S)
    return D.lag_rows(panel, 4)


@register("agg_lag_moments", with_("v_pings", "v_region", extra=LAG_ROWS_SQL) + " " + " UNION ALL ".join(
    f"SELECT '{a}*{b}' AS moment, round(sum({a} * {b}), 2) AS total FROM lr" for i, a in enumerate(_COLS) for b in _COLS[i:]))
def q_lag_moments(spark, sf):
    wide = D.lag_moments(_lag_rows(spark, sf), 4)
    return wide.unpivot([], wide.columns, "moment", "total").withColumn("total", F.round("total", 2))


@register("lag_weights", with_("v_pings", "v_region", extra=LAG_ROWS_SQL) + f""",
one AS (SELECT {", ".join(f"sum({a} * {b}) AS {a}_{b}" for i, a in enumerate(_COLS) for b in _COLS[i:])} FROM lr),
e0 AS (SELECT {", ".join(f"{f'x{min(i, j)}_x{max(i, j)}'}{' + 1e0' if i == j and i < 4 else ''} AS a{i}{j}" for i in range(5) for j in range(5))},
       {", ".join(f"x{i}_y AS b{i}" for i in range(5))} FROM one),
{",".join(f"""
e{k + 1} AS (SELECT {", ".join((f"a{i}{j} - a{i}{k} / a{k}{k} * a{k}{j}" if i > k else f"a{i}{j}") + f" AS a{i}{j}" for i in range(5) for j in range(5))},
       {", ".join((f"b{i} - a{i}{k} / a{k}{k} * b{k}" if i > k else f"b{i}") + f" AS b{i}" for i in range(5))} FROM e{k})""" for k in range(4))},
s4 AS (SELECT *, b4 / a44 AS w4 FROM e4), s3 AS (SELECT *, (b3 - a34 * w4) / a33 AS w3 FROM s4),
s2 AS (SELECT *, (b2 - a23 * w3 - a24 * w4) / a22 AS w2 FROM s3), s1 AS (SELECT *, (b1 - a12 * w2 - a13 * w3 - a14 * w4) / a11 AS w1 FROM s2),
s0 AS (SELECT *, (b0 - a01 * w1 - a02 * w2 - a03 * w3 - a04 * w4) / a00 AS w0 FROM s1)
""" + " UNION ALL ".join(f"SELECT '{n}' AS feature, round(w{i}, 6) AS weight FROM s0" for i, n in enumerate(["lag_0", "lag_1", "lag_2", "lag_3", "intercept"])))
def q_lag_weights(spark, sf):
    """Learned by moment sums, stored as a model table and read back."""
    path = K.save_model(D.fit_lag_weights(_lag_rows(spark, sf), 4), spark)
    return _r6(K.load_model(spark, path), "weight")
