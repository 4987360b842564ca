"""Hex-grid keys and the spatial products (SP-*, JN-5/7..10, AG-1/2/12/13/15/16,
W-2/3/5/7, SET-2/4, SC-3/12/14/18/19/21/24/26, PRJ-7, SRC-9, P-5 .. P-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from citylens.catalog.hexsql import cell_sql, lit, polygon_json_sql, ring_text_sql
from citylens.catalog.registry import AS_OF, GAP_S, OFFSET_MIN, WEEK_S, register
from citylens.functions import hexgrid as H
from citylens.functions import scalar as S
from citylens.operators import aggregates as AG
from citylens.operators import spatial as SP
from citylens.operators import windows as W
from citylens.operators.joins import unmatched
from citylens.operators.sets import difference, zero_fill
from citylens.plans import quality as Q
from citylens.plans import surface as SU
from citylens.sources.fixtures import duckdb_with, view

CO, ME, FI = H.COARSE, H.MEDIUM, H.FINE
OBS_US = (AS_OF + OFFSET_MIN * 60) * 1_000_000
RES = 100
NEAREST = 8               # sensors per mesh point
SLOT_S = 86400            # daily slots fit the sparse test pings
TRAIN = (AS_OF - WEEK_S, AS_OF)


def v(spark, sf, name):
    return view(spark, sf, name)


def with_(*views, extra=""):
    return duckdb_with(*views) + ("," + extra if extra else "")


PC = f"pc AS (SELECT *, {cell_sql('latitude', 'longitude', CO)} AS cell FROM v_pings)"


def brute_polyfill_sql(name: str, verts: str, key: str, g: H.HexGrid) -> str:
    """Oracle polyfill: bounding-box candidate cells x edges, even-odd count."""
    clat, clon = lit(g.clat), lit(g.clon)
    return f"""
{name}_e AS (SELECT {key}, x1, y1, x2, y2 FROM (
     SELECT {key}, longitude AS x1, latitude AS y1, lead(longitude) OVER w AS x2, lead(latitude) OVER w AS y2
     FROM {verts} WINDOW w AS (PARTITION BY {key} ORDER BY vseq)) WHERE x2 IS NOT NULL),
{name}_b AS (SELECT {key}, min(latitude) AS a, max(latitude) AS b, min(longitude) AS c, max(longitude) AS d
             FROM {verts} GROUP BY {key}),
{name}_r AS (SELECT {key}, c, d, unnest(range(cast(floor(a / {clat}) AS bigint) - 1, cast(ceil(b / {clat}) AS bigint) + 2)) AS r
             FROM {name}_b),
{name}_q AS (SELECT {key}, r, unnest(range(cast(floor(c / {clon} - r / 2e0) AS bigint) - 1,
                                            cast(ceil(d / {clon} - r / 2e0) AS bigint) + 2)) AS q FROM {name}_r),
{name}_c AS (SELECT {key}, q, r, (q + r / 2e0) * {clon} AS xc, r * {clat} AS yc FROM {name}_q),
{name} AS (SELECT c.{key}, cast((c.q + {H.OFFSET}) * {H.STRIDE} + (c.r + {H.OFFSET}) AS bigint) AS cell
           FROM {name}_c c JOIN {name}_e e USING ({key}) GROUP BY c.{key}, c.q, c.r
           HAVING count(*) FILTER (WHERE (e.y1 > c.yc) != (e.y2 > c.yc)
                                     AND c.xc < (e.x2 - e.x1) * (c.yc - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1)"""


REGION_CELLS = brute_polyfill_sql("regc", "(SELECT 0 AS rid, * FROM v_region)", "rid", CO)


def _region_cells(spark, sf):
    return SU.region_cells(v(spark, sf, "v_region"), CO)


# ------------------------------------------------------------------ SP-1..3
@register("geo_cell", with_("v_pings") + f"""
SELECT ping_id, {cell_sql('latitude', 'longitude', CO)} AS cell, {cell_sql('latitude', 'longitude', ME)} AS cell_medium,
       {cell_sql('latitude', 'longitude', FI)} AS cell_fine FROM v_pings""")
def q_geo_cell(spark, sf):
    p = v(spark, sf, "v_pings")
    p = H.with_cell(p.select("ping_id", "latitude", "longitude"), "latitude", "longitude", "cell", CO)
    p = H.with_cell(p, "latitude", "longitude", "cell_medium", ME)
    return H.with_cell(p, "latitude", "longitude", "cell_fine", FI).select("ping_id", "cell", "cell_medium", "cell_fine")


@register("geo_cell_boundary", with_("v_pings", extra=PC) + f"""
SELECT cell, {ring_text_sql('cell', CO)} AS ring FROM (SELECT DISTINCT cell FROM pc)""")
def q_boundary(spark, sf):
    c = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO).select("cell").distinct()
    return H.with_boundary(c, "cell", "r", CO).select("cell", S.ring_text("r").alias("ring"))


@register("geo_disk", with_("v_pings", extra=PC) + f"""
SELECT c.cell, c.cell + dq * {H.STRIDE} + dr AS nb, cast(greatest(abs(dq), abs(dr), abs(dq + dr)) AS INTEGER) AS ring
FROM (SELECT DISTINCT cell FROM pc) c, range(-2, 3) t1(dq), range(-2, 3) t2(dr) WHERE abs(dq + dr) <= 2""")
def q_disk(spark, sf):
    c = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO).select("cell").distinct()
    return SP.disk(c, 2)


ROUTE_BOX = """rb AS (SELECT route_id, min(latitude) AS a, max(latitude) AS b, min(longitude) AS c, max(longitude) AS d
                    FROM v_routes GROUP BY route_id),
rbv AS (SELECT route_id, 0 AS vseq, a AS latitude, c AS longitude FROM rb UNION ALL SELECT route_id, 1, a, d FROM rb
        UNION ALL SELECT route_id, 2, b, d FROM rb UNION ALL SELECT route_id, 3, b, c FROM rb
        UNION ALL SELECT route_id, 4, a, c FROM rb),"""


@register("geo_polyfill", with_("v_routes", extra=ROUTE_BOX + brute_polyfill_sql("rc", "rbv", "route_id", CO))
          + "\nSELECT route_id, cell FROM rc")
def q_polyfill(spark, sf):
    rings = SP.bbox_rings(v(spark, sf, "v_routes"), "route_id")
    return SP.polyfill(rings.withColumn("ring_id", F.lit(0)), CO, poly="route_id")


@register("read_region_rings", with_("v_routes", extra=ROUTE_BOX[:-1]) + """
SELECT route_id, vseq, latitude, longitude FROM rbv""")
def q_read_region(spark, sf):
    from citylens.sources.ingest import read_region, write_geojson_rings
    rings = SP.bbox_rings(v(spark, sf, "v_routes"), "route_id")
    path = write_geojson_rings(spark, rings, "route_id", "route_id")
    return read_region(spark, path, "route_id", multi_line=False, id_col="route_id").select("route_id", "vseq", "latitude", "longitude")


# ------------------------------------------------------------------ counts, region cells
@register("agg_count_by_cell", with_("v_pings", extra=PC) + "SELECT cell, count(*) AS count FROM pc GROUP BY cell")
def q_count_cell(spark, sf):
    p = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO).select("cell")
    return AG.count_by(p, ["cell"])


@register("set_difference_cells", with_("v_pings", "v_region", extra=PC + "," + REGION_CELLS) + """
SELECT cell FROM regc WHERE cell NOT IN (SELECT cell FROM pc)""")
def q_diff_cells(spark, sf):
    seen = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO).select("cell")
    return difference(_region_cells(spark, sf), seen, ["cell"])


@register("set_zero_fill", with_("v_pings", "v_region", extra=PC + "," + REGION_CELLS) + """
SELECT coalesce(a.cell, b.cell) AS cell, coalesce(b.count, 0) AS count FROM (SELECT cell FROM regc) a
FULL OUTER JOIN (SELECT cell, count(*) AS count FROM pc GROUP BY cell) b ON a.cell = b.cell""")
def q_zero_fill(spark, sf):
    p = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO).select("cell")
    return zero_fill(AG.count_by(p, ["cell"]), _region_cells(spark, sf), ["cell"], "count")


@register("ping_density_map", with_("v_pings", "v_region", extra=PC + "," + REGION_CELLS) + f""",
cnt AS (SELECT cell, count(*) AS count FROM pc WHERE obs_epoch BETWEEN {AS_OF - 30 * 86400} AND {AS_OF} GROUP BY cell),
f AS (SELECT coalesce(a.cell, b.cell) AS cell, coalesce(b.count, 0) AS count FROM (SELECT cell FROM regc) a
      FULL OUTER JOIN cnt b ON a.cell = b.cell)
SELECT cell, cast(count AS integer) AS count, {polygon_json_sql('cell', CO)} AS coordinates,
       {OBS_US} AS "observationDateTime" FROM f""")
def q_density(spark, sf):
    return SU.ping_density_map(v(spark, sf, "v_pings"), v(spark, sf, "v_region"), AS_OF, 30)


@register("json_polygon_text", with_("v_pings", extra=PC) + f"""
SELECT cell, {polygon_json_sql('cell', CO)} AS geojson FROM (SELECT DISTINCT cell FROM pc)""")
def q_polyjson(spark, sf):
    c = H.with_cell(v(spark, sf, "v_pings"), "latitude", "longitude", "cell", CO).select("cell").distinct()
    return H.with_boundary(c, "cell", "r", CO).select("cell", S.polygon_json("r").alias("geojson"))


@register("str_brackets", with_("v_routes") + """
SELECT point_id, replace(replace(printf('((%.6f, %.6f))', longitude, latitude), '(', '['), ')', ']') AS coords FROM v_routes""")
def q_brackets(spark, sf):
    r = v(spark, sf, "v_routes")
    return r.select("point_id", S.square_brackets(F.format_string("((%.6f, %.6f))", "longitude", "latitude"))
                    .alias("coords"))


# ------------------------------------------------------------------ black spots (P-9)
RC = f"rcell AS (SELECT *, {cell_sql('latitude', 'longitude', CO)} AS cell FROM v_routes)"
DONE_PC = f"""done AS (SELECT DISTINCT trip_id FROM v_status_history WHERE status = 'COMPLETED'),
dpc AS (SELECT {cell_sql('latitude', 'longitude', CO)} AS cell FROM v_pings p
        WHERE EXISTS (SELECT 1 FROM done d WHERE d.trip_id = p.trip_id))"""
DARK = f"""{RC}, {DONE_PC},
dark AS (SELECT * FROM rcell WHERE cell NOT IN (SELECT cell FROM dpc))"""


def _dark(spark, sf):
    done = Q.completed_trips(v(spark, sf, "v_status_history"))
    p = v(spark, sf, "v_pings").join(done, "trip_id", "left_semi")
    seen = H.with_cell(p, "latitude", "longitude", "cell", CO).select("cell")
    r = H.with_cell(v(spark, sf, "v_routes"), "latitude", "longitude", "cell", CO)
    return unmatched(r, seen, "cell")


@register("join_left_anti_cells", with_("v_routes", "v_pings", "v_status_history", extra=DARK) + """
SELECT point_id, cell FROM dark""")
def q_anti_cells(spark, sf):
    return _dark(spark, sf).select("point_id", "cell")


@register("win_count_weight", with_("v_routes", extra=RC) + """
SELECT point_id, cell, count(route_id) OVER (PARTITION BY cell) AS weight FROM rcell""")
def q_count_weight(spark, sf):
    r = H.with_cell(v(spark, sf, "v_routes"), "latitude", "longitude", "cell", CO)
    return W.count_over(r, ["cell"], "route_id").select("point_id", "cell", "weight")


@register("math_minmax_bucket", with_("v_routes", extra=RC) + """,
wt AS (SELECT point_id, count(route_id) OVER (PARTITION BY cell) AS w FROM rcell),
mm AS (SELECT min(w) AS lo, max(w) AS hi FROM wt)
SELECT point_id, coalesce(cast(floor(4e0 * (w - lo) / CASE WHEN hi = lo THEN NULL ELSE hi - lo END) + 1 AS integer), 1) AS weight
FROM wt, mm""")
def q_bucket(spark, sf):
    r = H.with_cell(v(spark, sf, "v_routes"), "latitude", "longitude", "cell", CO)
    r = W.count_over(r, ["cell"], "route_id", "w")
    lo, hi = AG.global_bounds(r, "w")
    return r.select("point_id", S.minmax_bucket("w", lo, hi).alias("weight"))


@register("agg_global_minmax_weight", with_("v_routes", extra=RC) + """
SELECT min(w) AS lo, max(w) AS hi FROM (SELECT count(*) AS w FROM rcell GROUP BY cell)""")
def q_minmax_weight(spark, sf):
    r = H.with_cell(v(spark, sf, "v_routes"), "latitude", "longitude", "cell", CO).select("cell")
    return AG.global_minmax(AG.count_by(r, ["cell"], "w"), "w")


@register("network_black_spots", with_("v_routes", "v_pings", "v_status_history", extra=DARK) + f""",
wt AS (SELECT *, count(route_id) OVER (PARTITION BY cell) AS w FROM dark),
mm AS (SELECT min(w) AS lo, max(w) AS hi FROM wt)
SELECT cell, route_id, latitude, longitude,
       coalesce(cast(floor(4e0 * (w - lo) / CASE WHEN hi = lo THEN NULL ELSE hi - lo END) + 1 AS integer), 1) AS weight,
       sha256(concat_ws(chr(1), cast(cell AS varchar), cast(point_id AS varchar), '{AS_OF}')) AS primary_key,
       {ring_text_sql('cell', CO)} AS polygon, {polygon_json_sql('cell', CO)} AS coordinates, {OBS_US} AS observe_time
FROM wt, mm""")
def q_black_spots(spark, sf):
    return Q.network_black_spots(v(spark, sf, "v_routes"), v(spark, sf, "v_pings"),
                                 v(spark, sf, "v_status_history"), AS_OF)


# ------------------------------------------------------------------ faulty trackers (P-10)
GAPS = """done AS (SELECT DISTINCT trip_id FROM v_status_history WHERE status = 'COMPLETED'),
gp AS (SELECT p.*, obs_epoch - lag(obs_epoch) OVER (PARTITION BY trip_id, vehicle_label ORDER BY obs_epoch, ping_id) AS gap
       FROM v_pings p WHERE EXISTS (SELECT 1 FROM done d WHERE d.trip_id = p.trip_id))"""
ALL_GAPS = """gp AS (SELECT p.*, obs_epoch - lag(obs_epoch) OVER (PARTITION BY trip_id, vehicle_label ORDER BY obs_epoch, ping_id) AS gap
       FROM v_pings p)"""


@register("cond_fault_flag", with_("v_pings", extra=ALL_GAPS) + f"""
SELECT ping_id, CASE WHEN gap IS NULL OR gap > {GAP_S} THEN 1 ELSE 0 END AS fault FROM gp""")
def q_fault_flag(spark, sf):
    g = W.gap_seconds(v(spark, sf, "v_pings"), ["trip_id", "vehicle_label"], "obs_epoch", "ping_id")
    return g.select("ping_id", S.fault_flag("gap", GAP_S).alias("fault"))


@register("cond_traffic_category", with_("v_pings", extra=ALL_GAPS) + """
SELECT ping_id, CASE WHEN gap < 60 THEN 1 WHEN gap < 180 THEN 2 WHEN gap < 300 THEN 3 WHEN gap < 600 THEN 4 ELSE 5 END
       AS category FROM gp WHERE gap IS NOT NULL""")
def q_category(spark, sf):
    g = W.gap_seconds(v(spark, sf, "v_pings"), ["trip_id", "vehicle_label"], "obs_epoch", "ping_id")
    return g.where(F.col("gap").isNotNull()).select("ping_id", S.traffic_category("gap").alias("category"))


FAULTY_SQL = f""",
fc AS (SELECT trip_id, license_plate,
              cast(count(*) FILTER (WHERE NOT (gap IS NULL OR gap > {GAP_S})) AS integer) AS not_faulty_count,
              cast(count(*) FILTER (WHERE gap IS NULL OR gap > {GAP_S}) AS integer) AS faulty_count
       FROM gp GROUP BY trip_id, license_plate)"""


@register("cond_is_faulty", with_("v_pings", "v_status_history", extra=GAPS) + FAULTY_SQL + """
SELECT cast(trip_id AS varchar) AS trip_id, license_plate, not_faulty_count < faulty_count AS is_faulty FROM fc""")
def q_is_faulty(spark, sf):
    f = Q.faulty_trackers(v(spark, sf, "v_pings"), v(spark, sf, "v_status_history"), AS_OF, GAP_S)
    return f.select("trip_id", "license_plate", "is_faulty")


@register("faulty_trackers", with_("v_pings", "v_status_history", extra=GAPS) + FAULTY_SQL + f"""
SELECT cast(trip_id AS varchar) AS trip_id, license_plate, not_faulty_count, faulty_count,
       not_faulty_count < faulty_count AS is_faulty, {OBS_US} AS observed_time,
       cast(trip_id AS varchar) || '2024-01-16' AS primary_key FROM fc""")
def q_faulty(spark, sf):
    return Q.faulty_trackers(v(spark, sf, "v_pings"), v(spark, sf, "v_status_history"), AS_OF, GAP_S)
