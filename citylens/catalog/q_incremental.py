"""Trailing windows from stored partials: three runs a day apart, each reading its new hours only."""

from __future__ import annotations

from pyspark.sql import functions as F

from citylens.catalog.hexsql import cell_sql
from citylens.catalog.q_products import dwell_rows_sql
from citylens.catalog.registry import AS_OF, register
from citylens.functions import hexgrid as H
from citylens.plans import incremental as IN
from citylens.session import scratch_path
from citylens.sources.fixtures import duckdb_with, view

HOURS = 7 * 24
START = AS_OF - HOURS * 3600
RUNS = (AS_OF - 2 * 86400, AS_OF - 86400, AS_OF)
WINDOW = f"obs_epoch >= {START} AND obs_epoch < {AS_OF}"


def _partials(spark, sf, name, partials):
    pings, path = view(spark, sf, "v_pings"), scratch_path(spark, name)
    for end in RUNS:
        IN.advance(pings, path, end, HOURS, partials)
    return IN.window_partials(spark, path, AS_OF, HOURS, partials(pings))


@register("density_incremental", duckdb_with("v_pings") + f"""
SELECT {cell_sql('latitude', 'longitude', H.COARSE)} AS cell, count(*) AS count FROM v_pings WHERE {WINDOW} GROUP BY ALL""")
def q_density(spark, sf):
    return IN.density_of(_partials(spark, sf, "density", IN.density_partials))


@register("dwell_model_incremental", duckdb_with("v_pings") + "," + dwell_rows_sql(START, AS_OF - 1, "trows") + """,
tmeans AS (SELECT cell, route_id, time_slot, avg(dwell_time) AS dwell_time FROM trows GROUP BY ALL),
tg AS (SELECT cell, route_id, covar_pop(dwell_time, time_slot) AS c, var_pop(time_slot) AS v, avg(time_slot) AS mx,
              avg(dwell_time) AS my, count(*) AS n_slots FROM tmeans GROUP BY ALL),
model AS (SELECT route_id, cell, CASE WHEN v > 0 THEN sign(c) * greatest(abs(c) - 1e0, 0e0) / v ELSE 0e0 END AS coef, my, mx, n_slots FROM tg)
SELECT route_id, cell, round(coef, 6) AS coef, round(my - coef * mx, 4) AS intercept, n_slots FROM model""")
def q_model(spark, sf):
    m = IN.dwell_model_of(_partials(spark, sf, "dwell", IN.dwell_partials))
    return m.withColumns({"coef": F.round("coef", 6), "intercept": F.round("intercept", 4)})


@register("delay_median_sketches", duckdb_with("v_pings") + f"""
SELECT trip_id, quantile_disc(trip_delay, 0.5) AS trip_delay, count(trip_delay) AS n_delays FROM v_pings
WHERE trip_delay IS NOT NULL AND {WINDOW} GROUP BY trip_id""")
def q_medians(spark, sf):
    return IN.delay_medians_of(_partials(spark, sf, "delays", IN.delay_partials))
