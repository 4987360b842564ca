"""Trailing windows from stored partials against the whole scan; sketches within their bound."""

import bisect
import os
import random

from pyspark.sql import functions as F

from citylens.plans import dwell as D
from citylens.plans import incremental as IN

T0 = 1705363200
SCHEMA = ("ping_id long, trip_id long, route_id string, trip_direction string, license_plate string, trip_delay double, "
          "obs_epoch long, latitude double, longitude double")


def pings(spark, n=3000, seed=4):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(12), rng.choice(["R1", "R2", "R2", "R2"]), "UP", rng.choice(["A", None, "B", "B"]), rng.choice([None, rng.random()]),
             T0 + rng.randrange(72 * 3600), 21.1 + 0.004 * rng.randrange(3), 72.8) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_runs_read_new_hours_and_agree_with_the_whole_window(spark, tmp_path):
    p, hours = pings(spark), 24
    for partials in (IN.density_partials, IN.dwell_partials, IN.delay_partials):
        path, since = str(tmp_path / partials.__name__), []
        for end in (T0 + 30 * 3600, T0 + 31 * 3600 + 5, T0 + 31 * 3600, T0 + 70 * 3600):
            since.append((IN.advance(p, path, end, hours, partials) - T0) // 3600)
            window = p.where((F.col("obs_epoch") >= end - end % 3600 - hours * 3600) & (F.col("obs_epoch") < end - end % 3600))
            held = IN.window_partials(spark, path, end, hours, partials(p))
            stored = [int(x.partition("=")[2]) for x in os.listdir(path) if x.startswith("hour=")]
            assert min(stored) >= end - end % 3600 - hours * 3600
            if partials is IN.density_partials:
                assert sorted(map(tuple, IN.density_of(held).collect())) == sorted(map(tuple, IN.density_of(partials(window)).collect()))
            elif partials is IN.dwell_partials:
                whole = D.slot_means(D.cell_dwell_rows(window, dropna=True)).collect()
                assert sorted((r.cell, r.route_id, r.time_slot, r.dwell_time) for r in IN.slot_means_of(held).collect()) == \
                    sorted((r.cell, r.route_id, r.time_slot, r.dwell_time) for r in whole)
            else:
                n = {r.trip_id: r.n_delays for r in IN.delay_medians_of(held).collect()}
                assert n == {r.trip_id: r.n for r in window.groupBy("trip_id").agg(F.count("trip_delay").alias("n")).collect() if r.n}
        assert since == [6, 29, 30, 46]                  # new hours and the reopened one, or a window that lies further on


def test_late_pings_of_the_reopened_hour_count(spark, tmp_path):
    p, path = pings(spark), str(tmp_path / "late")
    early = p.where(f"obs_epoch < {T0 + 9 * 3600 + 1800}")
    IN.advance(early, path, T0 + 10 * 3600, 10, IN.density_partials)
    IN.advance(p, path, T0 + 11 * 3600, 10, IN.density_partials)
    got = IN.window_partials(spark, path, T0 + 11 * 3600, 10, IN.density_partials(p)).agg(F.sum("n")).first()[0]
    assert got == p.where(f"license_plate is not null and obs_epoch >= {T0 + 3600} and obs_epoch < {T0 + 11 * 3600}").count()


def test_new_run_scans_its_hours_only(spark, tmp_path):
    src, path = str(tmp_path / "src"), str(tmp_path / "partials")
    pings(spark).withColumn("day", F.expr(f"(obs_epoch - {T0}) div 86400")).write.partitionBy("day").parquet(src)
    table = spark.read.parquet(src)
    IN.advance(table, path, T0 + 48 * 3600, 48, IN.density_partials)
    held = IN.window_partials(spark, path, T0 + 48 * 3600, 10, IN.density_partials(table))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan
    files = {r.f for r in held.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len({f.split("hour=")[1].split("/")[0] for f in files}) == 10


def test_merged_sketches_keep_their_rank_error(spark):
    rng = random.Random(6)
    values = [rng.gauss(0, 1) for _ in range(20_000)]
    rows = spark.createDataFrame([(1, v, T0 + 3600 * (i % 24)) for i, v in enumerate(values)], "trip_id long, trip_delay double, obs_epoch long")
    parts = IN.delay_partials(rows)
    assert parts.count() == 24
    values.sort()
    for rank in (0.1, 0.5, 0.9):
        r = IN.delay_medians_of(parts, rank).first()
        direct = IN.delay_medians_of(rows.groupBy("trip_id").agg(F.kll_sketch_agg_double("trip_delay").alias("sketch")), rank).first()
        for told in (r, direct):
            assert told.n_delays == 20_000
            assert abs(bisect.bisect_left(values, told.trip_delay) / 20_000 - rank) < 0.0266      # two-sided bound of k = 200 at 99 %
