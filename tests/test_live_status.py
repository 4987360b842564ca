"""The streamed trip status against the batch product, run by run."""

import random

from pyspark.sql import functions as F

from citylens.plans import trips as P
from citylens.streaming import trip_status as TS

PINGS = ("trip_id long, license_plate string, last_stop_id long, obs_epoch long, actual_start_epoch long, "
         "latitude double, longitude double")
DAY = 86_400


def tables(spark):
    rng = random.Random(11)
    sch = [(t, k, rng.randrange(9), 1000 * t % DAY + 600 * k, 1000 * t % DAY + 600 * k + 30) for t in range(120) for k in range(1 + t % 5)]
    # the last trips end after the last message: nobody drives them, they are never MISSED
    sch += [(t, 0, 1, 5 * DAY, 5 * DAY) for t in range(120, 125)]
    early = [(t, rng.choice(["A", "B", None]), rng.choice([None, *range(9)]), rng.randrange(DAY // 2), rng.randrange(DAY),
              rng.choice([None, 21 + rng.random()]), 72 + rng.random()) for t in rng.choices(range(0, 140, 2), k=400)]
    late = [(t, rng.choice(["A", "C"]), rng.randrange(9), DAY // 2 + rng.randrange(DAY), rng.choice([None, 5]), 22.0, 72.5)
            for t in rng.choices([*range(0, 140, 2), 1, 3], k=300)]
    sch = spark.createDataFrame(sch, "trip_id long, stop_sequence int, stop_id long, arrival_epoch long, departure_epoch long")
    return sch, [spark.createDataFrame(rows, PINGS).withColumn("obs_ts", F.timestamp_seconds("obs_epoch")) for rows in (early, late)]


def bag(df):
    return sorted(map(str, df.collect()))


def test_stream_equals_batch_after_every_run(spark, tmp_path):
    sch, runs = tables(spark)
    folder, out = str(tmp_path / "pings"), str(tmp_path / "changes")
    th = P.TripThresholds(late_s=20_000)
    seen = None
    for pings in runs:                                   # the second run starts anew from the first one's checkpoint
        pings.coalesce(1).write.mode("append").parquet(folder)
        src = spark.readStream.schema(pings.schema).parquet(folder)
        assert TS.run_trip_status(src, sch, out, "1000 seconds") == out
        seen = pings if seen is None else seen.union(pings)
        clock = seen.agg(F.max("obs_epoch")).first()[0] - 1000
        want = P.trip_status(seen, sch, clock, thresholds=th)
        got = TS.current_status(spark, out, thresholds=th)
        assert got.columns == want.columns and bag(got) == bag(want)
    status = {r.status for r in got.collect()}
    assert {"NOT STARTED", "MISSED", "LATE"} <= status
    changes = spark.read.schema(TS.PROGRESS).parquet(out)
    # nobody drives trip 5: at most NOT STARTED and then MISSED; trip 121 is not due yet
    assert changes.where("trip_id = 5").agg(F.max("version")).first()[0] <= 2
    assert changes.where("trip_id = 121").count() == 1
