"""Upsert table and run history: commits, retries, crashes, readers of old versions."""

import os

import pytest
from pyspark.sql import functions as F

from citylens.plans import trips as P
from citylens.sources import sinks as K
from citylens.sources import upsert as U

SCHEMA = "k long, t long, x string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def bag(df):
    return sorted(map(tuple, df.collect()))


def merge(spark, path, version, data, **kw):
    return U.merge(rows(spark, data), path, ["k"], ["t"], version, **kw)


def read(spark, path, version=None):
    return bag(U.read_upserted(spark, path, rows(spark, []).schema, version))


def folders(path):
    return sorted(f"data/{v}/{b}" for v in os.listdir(f"{path}/data") if v.startswith("v=") for b in os.listdir(f"{path}/data/{v}") if b.startswith("bucket="))


def test_merges_keep_the_newest_row_and_split_buckets(spark, tmp_path):
    path, want = str(tmp_path / "t"), {}
    for version in range(4):
        data = [(k, version * 10 + k % 7, f"{version}.{k}") for k in range(version * 40, version * 40 + 100)] + [(0, -1, "late")]
        assert merge(spark, path, version, data, bucket_rows=16)
        for k, t, x in data:
            if k not in want or t >= want[k][1]:
                want[k] = (k, t, x)
        assert read(spark, path) == sorted(want.values())
    buckets = U.manifest(spark, path)["buckets"]
    assert sum(b["rows"] for b in buckets) == len(want) and max(b["rows"] for b in buckets) <= 48
    assert sum(2.0 ** -b["depth"] for b in buckets) == 1.0          # the prefixes cover every hash once


def test_a_batch_writes_only_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, path, 0, [(k, 0, "a") for k in range(2000)], bucket_rows=50)
    before = {b["folder"] for b in U.manifest(spark, path)["buckets"]}
    merge(spark, path, 1, [(7, 1, "b")], bucket_rows=50)
    after = {b["folder"] for b in U.manifest(spark, path)["buckets"]}
    assert len(before - after) == 1 and len(after - before) == 1 and len(before) > 30
    assert len(read(spark, path)) == 2000


def test_repeated_and_crashed_merges(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge(spark, path, 0, [(1, 1, "a"), (2, 1, "a")])
    assert merge(spark, path, 0, [(1, 9, "again")]) is False       # that version is committed
    monkeypatch.setattr(U, "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("crash before the commit")))
    with pytest.raises(RuntimeError):
        merge(spark, path, 1, [(1, 5, "b")])
    assert read(spark, path) == [(1, 1, "a"), (2, 1, "a")]
    monkeypatch.undo()
    assert merge(spark, path, 1, [(1, 5, "b")])
    assert read(spark, path) == [(1, 5, "b"), (2, 1, "a")]
    assert merge(spark, path, 2, []) is False


def test_old_versions_stay_readable_until_forgotten(spark, tmp_path):
    path = str(tmp_path / "t")
    for version in range(5):
        merge(spark, path, version, [(version, version, "x"), (100, version, str(version))], keep=2)
    assert U.versions(spark, path) == [3, 4]
    assert (100, 3, "3") in read(spark, path, 3) and (4, 4, "x") not in read(spark, path, 3)
    named = {b["folder"] for v in (3, 4) for b in U.manifest(spark, path, v)["buckets"] if b["folder"]}
    assert set(folders(path)) == named
    assert U.read_upserted(spark, str(tmp_path / "none"), rows(spark, []).schema) is None


def test_history_run_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "h")
    for as_of, data in ((1705363200, [(1, 1, "a")]), (1705363200 + 900, [(1, 2, "b")]), (1705363200, [(1, 3, "retry")])):
        K.append_history(rows(spark, data), path, as_of, ["k"])
    got = sorted((r.primary_key, r.x) for r in spark.read.parquet(path).collect())
    assert got == [("1|1705363200", "retry"), ("1|1705364100", "b")]
    assert not [n for n in os.listdir(path) if n.startswith(("_staged", "_replaced"))]


def test_failed_history_write_leaves_the_run_as_it_was(spark, tmp_path):
    path = str(tmp_path / "h")
    K.append_history(rows(spark, [(1, 1, "a")]), path, 1705363200)
    broken = rows(spark, [(2, 2, "b")]).withColumn("x", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        K.append_history(broken, path, 1705363200)
    assert [r.x for r in spark.read.parquet(path).collect()] == ["a"]


def test_terminals_ignore_repeated_timetable_rows(spark):
    schema = "trip_id long, stop_sequence int, stop_id long, arrival_epoch long, departure_epoch long"
    sch = spark.createDataFrame([(1, 1, 7, 100, 90), (2, 1, 3, 100, 110), (2, 2, 4, 200, 210)], schema)
    once, twice = (P.scheduled_terminals(s, 1705363200, distinct_stops=True).collect() for s in (sch, sch.union(sch)))
    assert sorted(map(str, once)) == sorted(map(str, twice))
    assert {r.trip_id: r.end_stop for r in twice} == {"1": None, "2": "4"}


def test_status_job_rerun_doubles_nothing(spark, tmp_path):
    from citylens.sources.fixtures import view
    sf, out = "/root/testdata/sf0.001", str(tmp_path / "job")
    live, sch = view(spark, sf, "v_pings"), view(spark, sf, "v_schedule")
    th = P.TripThresholds(late_s=432000)
    counts = []
    for _ in range(2):
        paths = P.trip_status_job(live, sch, 1705363200, out, thresholds=th, recent_minutes=10 * 24 * 60)
        counts.append({n: spark.read.parquet(p).count() for n, p in paths.items()})
    assert counts[0] == counts[1] and sum(counts[0].values()) > 0
