"""State of the streamed trip status by groups of trips: calls do not grow with the trips that wait."""

from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import Row

from citylens.streaming import trip_status as TS
from tests.test_live_status import bag, tables


class Handle:
    """A state store in memory that counts calls."""

    def __init__(self):
        self.calls, self.timers, self.held = Counter(), [], {}

    def getValueState(self, name, schema):
        def get():
            self.calls["get"] += 1
            return self.held[name]

        def update(value):
            self.calls["update"] += 1
            self.held[name] = value

        return SimpleNamespace(get=get, update=update, exists=lambda: name in self.held)

    def getMapState(self, name, key, schema):
        held = self.held.setdefault(name, {})
        return SimpleNamespace(containsKey=lambda k: k in held, getValue=held.get, updateValue=held.__setitem__, keys=lambda: list(held))

    def registerTimer(self, at):
        self.calls["timer"] += 1
        self.timers.append(at)


def clock(ms):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)


def message(trip, plate, at):
    return Row(trip_id=trip, license_plate=plate, last_stop_id=1, obs_epoch=at, actual_start_epoch=at, latitude=1.0, longitude=2.0)


def test_waiting_trips_cost_a_few_calls_a_group():
    handle, group = Handle(), TS.TripProgress()
    group.init(handle)
    trips = list(range(500))
    ends = [100 + t // 100 for t in trips]
    group.handleInitialState((0,), Row(0, trips, [10] * 500, ends, [[1]] * 500), clock(0))
    rows = list(group.handleInputRows((0,), iter([message(7, "A", 50), message(900, "A", 51), message(7, "B", 60)]), clock(0)))
    assert [(r.trip_id, r.license_plate, r.version) for r in rows] == [(7, "A", 3), (7, "B", 3)]
    first = list(group.handleExpiredTimer((0,), clock(101_500), None))
    assert {r.trip_id for r in first} == set(trips) - {7} and {(r.version, r.as_of) for r in first} == {(1, 101)}
    assert handle.timers == [1, 102_001]                 # ends at 100 and 101 have passed
    again = list(group.handleExpiredTimer((0,), clock(102_001), None))
    assert [r.trip_id for r in again] == trips[200:300] and {r.version for r in again} == {2}
    last = list(group.handleExpiredTimer((0,), clock(900_000), None))
    assert [r.trip_id for r in last] == trips[300:] and len(handle.timers) == 3
    assert sum(handle.calls.values()) < 20


@pytest.mark.parametrize("groups", [1, 3])
def test_many_trips_of_a_group_equal_the_batch(spark, tmp_path, monkeypatch, groups):
    from pyspark.sql import functions as F

    from citylens.plans import trips as P

    monkeypatch.setattr(TS, "GROUPS", groups)
    sch, runs = tables(spark)
    folder, out = str(tmp_path / "pings"), str(tmp_path / "changes")
    seen = None
    for pings in runs:
        pings.coalesce(1).write.mode("append").parquet(folder)
        TS.run_trip_status(spark.readStream.schema(pings.schema).parquet(folder), sch, out, "1000 seconds")
        seen = pings if seen is None else seen.union(pings)
    at = seen.agg(F.max("obs_epoch")).first()[0] - 1000
    assert bag(TS.current_status(spark, out)) == bag(P.trip_status(seen, sch, at))
