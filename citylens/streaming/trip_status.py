"""Live trip status as a stream (P-1 kept up to date message by message).

The batch job re-reads the day every quarter of an hour; here a trip's state
is its timetable envelope and, per plate, the extremes and stops of its
messages.  A message updates the state and gives the trip's rows anew; an
event-time timer at the end of the timetable turns a trip that nobody drove
from NOT STARTED into MISSED when time passes without a message.  The rows
carry what the batch job derives per trip, and the same column expressions
classify them, so both agree.

State is kept for a group of trips (a trip's hash): the group's part of the
timetable, and per driven trip its plates.  Nearly all trips wait for a
message or for their end, so a group reads and announces its waiting trips in
one call, with one timer for whichever ends next, instead of several calls to
the state store for each.  It lives in RocksDB under the query's checkpoint, so
a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from citylens.operators.clean import drop_null_rows
from citylens.plans.trips import TripThresholds, classified_trips, status_columns, timetable_envelope
from citylens.streaming.streams import run_available_now

# The state store that state of this kind needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

_EXTREMES = (("first_ping", min, "obs_epoch"), ("last_ping", max, "obs_epoch"), ("max_latitude", max, "latitude"),
             ("min_longitude", min, "longitude"), ("actual_start", min, "actual_start_epoch"))
_TYPES = ("long", "long", "double", "double", "long")
_NAMES = [n for n, _, _ in _EXTREMES]
_EXTREME_SCHEMA = ", ".join(f"{n} {t}" for n, t in zip(_NAMES, _TYPES))
GROUPS = 4096            # groups that trips are dealt to: sizes state entries, changes no result; a checkpoint is bound to it
_TIMETABLE = "trips array<long>, starts array<long>, ends array<long>, stops array<array<long>>"
_DRIVEN = f"version long, plates array<struct<license_plate: string, {', '.join(f'{n}: {t}' for n, t in zip(_NAMES, _TYPES))}, stops: array<long>>>"
PROGRESS = f"trip_id long, license_plate string, {_EXTREME_SCHEMA}, eta_stops array<long>, start_time long, end_time long, " \
           "sch_stops array<long>, as_of long, version long"
_ROW = Row("trip_id", "license_plate", *_NAMES, "eta_stops", "start_time", "end_time", "sch_stops", "as_of", "version")


class TripProgress(StatefulProcessor):
    """Rows of a trip, one per plate that attains an extreme (or one without plate before the first message);
    a higher ``version`` replaces all earlier rows of the trip (waiting 1, its end passed 2, driven from 3 on)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timetable = handle.getValueState("timetable", _TIMETABLE)
        self.told = handle.getValueState("told", "watermark long")       # up to where waiting trips are announced
        self.driven = handle.getMapState("driven", "trip_id long", _DRIVEN)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.timetable.update((*map(list, initialState[1:4]), [list(stops) for stops in initialState[4]]))
        self.handle.registerTimer(1)                     # the first watermark tells which trips are due

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.timetable.get() if self.timetable.exists() else ((), (), (), ())
        listed = {trip: (start, end, stops) for trip, start, end, stops in zip(*known)}
        seen: dict[int, list] = {}                       # trip -> version, plates
        for row in rows:
            trip, plate = row.trip_id, row.license_plate
            if trip not in listed:                       # not in the timetable
                continue
            if trip not in seen:
                version, plates = self.driven.getValue((trip,)) if self.driven.containsKey((trip,)) else (2, ())
                seen[trip] = [version, {p[0]: [*p[:-1], set(p[-1])] for p in plates}]
            held = seen[trip][1].setdefault(plate, [plate, *[None] * len(_NAMES), set()])
            for i, (_, pick, column) in enumerate(_EXTREMES, 1):
                value = row[column]
                if value is not None:
                    held[i] = value if held[i] is None else pick(held[i], value)
            if row.last_stop_id is not None:
                held[-1].add(row.last_stop_id)
        as_of = timerValues.getCurrentWatermarkInMs() // 1000
        for trip, (version, by_plate) in seen.items():
            plates = [(*held[:-1], sorted(held[-1])) for held in by_plate.values()]
            self.driven.updateValue((trip,), (version + 1, plates))
            yield from self._driven_rows(trip, plates, listed[trip], as_of, version + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Rows of waiting trips (a driven trip changes by its messages only): all at first, later those whose end has passed."""
        now = timerValues.getCurrentWatermarkInMs()
        since = self.told.get()[0] if self.told.exists() else None
        self.told.update((now,))
        driven = {k[0] for k in self.driven.keys()}
        due = None
        for trip, start, end, stops in zip(*self.timetable.get()):
            if trip in driven:
                continue
            ends = end * 1000
            if now <= ends:
                due = ends + 1 if due is None else min(due, ends + 1)
            if since is None or since <= ends < now:
                yield _ROW(trip, None, *[None] * len(_NAMES), None, start, end, list(stops), now // 1000, 1 if since is None else 2)
        if due is not None:
            self.handle.registerTimer(due)

    def _driven_rows(self, trip, plates, listed, as_of, version) -> Iterator[Row]:
        start, end, stops = listed
        extremes = []
        for i, (_, pick, _) in enumerate(_EXTREMES, 1):
            values = [p[i] for p in plates if p[i] is not None]
            extremes.append(pick(values) if values else None)
        visited = sorted({s for p in plates for s in p[-1]})
        for p in plates:
            if any(x is not None and p[i] == x for i, x in enumerate(extremes, 1)):
                yield _ROW(trip, p[0], *extremes, visited, start, end, list(stops), as_of, version)


def _group(trip: str = "trip_id") -> Column:
    return F.pmod(F.xxhash64(F.col(trip).cast("long")), F.lit(GROUPS)).alias("_group")


def stream_trip_progress(pings: DataFrame, sch: DataFrame, watermark: str = "1 hour", ts: str = "obs_ts") -> DataFrame:
    """Streaming pings and a timetable -> the changes of every trip's rows (append mode).

    The query must start with ``STATE_STORE`` as the session's state store, as :func:`run_trip_status` does.
    """
    envelope = timetable_envelope(drop_null_rows(sch)).select(_group(), F.struct(
        F.col("trip_id").cast("long").alias("trip_id"), "start_time", "end_time", "sch_stops").alias("t"))
    listed = envelope.groupBy("_group").agg(F.collect_list("t").alias("t")).select(
        "_group", "t.trip_id", "t.start_time", "t.end_time", "t.sch_stops").groupBy("_group")
    p = pings.where(F.col("trip_id").isNotNull()).select(
        _group(), F.col("trip_id").cast("long").alias("trip_id"), "license_plate", "last_stop_id", ts, *dict.fromkeys(c for _, _, c in _EXTREMES))
    return p.withWatermark(ts, watermark).groupBy("_group").transformWithState(
        TripProgress(), PROGRESS, "append", "eventtime", initialState=listed)


def run_trip_status(pings: DataFrame, sch: DataFrame, path: str | None = None, watermark: str = "1 hour") -> str:
    """Process what is available and append the changes to a Parquet folder, whose path is returned.

    A restart with the same path goes on from its checkpoint; the timetable is read at the first start only.
    """
    conf = pings.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, STATE_STORE)
    try:
        return run_available_now(stream_trip_progress(pings, sch, watermark), "trip-status", path=path)
    finally:
        if before is None:
            conf.unset(_PROVIDER)
        else:
            conf.set(_PROVIDER, before)


def current_status(spark: SparkSession, path: str, offset_minutes: int = 330, thresholds: TripThresholds = TripThresholds()) -> DataFrame:
    """P-1 from the changes stored so far: the newest version of every trip, classified at its watermark.

    The newest version is a partially aggregated maximum per trip; ``observe_time`` and the daily key
    come from the newest watermark.
    """
    changes = spark.read.schema(PROGRESS).parquet(path)
    newest = changes.groupBy("trip_id").agg(F.max("version").alias("version"))
    rows = changes.join(newest, ["trip_id", "version"], "left_semi")
    run = classified_trips(rows, F.col("as_of"), thresholds)
    return status_columns(run, changes.agg(F.max("as_of")).scalar(), offset_minutes)
