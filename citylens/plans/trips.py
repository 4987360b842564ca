"""Trip products: status, delay, deviation, terminals (P-1 .. P-4).

Plan shape.  The ping table and the timetable are each shuffled once, on
``trip_id``, through partially aggregated ``groupBy`` s (map-side combine
keeps a hot trip from landing whole in one task).  Everything after that
works on per-trip / per-(trip, plate) rows, which are orders of magnitude
smaller than the raw tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylens.functions import scalar as S
from citylens.functions.timeutil import date_text, epoch_micros, observe_time_micros
from citylens.operators.clean import drop_null_rows, recent
from citylens.operators.joins import unmatched
from citylens.session import ensure_checkpoint_dir, path_exists
from citylens.sources.scans import scan_window
from citylens.sources.sinks import commit_run, write_upserted


@dataclass(frozen=True)
class TripThresholds:
    dist_ratio: float = 0.6      # share of scheduled stops seen
    late_s: float = 3600.0       # lateness threshold at either end, seconds
    span_ratio: float = 0.6      # observed span / scheduled span


def timetable_envelope(sch: DataFrame) -> DataFrame:
    """Per trip: start = min departure, end = max arrival, scheduled stop set (AG-9, AG-3)."""
    return sch.groupBy("trip_id").agg(
        F.min("departure_epoch").alias("start_time"),
        F.max("arrival_epoch").alias("end_time"),
        F.array_sort(F.collect_set("stop_id")).alias("sch_stops"),
    )


def plate_envelope(live: DataFrame, actual_start: str = "actual_start_epoch") -> DataFrame:
    """Per (trip, plate) extremes, kept where a plate attains a trip extreme (AG-10).

    A plate is kept when one of its pings attains a trip extreme (first or
    last ping, max latitude, min longitude, earliest actual trip start if the
    pings carry it): exactly the plates of the reference's "extreme rows".
    Pings are read and shuffled once, combined map-side per (trip, plate); a
    trip's plates then meet in one row (bounded by the plates of a trip) and
    those that attain an extreme come out of it.
    Pings without a trip can match nothing and are left out.
    """
    extremes = {"first_ping": ("min", "obs_epoch"), "last_ping": ("max", "obs_epoch"),
                "max_latitude": ("max", "latitude"), "min_longitude": ("min", "longitude")}
    if actual_start in live.columns:
        extremes["actual_start"] = ("min", actual_start)
    per_plate = live.where(F.col("trip_id").isNotNull()).groupBy("trip_id", "license_plate").agg(
        *[getattr(F, f)(c).alias(f"p_{n}") for n, (f, c) in extremes.items()],
        F.collect_set("last_stop_id").alias("p_stops"))
    per_trip = per_plate.groupBy("trip_id").agg(
        *[getattr(F, f)(f"p_{n}").alias(n) for n, (f, _) in extremes.items()],
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("p_stops")))).alias("eta_stops"),
        F.collect_list(F.struct("license_plate", *[f"p_{n}" for n in extremes])).alias("plates"))
    hit = None
    for n in extremes:
        at = F.col(f"p_{n}") == F.col(n)
        hit = at if hit is None else hit | at
    return per_trip.select("trip_id", *extremes, "eta_stops", F.inline("plates")).where(hit).select(
        "trip_id", "license_plate", *extremes, "eta_stops")


def stop_progress(sch_stops: DataFrame) -> DataFrame:
    """Scheduled / visited / common stops and completed fraction (AG-14)."""
    return sch_stops.withColumns({
        "common_stops": F.array_intersect("eta_stops", "sch_stops"),
    }).withColumns({
        "sch_stops_count": F.size("sch_stops"),
        "eta_stops_count": F.size("eta_stops"),
        "common_stops_count": F.size("common_stops"),
    }).withColumn("percent", F.try_divide(F.col("common_stops_count").cast("double"),
                                          F.col("sch_stops_count").cast("double")))


@dataclass
class TripRun:
    """Intermediate per-trip tables of one status run, reusable by P-2/P-3."""
    envelope: DataFrame          # trip_id, start_time, end_time, sch_stops
    plates: DataFrame            # trip_id, license_plate, first/last ping, extremes, eta_stops
    classified: DataFrame        # one row per scheduled trip (x plate when started)


def trip_run(live: DataFrame, sch: DataFrame, as_of: int, live_window=(None, None),
             sch_window=(None, None), thresholds: TripThresholds = TripThresholds()) -> TripRun:
    live = scan_window(live, "obs_epoch", *live_window)
    sch = drop_null_rows(scan_window(sch, "arrival_epoch", *sch_window, closed=False))
    env = timetable_envelope(sch)
    plates = plate_envelope(live)
    return TripRun(env, plates, classified_trips(env.join(plates, "trip_id", "left"), as_of, thresholds))


def classified_trips(joined: DataFrame, as_of, thresholds: TripThresholds = TripThresholds()) -> DataFrame:
    """Envelopes with their plates (NULL before the first ping) -> progress, ``status`` and ``trip_time``."""
    t = thresholds
    progressed = stop_progress(joined)
    started = F.col("license_plate").isNotNull() | F.col("first_ping").isNotNull()
    status = F.when(started, S.classify_trip("percent", "first_ping", "last_ping", "start_time",
                                             "end_time", t.dist_ratio, t.late_s, t.span_ratio))
    return progressed.withColumn(
        "status", S.classify_unstarted(status, "start_time", "end_time", as_of)
    ).withColumn(
        "trip_time", F.when(started, (F.col("end_time") - F.col("start_time")) / F.lit(60.0))
    )


def trip_status(live: DataFrame, sch: DataFrame, as_of: int, live_window=(None, None),
                sch_window=(None, None), thresholds: TripThresholds = TripThresholds(),
                offset_minutes: int = 330) -> DataFrame:
    """P-1: status of every scheduled trip, one row per (trip, plate) once started."""
    run = trip_run(live, sch, as_of, live_window, sch_window, thresholds)
    return status_rows(run, as_of, offset_minutes)


def status_rows(run: TripRun, as_of: int, offset_minutes: int = 330) -> DataFrame:
    return status_columns(run.classified, as_of, offset_minutes)


def status_columns(classified: DataFrame, as_of, offset_minutes: int = 330) -> DataFrame:
    """The columns of P-1; ``as_of`` is a number or a column of epoch seconds."""
    return classified.select(
        F.col("trip_id").cast("string").alias("trip_id"),
        "status",
        "license_plate",
        "trip_time",
        epoch_micros(S.first_present("last_ping", "end_time")).alias("observationDateTime"),
        F.col("max_latitude").alias("latitude"),
        F.col("min_longitude").alias("longitude"),
        observe_time_micros(as_of, offset_minutes).alias("observe_time"),
        S.daily_key("trip_id", as_of).alias("primary_key"),
    )


def _statuses(status) -> list[str]:
    return [status] if isinstance(status, str) else list(status)


def trip_delay(status_df: DataFrame, live: DataFrame, status, as_of: int,
               offset_minutes: int = 330) -> DataFrame:
    """P-2: approximate median ping delay per trip for one or several
    statuses, one row per (trip, plate) (AG-11).

    The status table is reduced to one row per trip and status, joined to the
    pings, and one partially aggregated ``groupBy`` gives the median and the
    plates.
    """
    trips = status_df.where(F.col("status").isin(*_statuses(status))).select(
        F.col("trip_id").cast("long").alias("trip_id"), "status").distinct()
    pings = live.where(F.col("trip_id").isNotNull()).select("trip_id", "license_plate", "trip_delay")
    told = pings.join(trips, "trip_id").groupBy("trip_id", "status").agg(
        F.percentile_approx("trip_delay", 0.5).alias("trip_delay"),
        F.collect_set(F.struct("license_plate")).alias("plates"))          # a struct keeps a missing plate
    return told.select("trip_id", "status", "trip_delay", F.explode("plates").alias("p")).select(
        F.col("trip_id").cast("string").alias("trip_id"),
        "trip_delay",
        F.col("p.license_plate").alias("license_plate"),
        S.run_key("trip_id", as_of).alias("primary_key"),
        observe_time_micros(as_of, offset_minutes).alias("observe_time"),
        "status",
    )


def trip_deviation(run: TripRun, status, as_of: int, offset_minutes: int = 330) -> DataFrame:
    """P-3: trips with the given status(es) whose visited stops leave the
    timetable (SC-20).

    One row per (trip, plate): the reference's plate-by-plate fan-out is
    collapsed (B10).
    """
    c = run.classified.where(F.col("status").isin(*_statuses(status)))
    c = c.where(S.deviates("eta_stops_count", "common_stops_count") == 1)
    return c.select(
        F.col("trip_id").cast("string").alias("trip_id"),
        S.array_text("eta_stops").alias("eta_stops"),
        S.array_text("sch_stops").alias("sch_stops"),
        S.array_text("common_stops").alias("common_stops"),
        "eta_stops_count", "sch_stops_count", "common_stops_count",
        observe_time_micros(as_of, offset_minutes).alias("observe_time"),
        "license_plate",
        S.run_key("trip_id", as_of).alias("primary_key"),
        "status",
    )


def scheduled_terminals(sch: DataFrame, as_of: int, day_window=(None, None),
                        single_stop_end_null: bool = True, offset_minutes: int = 330, distinct_stops: bool = False) -> DataFrame:
    """P-4: first and last scheduled stop and times per trip (AG-4).

    A trip with one extreme row has no end stop; with ``distinct_stops`` rows of
    one (sequence, stop) count once, for timetables that repeat rows.
    """
    sch = scan_window(sch, "arrival_epoch", *day_window, closed=False)
    # A timetable partition is one trip's stops (bounded), so a window is
    # cheap here, and the following groupBy on the same key reuses its
    # hash partitioning: one shuffle in total.
    w = Window.partitionBy("trip_id")
    ext = sch.select("trip_id", "stop_sequence", "stop_id", "arrival_epoch", "departure_epoch",
                     F.max("arrival_epoch").over(w).alias("end_time"),
                     F.min("departure_epoch").over(w).alias("start_time"))
    ext = ext.where((F.col("arrival_epoch") == F.col("end_time")) | (F.col("departure_epoch") == F.col("start_time")))
    seq_stop = F.struct("stop_sequence", "stop_id")
    term = ext.groupBy("trip_id").agg(
        F.min(seq_stop)["stop_id"].alias("start_stop"),
        F.max(seq_stop)["stop_id"].alias("last_stop"),
        ((F.min(seq_stop) != F.max(seq_stop)) if distinct_stops else (F.count(F.lit(1)) > 1)).alias("several"),
        F.min("start_time").alias("start_time"),
        F.min("end_time").alias("end_time"),
    )
    end_stop = F.when(F.col("several"), F.col("last_stop")) if single_stop_end_null else F.col("last_stop")
    return term.select(
        F.col("trip_id").cast("string").alias("trip_id"),
        F.col("start_stop").cast("string").alias("start_stop"),
        end_stop.cast("string").alias("end_stop"),
        epoch_micros("start_time").alias("start_time"),
        epoch_micros("end_time").alias("end_time"),
        S.daily_key("trip_id", as_of).alias("primary_key"),
        observe_time_micros(as_of, offset_minutes).alias("observed_time"),
    )


def trip_status_job(live: DataFrame, sch: DataFrame, as_of: int, out_dir: str,
                    live_window=(None, None), sch_window=(None, None),
                    thresholds: TripThresholds = TripThresholds(), recent_minutes: int = 15,
                    offset_minutes: int = 330) -> dict[str, str]:
    """The whole status run: six outputs from one computation of P-1.

    The classified per-trip table is checkpointed once (reliable checkpoint
    under ``spark.checkpoint.dir``) and every output reads it, instead of
    re-deriving the lineage per write.  Outputs are Parquet folders under
    ``out_dir``, by run date and run (a rerun of the same clock replaces its own
    rows): the recent-status history, the daily
    status table (per daily key the newest run's rows replace all earlier
    ones), delays and deviations for completed and live trips, from the pings
    of the window.  A stored daily table that cannot be read fails the job.
    Returns name -> path.
    """
    spark = live.sparkSession
    ensure_checkpoint_dir(spark)
    live = scan_window(live, "obs_epoch", *live_window)
    run = trip_run(live, sch, as_of, (None, None), sch_window, thresholds)
    run = TripRun(run.envelope, run.plates, run.classified.checkpoint(eager=True))
    status = status_rows(run, as_of, offset_minutes)
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in (
        "trip_status", "trip_status_live", "completed_trip_with_delay", "live_trip_with_delay",
        "completed_trip_with_deviation", "live_trip_with_deviation")}
    day = date_text(as_of)
    hist = recent(status, "observationDateTime", as_of, recent_minutes).withColumn(
        "primary_key", S.run_key("trip_id", as_of))
    commit_run(hist, paths["trip_status"], day, int(as_of))
    daily = replace_daily(spark, status.withColumn("run_date", F.lit(day)), paths["trip_status_live"], day)
    write_upserted(spark, daily, paths["trip_status_live"], ["run_date"])
    for st, kind in (("COMPLETED", "completed"), ("LIVE", "live")):
        commit_run(trip_delay(status, live, st, as_of, offset_minutes), paths[f"{kind}_trip_with_delay"], day, int(as_of))
        commit_run(trip_deviation(run, st, as_of, offset_minutes), paths[f"{kind}_trip_with_deviation"], day, int(as_of))
    return paths


def replace_daily(spark, fresh: DataFrame, path: str, day: str) -> DataFrame:
    """The day's rows after a run: the run's rows, and stored rows of keys it does
    not have.  Materialised, so that the stored day can be overwritten."""
    if path_exists(spark, f"{path}/run_date={day}"):
        stored = spark.read.schema(fresh.schema).parquet(path).where(F.col("run_date") == day)
        fresh = fresh.unionByName(unmatched(stored, fresh, "primary_key").select(*fresh.columns))
    return fresh.checkpoint(eager=True)


def status_history(status: DataFrame, offset_minutes: int = 330) -> DataFrame:
    """P-1 output (as stored) in the form that P-9 and P-10 read: ``trip_id``
    long, ``status``, ``observe_ts`` (run clock without its offset)."""
    shift = offset_minutes * 60 * 1_000_000
    return status.select(F.col("trip_id").cast("long").alias("trip_id"), "status",
                         F.timestamp_micros(F.col("observe_time") - F.lit(shift)).alias("observe_ts"))
