"""Feed loaders: timetable and incidents (P-13, P-14).

Each run appends to a history partitioned by run date (SNK-1), so a day's
reads prune to one folder.  A run that is repeated replaces its own rows: a
timetable is one run per service day, incidents are one per run of the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.functions.timeutil import date_text
from citylens.operators.windows import surrogate_key
from citylens.sources.ingest import flatten_incidents, flatten_timetable
from citylens.sources.sinks import append_history


def timetable_load(records: DataFrame, path: str, as_of: int, rec: str = "rec") -> None:
    """P-13: timetable JSON of the service day of ``as_of`` -> stored stop rows."""
    stops = flatten_timetable(records, date_text(as_of), rec)
    append_history(stops.withColumn("primary_key", surrogate_key("trip_id", "stop_sequence", "arrival_time")), path, as_of, run="day")


def incident_load(payloads: DataFrame, path: str, as_of: int, offset_minutes: int = 330, rec: str = "rec") -> None:
    """P-14: incident payloads -> stored incident rows."""
    rows = flatten_incidents(payloads, offset_minutes, rec)
    append_history(rows.withColumn("primary_key", surrogate_key("incidentId", "start")), path, as_of)


def schedule_of_timetable(stored: DataFrame) -> DataFrame:
    """P-13 output (as stored) in the form that P-1 and P-4 read: epoch seconds, long ids."""
    seconds = lambda c: F.expr(f"{c} div 1000000")
    return stored.select(F.col("trip_id").cast("long").alias("trip_id"), "stop_sequence", F.col("stop_id").cast("long").alias("stop_id"),
                         seconds("arrival_time").alias("arrival_epoch"), seconds("departure_time").alias("departure_epoch"))
