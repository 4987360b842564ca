"""Clock arithmetic on epoch seconds (SC-6 .. SC-11).

Every function takes the clock as a parameter (``as_of`` epoch seconds);
nothing reads the wall clock, so reruns reproduce their output.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400
HOUR = 3600


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Timestamp (or NTZ timestamp) -> epoch seconds (SC-6)."""
    return F.unix_timestamp(col_(ts))


def from_epoch_seconds(epoch: str | Column) -> Column:
    """Epoch seconds -> TIMESTAMP (SC-6, inverse)."""
    return F.timestamp_seconds(col_(epoch))


def epoch_micros(epoch: str | Column) -> Column:
    """Epoch seconds -> epoch microseconds as long."""
    return (col_(epoch).cast("long") * F.lit(1_000_000)).cast("long")


def observe_time_micros(as_of: int | Column, offset_minutes: int = 330) -> Column:
    """Run clock shifted by a fixed offset, in epoch microseconds (SC-7)."""
    if isinstance(as_of, Column):
        return ((as_of + int(offset_minutes) * 60) * 1_000_000).cast("long")
    return F.lit((int(as_of) + int(offset_minutes) * 60) * 1_000_000).cast("long")


def minutes_between(later: str | Column, earlier: str | Column) -> Column:
    """(later - earlier) / 60.0 on epoch seconds (SC-8)."""
    return (col_(later) - col_(earlier)) / F.lit(60.0)


def hour_of_week(epoch: str | Column) -> Column:
    """Monday-based weekday * 24 + hour, 0..167, from epoch seconds (SC-9).

    Computed from the epoch directly (1970-01-01 was a Thursday, index 3),
    so it does not depend on the session time zone.
    """
    e = col_(epoch).cast("long")
    days = F.floor(e / F.lit(DAY))
    weekday = F.pmod(days + F.lit(3), F.lit(7))
    hour = F.floor(F.pmod(e, F.lit(DAY)) / F.lit(HOUR))
    return (weekday * 24 + hour).cast("int")


def window_bounds(as_of: int, spec: str, day_start: str | None = None) -> tuple[int, int]:
    """Driver-side literal bounds for a trailing window (SC-10).

    ``spec`` is one of ``"day"`` (from ``day_start`` on the day of ``as_of``),
    ``"<n>m"``, ``"<n>h"``, ``"<n>d"``, ``"<n>w"`` (trailing), ``"<n>d@"`` or
    ``"<n>w@"`` (from ``day_start`` on the day that many days or weeks back), or
    ``"<n>hh"`` (trailing whole hours: both ends truncated to the hour).
    Only two integers are produced; no data goes through the driver.
    """
    as_of = int(as_of)
    h, m, s = (int(x) for x in (day_start or "00:00:00").split(":"))
    clock = h * HOUR + m * 60 + s
    if spec == "day":
        return (as_of // DAY) * DAY + clock, as_of
    unit = spec.lstrip("0123456789")
    n = int(spec[: len(spec) - len(unit)])
    if unit in ("d@", "w@"):
        return (as_of // DAY - n * (7 if unit == "w@" else 1)) * DAY + clock, as_of
    if unit == "hh":
        end = (as_of // HOUR) * HOUR
        return end - n * HOUR, end
    size = {"m": 60, "h": HOUR, "d": DAY, "w": 7 * DAY}[unit]
    return as_of - n * size, as_of


def service_day_bounds(as_of: int) -> tuple[int, int]:
    """[midnight, next midnight) of the day containing ``as_of``."""
    start = (int(as_of) // DAY) * DAY
    return start, start + DAY


def date_text(as_of: int) -> str:
    """Calendar date of an epoch, ``YYYY-MM-DD`` (UTC frame)."""
    return _dt.datetime.fromtimestamp(int(as_of), _dt.timezone.utc).strftime("%Y-%m-%d")


def service_ts(date: str | Column, clock: str | Column) -> Column:
    """Service date text + clock text -> TIMESTAMP (SC-11)."""
    d = F.lit(date) if isinstance(date, str) and "-" in date else col_(date)
    return F.to_timestamp(F.concat_ws(" ", d, col_(clock)))
