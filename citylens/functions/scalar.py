"""Scalar column expressions: keys, text, math, classification (SC-*).

All are built-in Catalyst expressions so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citylens.functions.timeutil import date_text


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- keys, text
def daily_key(id_col, as_of) -> Column:
    """id + calendar date of the run: one key per id and day (SC-1)."""
    day = F.date_format(F.timestamp_seconds(as_of), "yyyy-MM-dd") if isinstance(as_of, Column) else F.lit(date_text(as_of))
    return F.concat(_c(id_col).cast("string"), day)


def run_key(id_col, as_of: int) -> Column:
    """id + run epoch seconds: one key per id and run (SC-1)."""
    return F.concat(_c(id_col).cast("string"), F.lit(str(int(as_of))))


def first_present(*cols) -> Column:
    """First non-NULL of the arguments (SC-2)."""
    return F.coalesce(*[_c(c) for c in cols])


def square_brackets(text) -> Column:
    """Round brackets -> square brackets (SC-3)."""
    return F.translate(_c(text), "()", "[]")


def parse_epoch_text(text) -> Column:
    """``/Date(<ms>)/`` -> epoch microseconds; malformed -> NULL (SC-4)."""
    digits = F.regexp_extract(_c(text), r"^/?Date\((-?\d+)", 1)
    return (F.when(digits != "", digits).cast("long") * F.lit(1000)).cast("long")


def array_text(arr) -> Column:
    """Array rendered as ``[a, b, c]`` text (SC-5)."""
    return F.concat(F.lit("["), F.array_join(_c(arr), ", "), F.lit("]"))


def fill_missing_text(c, default: str = "") -> Column:
    """Absent optional text field -> default (SC-25)."""
    return F.coalesce(_c(c), F.lit(default))


# ---------------------------------------------------------------- math
def minmax_bucket(value, lo, hi, buckets: int = 5, zero_range_bucket: int | None = 1) -> Column:
    """``floor((buckets-1) * (v - lo) / (hi - lo)) + 1``; zero range -> bucket (SC-12)."""
    v, lo, hi = _c(value), _c(lo), _c(hi)
    raw = F.floor(F.try_divide((v - lo) * F.lit(float(buckets - 1)), (hi - lo).cast("double"))) + F.lit(1)
    out = raw.cast("int")
    if zero_range_bucket is not None:
        out = F.coalesce(out, F.lit(zero_range_bucket))
    return out


SCALE_MIN = -1.0
SCALE_MAX = 500.0


def scale(value, lo: float = SCALE_MIN, hi: float = SCALE_MAX) -> Column:
    """(x - lo) / (hi - lo) (SC-13)."""
    return (_c(value) - F.lit(lo)) / F.lit(hi - lo)


def unscale(value, lo: float = SCALE_MIN, hi: float = SCALE_MAX) -> Column:
    """Inverse of :func:`scale` (SC-13)."""
    return _c(value) * F.lit(hi - lo) + F.lit(lo)


def clean_negative(value, sentinel: float = -1.0) -> Column:
    """Negative -> sentinel (SC-13)."""
    return F.when(_c(value) < 0, F.lit(sentinel)).otherwise(_c(value))


def clamp_floor(value, floor) -> Column:
    """max(value, floor) (SC-14)."""
    return F.greatest(_c(value), _c(floor) if not isinstance(floor, (int, float)) else F.lit(float(floor)))


def euclid(x1, y1, x2, y2) -> Column:
    """Planar distance in degrees (SC-15)."""
    return F.sqrt(F.pow(_c(x1) - _c(x2), 2) + F.pow(_c(y1) - _c(y2), 2))


def cap_sentinel(value, cap: float = 500.0, sentinel: float = -1.0) -> Column:
    """value above cap -> sentinel (SC-26)."""
    return F.when(_c(value) > cap, F.lit(sentinel)).otherwise(_c(value))


# ---------------------------------------------------------------- conditions
def classify_trip(percent, first_ping, last_ping, start, end, dist_ratio: float = 0.6,
                  late_s: float = 3600, span_ratio: float = 0.6) -> Column:
    """LIVE / INCOMPLETE / COMPLETED / LATE / MISSED (SC-16).

    First match wins.  ``span`` is |(last - first) / (end - start)|; a zero
    length timetable gives NULL and the trip falls through to LATE/MISSED.
    """
    p, f0, f1, s, e = (_c(x) for x in (percent, first_ping, last_ping, start, end))
    span = F.abs(F.try_divide((f1 - f0).cast("double"), (e - s).cast("double")))
    a = F.abs(f1 - e)
    b = F.abs(f0 - s)
    return (F.when((p < dist_ratio) & (span <= span_ratio), "LIVE")
            .when((p < dist_ratio) & (span > span_ratio), "INCOMPLETE")
            .when((p >= dist_ratio) & (a < late_s) & (b < late_s), "COMPLETED")
            .when(((p >= dist_ratio) & (a >= late_s)) | (b >= late_s), "LATE")
            .otherwise("MISSED"))


def classify_unstarted(status, start, end, as_of) -> Column:
    """NULL status -> NOT STARTED before/inside the window, MISSED after (SC-17)."""
    st, s, e = _c(status), _c(start), _c(end)
    now = as_of if isinstance(as_of, Column) else F.lit(int(as_of))
    return (F.when(st.isNotNull(), st)
            .when((now < s) | (now <= e), "NOT STARTED")
            .when(now > e, "MISSED"))


# Dwell cut points (seconds) of the five traffic categories.
TRAFFIC_CUTS = (60, 180, 300, 600)


def traffic_category(dwell, cuts=TRAFFIC_CUTS) -> Column:
    """Dwell seconds -> category 1..len(cuts)+1 (SC-18)."""
    d = _c(dwell)
    expr = None
    for i, cut in enumerate(cuts, start=1):
        expr = F.when(d < cut, i) if expr is None else expr.when(d < cut, i)
    return expr.otherwise(len(cuts) + 1).cast("int")


def fault_flag(gap, limit: float = 110) -> Column:
    """1 when there is no previous message or the gap exceeds the limit (SC-19)."""
    return F.when(F.coalesce(_c(gap) > limit, F.lit(True)), 1).otherwise(0).cast("int")


def deviates(visited_count, common_count) -> Column:
    """1 when some visited stop is not a scheduled one (SC-20)."""
    return F.when(_c(visited_count) == _c(common_count), 0).otherwise(1).cast("int")


def is_faulty(not_faulty, faulty) -> Column:
    """More faulty than healthy gaps (SC-21)."""
    return F.coalesce(_c(not_faulty) < _c(faulty), F.lit(False))


# Incident type codes and their labels.
INCIDENT_TYPES = {
    1: "Accident",
    2: "Congestion",
    3: "DisabledVehicle",
    4: "MassTransit",
    5: "Miscellaneous",
    6: "OtherNews",
    7: "PlannedEvent",
    8: "RoadHazard",
    9: "Construction",
    10: "Alert",
    11: "Weather",
}


def decode(code, mapping: dict = INCIDENT_TYPES) -> Column:
    """Code -> label through a literal map; unknown -> NULL (SC-22)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(code).cast("int"))


def element(arr, index: int) -> Column:
    """0-based element, out of range -> NULL (SC-23)."""
    return F.get(_c(arr), index)


# ---------------------------------------------------------------- geometry text
def ring_text(ring, digits: int = 6) -> Column:
    """``array<array<double>>`` ring -> ``[[x, y], [x, y], ...]`` text."""
    fmt = f"[%.{digits}f, %.{digits}f]"
    pts = F.transform(_c(ring), lambda p: F.format_string(fmt, p[0], p[1]))
    return F.concat(F.lit("["), F.array_join(pts, ", "), F.lit("]"))


def polygon_json(ring, digits: int = 6) -> Column:
    """Ring -> the product's polygon text (SC-24).

    Fixed value: the layout ``{"type": "Polygon", "geometry": {"type":
    "Polygon", "coordinates": [ring] }}`` with fixed-decimal vertices.
    """
    return F.concat(F.lit('{"type": "Polygon", "geometry": {"type": "Polygon", "coordinates": ['),
                    ring_text(ring, digits), F.lit("] }}"))
