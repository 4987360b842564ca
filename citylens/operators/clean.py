"""Projections, casts and filters (PRJ-1 .. PRJ-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylens.operators.joins import join_back


def normalise_pings(df: DataFrame, cols: list[str] | None = None, swapped: bool = True,
                    lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Select a column subset; repair coordinates stored the wrong way round (PRJ-1)."""
    keep = [c for c in (cols or df.columns) if c not in (lat, lon)]
    if swapped:
        return df.select(*keep, F.col(lon).alias(lat), F.col(lat).alias(lon))
    return df.select(*keep, lat, lon)


def cast_cols(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient casts: malformed text becomes NULL instead of failing (PRJ-2)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows with any NULL (in ``subset``) removed (PRJ-3)."""
    return df.na.drop(how="any", subset=subset)


def filter_by(df: DataFrame, column: str, value) -> DataFrame:
    """Keep one category (PRJ-4)."""
    return df.where(F.col(column) == F.lit(value))


def recent(df: DataFrame, ts_us: str, as_of: int, minutes: int = 15) -> DataFrame:
    """Rows whose microsecond time is at or after ``as_of - minutes`` (PRJ-5)."""
    return df.where(F.col(ts_us) >= F.lit((int(as_of) - minutes * 60) * 1_000_000))


def extreme_rows(df: DataFrame, keys: list[str], extremes: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows equal to any one of several per-key extremes (PRJ-6).

    ``extremes`` maps an output name to ``(agg, column)`` with agg in
    ``min``/``max``.  The extremes come from a partially aggregated
    ``groupBy`` joined back on the keys, which stays balanced when one key
    holds a large share of the rows (AQE splits a skewed join partition; a
    window would put the whole key into one task).
    """
    aggs = [getattr(F, agg)(F.col(c)).alias(name) for name, (agg, c) in extremes.items()]
    ext = df.groupBy(*keys).agg(*aggs)
    hit: Column | None = None
    for name, (_, c) in extremes.items():
        cond = F.col(c) == F.col(name)
        hit = cond if hit is None else (hit | cond)
    return join_back(df, ext, keys).where(hit)


def drop_sentinel(df: DataFrame, column: str, sentinel=-1) -> DataFrame:
    """Drop unmatched rows (sentinel or NULL) (PRJ-7)."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != F.lit(sentinel)))
