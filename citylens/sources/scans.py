"""Range scans over event-time columns (SRC-1 .. SRC-4, SRC-10).

Bounds are literals, so the comparison reaches the Parquet reader as a
pushed filter (row-group skipping) and, for date-partitioned tables,
partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_window(df: DataFrame, ts: str, start=None, end=None, closed: bool = True,
                partition_col: str | None = None) -> DataFrame:
    """Rows with ``start <= ts <= end`` (closed) or ``start <= ts < end``.

    ``None`` leaves that side open, which is how tests scan a whole table.
    Bounds are compared in the column's own type (epoch numbers or
    timestamps).  For tables partitioned by a ``yyyy-MM-dd`` date column,
    name it in ``partition_col``: the day range of the bounds is added as a
    partition filter, so only the folders of those days are listed and read.
    """
    cond = None
    if start is not None:
        cond = F.col(ts) >= F.lit(start)
    if end is not None:
        upper = F.col(ts) <= F.lit(end) if closed else F.col(ts) < F.lit(end)
        cond = upper if cond is None else cond & upper
    if partition_col is not None:
        day = F.col(partition_col).cast("string")
        if start is not None:
            cond = cond & (day >= F.lit(_day(start)))
        if end is not None:
            cond = cond & (day <= F.lit(_day(end)))
    return df if cond is None else df.where(cond)


def _day(bound) -> str:
    """yyyy-MM-dd of an epoch-seconds number or a datetime bound (UTC)."""
    import datetime as dt
    if isinstance(bound, (int, float)):
        return dt.datetime.fromtimestamp(int(bound), dt.timezone.utc).strftime("%Y-%m-%d")
    return bound.strftime("%Y-%m-%d")


def scan_status(df: DataFrame, ts: str, status: str, start=None, end=None,
                status_col: str = "status") -> DataFrame:
    """Range scan plus equality on a category (SRC-3)."""
    return scan_window(df, ts, start, end).where(F.col(status_col) == F.lit(status))


def scan_full(spark: SparkSession, name: str) -> DataFrame:
    """Unfiltered scan of a registered table or view (SRC-4)."""
    return spark.table(name)


def rows_to_df(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Literal rows with a declared schema (SRC-10); for small parameter tables."""
    return spark.createDataFrame(rows, schema)
