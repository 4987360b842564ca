"""Aggregations (AG-*) not specific to one product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylens.operators.joins import join_back


def count_by(df: DataFrame, keys: list[str], out: str = "count") -> DataFrame:
    """Rows per key (AG-1); partial + final hash aggregate."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def collect_sorted_set(df: DataFrame, keys: list[str], column: str, out: str) -> DataFrame:
    """Distinct values per key as a sorted array (AG-3)."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(column)).alias(out))


def first_last_by(df: DataFrame, keys: list[str], value: str, order: str,
                  first: str = "first", last: str = "last") -> DataFrame:
    """Value at the smallest and largest order per key (AG-4), ties by value.

    The two order bounds are numeric minima and maxima (hash aggregate); only
    the rows at a bound take part in the second aggregate."""
    bounds = df.groupBy(*keys).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    ends = join_back(df.select(*keys, order, value), bounds, keys)
    at = lambda bound: F.when(F.col(order) == F.col(bound), F.col(value))
    return ends.where((F.col(order) == F.col("_lo")) | (F.col(order) == F.col("_hi"))).groupBy(*keys).agg(
        F.min(at("_lo")).alias(first), F.max(at("_hi")).alias(last))


def conditional_counts(df: DataFrame, keys: list[str], conds: dict[str, Column]) -> DataFrame:
    """One count per condition (AG-5)."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conds.items()])


def global_minmax(df: DataFrame, column: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """One-row min/max (AG-6)."""
    return df.agg(F.min(column).alias(lo), F.max(column).alias(hi))


def global_bounds(df: DataFrame, column: str) -> tuple[Column, Column]:
    """min/max of a column as scalar subqueries, usable in any expression.

    Spark runs them once (merged into one subquery) and inlines the values:
    no collect to the driver and no join to attach them.
    """
    return df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key subset, the first under a total order (AG-7): top-1 with
    a window group limit, one row per key and task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order if c in rest] + [c for c in rest if c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) for c in ordered])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
