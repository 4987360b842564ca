"""Join shapes used by the products (JN-1 .. JN-6).

No join hint is forced: Catalyst/AQE choose broadcast (from runtime sizes,
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``) or sort-merge, and
AQE splits skewed partitions of the large side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inner_chain(first: DataFrame, *others: DataFrame, on: str | list[str] = "trip_id") -> DataFrame:
    """Inner equi-joins of several keyed tables (JN-1)."""
    return reduce(lambda a, b: a.join(b, on, "inner"), others, first)


def unmatched(left: DataFrame, right: DataFrame, on: str | list[str] = "trip_id") -> DataFrame:
    """Left rows with no right match (JN-2, JN-5): a left-anti join, not
    left-join-then-IS-NULL (Catalyst does not rewrite the latter).  The right
    keys are made distinct first: that combines map-side, so a key with very
    many right rows shuffles as one row per task."""
    keys = [on] if isinstance(on, str) else on
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def enrich(left: DataFrame, right: DataFrame, on: str | list[str] = "trip_id") -> DataFrame:
    """Left join to attach optional attributes (JN-3)."""
    return left.join(right, on, "left")


def merge_outer(left: DataFrame, right: DataFrame, on: str | list[str] = "trip_id") -> DataFrame:
    """Full outer merge (JN-4)."""
    return left.join(right, on, "full")


def existing(left: DataFrame, right: DataFrame, on: str | list[str] = "trip_id") -> DataFrame:
    """Left rows that have a match, without fan-out on duplicate right keys (JN-6)."""
    keys = [on] if isinstance(on, str) else on
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def keyed(df: DataFrame, keys: list[str], out: str = "_key") -> DataFrame:
    """Add the key columns as one struct.  Structs with NULL fields compare
    equal field by field, so grouping by, windowing over and joining on the
    struct treat a NULL key as one group, and all of them share one hash
    partitioning."""
    return df.withColumn(out, F.struct(*keys))


def join_back(df: DataFrame, agg: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join per-key values back onto their rows; NULL keys form one group as
    they do in ``groupBy`` and in window partitions (see :func:`keyed`)."""
    out = keyed(df, keys).join(keyed(agg, keys).drop(*keys), "_key", how)
    return out.drop("_key")
