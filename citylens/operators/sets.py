"""Set operations (SET-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """Stack tables by column name (SET-1)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def difference(domain: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Domain rows with no match in ``present`` (SET-2): a left-anti join on
    the distinct present keys (combined map-side before they shuffle)."""
    return domain.join(present.select(*keys).distinct(), keys, "left_anti")


def zero_fill(counts: DataFrame, domain: DataFrame, keys: list[str], value: str = "count",
              keep_outside: bool = True) -> DataFrame:
    """A value for every domain key, 0 where absent (SET-4).

    ``keep_outside`` keeps counted keys that fall outside the domain (the
    reference unions observed counts with the missing domain cells).
    """
    how = "full" if keep_outside else "left"
    return domain.select(*keys).join(counts, keys, how).withColumn(
        value, F.coalesce(F.col(value), F.lit(0)))
