"""Query / oracle registry and the shared test parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Clock and thresholds that fit the generated data (FIXTURES).
AS_OF = 1705363200          # 2024-01-16 00:00 UTC
LATE_S = 432000             # lateness threshold, seconds
GAP_S = 36000               # message gap limit, seconds
WEEK_S = 7 * 86400
OFFSET_MIN = 330            # observe_time clock shift, minutes


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco
