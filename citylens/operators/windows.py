"""Window-style operators (W-1 .. W-8).

Where a window would put one whole key into one task, the operator is
written as a partially aggregated ``groupBy`` (plus a join back when the
value is needed on every row): map-side combine and AQE's skew-join split
keep a hot key from becoming one giant task.  True order-dependent windows
(``lag``) are bucketed in time so one key is spread over many partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylens.operators.joins import join_back, keyed
from citylens.session import ensure_checkpoint_dir


def partition_minmax(df: DataFrame, keys: list[str], aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Per-partition max/min kept on every row (W-1).

    ``aggs`` maps output name -> (``min``/``max``, column).  Written as
    ``groupBy`` + equi-join back on the keys.
    """
    ext = df.groupBy(*keys).agg(*[getattr(F, a)(F.col(c)).alias(n) for n, (a, c) in aggs.items()])
    return join_back(df, ext, keys)


def order_code(df: DataFrame, ts: str, tiebreak: str) -> Column:
    """(epoch seconds, id) as one value, ordered like the pair; a NULL id is the lowest.

    An integer id gives one decimal, so that extremes run as hash aggregates;
    any other id that has an order (text, uuid) a struct.
    """
    if not isinstance(df.schema[tiebreak].dataType, T.IntegralType):
        return F.struct(F.col(ts), F.col(tiebreak))
    return F.expr(f"cast({ts} as decimal(18, 0)) * 100000000000000000000BD"
                  f" + coalesce(cast({tiebreak} as decimal(20, 0)), -9223372036854775808BD)")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key under a total order (W-2, SO-3).

    ``row_number() = 1``: Spark plans a window group limit, which keeps one
    row per key and task before the shuffle, so a hot key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def drop_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows but the newest per group; single-row groups vanish (W-3).

    The newest order values per group (top-1 over the narrow key columns) are
    joined back per key and the row that equals them is dropped — the order
    columns must identify a row within its group.
    """
    top = latest_per_key(df.select(*keys, *order), keys, order).select(*keys, *[F.col(c).alias(f"_top_{c}") for c in order])
    same = None
    for c in order:
        eq = F.col(c).eqNullSafe(F.col(f"_top_{c}"))
        same = eq if same is None else same & eq
    return join_back(df, top, keys).where(~same).drop(*[f"_top_{c}" for c in order])


def in_total_order(df: DataFrame, order: list[str], rank: str = "_rank") -> DataFrame:
    """``rank``: the place of a row (0, 1, ...) in the order of the whole table, without one window over it.

    Rows are range partitioned by ``order``, sorted and checkpointed; a row's
    place is its number in its partition plus the rows of the partitions
    before, which are summed over one row a partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()}).checkpoint(eager=True)
    sizes = rows.groupBy("_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))      # a row a partition
    sizes = sizes.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_size")
    return rows.join(sizes, "_part").withColumn(rank, F.col("_seq") - F.col("_first") + F.col("_before")) \
        .drop("_part", "_seq", "_first", "_before")


def gap_seconds(df: DataFrame, keys: list[str], ts: str, tiebreak: str | None = None,
                bucket_s: int | None = 3600, out: str = "gap") -> DataFrame:
    """Seconds since the previous row of the same key (W-4); NULL for the first.

    With ``bucket_s`` the window is partitioned by (keys, time bucket) so a
    key with very many rows is spread over buckets; the first row of each
    bucket then takes its predecessor from the previous non-empty bucket's
    last timestamp (a second, tiny window over per-bucket summaries).
    """
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    if not bucket_s:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.col(ts) - F.lag(ts, 1).over(w))
    # key and bucket as one struct: the lag window and the join of the carried
    # timestamps share its hash partitioning, so the rows shuffle once
    d = df.withColumn("_bucket", F.floor(F.col(ts) / F.lit(bucket_s)))
    d = keyed(d, [*keys, "_bucket"])
    d = d.withColumn("_prev", F.lag(ts, 1).over(Window.partitionBy("_key").orderBy(*order)))
    summary = keyed(df.withColumn("_bucket", F.floor(F.col(ts) / F.lit(bucket_s))), [*keys, "_bucket"]) \
        .groupBy("_key").agg(F.max(ts).alias("_last"))
    before = Window.partitionBy(*[f"_key.{k}" for k in keys]).orderBy("_key._bucket")
    carry = summary.select("_key", F.lag("_last", 1).over(before).alias("_carry"))
    d = d.join(carry, "_key", "left")
    return d.withColumn(out, F.col(ts) - F.coalesce(F.col("_prev"), F.col("_carry"))).drop(
        "_key", "_bucket", "_prev", "_carry")


def count_over(df: DataFrame, keys: list[str], column: str, out: str = "weight") -> DataFrame:
    """count(column) per key kept on every row (W-5)."""
    cnt = df.groupBy(*keys).agg(F.count(column).alias(out))
    return join_back(df, cnt, keys)


def percentile_over(df: DataFrame, keys: list[str], column: str, q: float = 0.5,
                    out: str = "median") -> DataFrame:
    """Approximate percentile per key on every row (W-6)."""
    med = df.groupBy(*keys).agg(F.percentile_approx(column, q).alias(out))
    return join_back(df, med, keys)


def span_over(df: DataFrame, keys: list[str], ts: str, out: str = "dwell_time") -> DataFrame:
    """max(ts) - min(ts) per key on every row (W-7)."""
    sp = df.groupBy(*keys).agg((F.max(ts) - F.min(ts)).alias(out))
    return join_back(df, sp, keys)


def surrogate_key(*cols) -> Column:
    """Deterministic unique key from a natural key (W-8).

    Replaces uuid + global ``row_number`` (which forces one partition) with
    a SHA-256 of the natural key: parallel, reproducible across reruns.
    """
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("\u0000"))
             for c in cols]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)
