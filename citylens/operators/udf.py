"""Python extension points (UDF-2, UDF-3).

Both run vectorised over Arrow batches.  The library's own products do not
use them (every product is built from native expressions); they exist for
user-supplied per-group or per-batch logic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_grouped(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
                  schema: T.StructType | str) -> DataFrame:
    """One pandas function per group with a declared output schema (UDF-2).

    Spark shuffles by ``keys`` and hands each whole group to ``fn``: keep
    groups bounded (e.g. include a time bucket in ``keys``).
    """
    return df.groupBy(*keys).applyInPandas(fn, schema)


def apply_grouped_stream(df: DataFrame, keys: list[str], fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                         schema: T.StructType | str, order: list[str] | None = None) -> DataFrame:
    """One function per group that reads the group as Arrow batches, in ``order`` if given (UDF-2).

    A group is never put together: Spark sorts by ``keys`` (spilling) and hands
    over one batch after the other, so a group of a third of all rows needs no
    more memory than a small one.  It is still one task's work; a function
    whose parts merge should also group by a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)

    rows = df.repartition(*keys).sortWithinPartitions(*keys, *order) if order else df
    return rows.groupBy(*keys).applyInArrow(run, schema)


def vectorised(fn: Callable[..., pd.Series], return_type: T.DataType | str) -> Callable[..., Column]:
    """Wrap a Series -> Series function as an Arrow ``pandas_udf`` (UDF-3)."""
    return F.pandas_udf(fn, return_type)


# ---- small ready-made functions used in the examples and tests

def trip_span(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per-group first/last epoch and row count (groups are (trip, bucket))."""
    return pd.DataFrame({
        "trip_id": [pdf["trip_id"].iloc[0]],
        "bucket": [pdf["bucket"].iloc[0]],
        "first_ping": [int(pdf["obs_epoch"].min())],
        "last_ping": [int(pdf["obs_epoch"].max())],
        "n_pings": [int(len(pdf))],
    })


TRIP_SPAN_SCHEMA = "trip_id long, bucket long, first_ping long, last_ping long, n_pings long"


def hour_of_week_pd(epoch: pd.Series) -> pd.Series:
    """Monday-based hour of week from epoch seconds, vectorised."""
    ts = pd.to_datetime(epoch, unit="s", utc=True)
    return (ts.dt.weekday * 24 + ts.dt.hour).astype("int32")


def longest_silence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest gap between consecutive messages of a vehicle label, batch by batch (rows by epoch)."""
    label, last, widest, n = None, None, None, 0
    for batch in batches:
        epochs = batch.column("obs_epoch")
        if not len(epochs):
            continue
        label = batch.column("label")[0].as_py()
        gaps = pc.pairwise_diff(epochs) if last is None else pc.pairwise_diff(pa.concat_arrays([pa.array([last], epochs.type), epochs]))
        most = pc.max(gaps).as_py()
        widest = most if widest is None else widest if most is None else max(widest, most)
        last, n = epochs[-1].as_py(), n + len(epochs)
    if n:
        yield pa.RecordBatch.from_pydict({"label": pa.array([label], pa.string()), "longest_gap": pa.array([widest], pa.int64()),
                                          "n_messages": pa.array([n], pa.int64())})


SILENCE_SCHEMA = "label string, longest_gap long, n_messages long"
