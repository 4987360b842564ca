"""Exact deduplication with counting quotient filters.

A 64-bit fingerprint (XXH64 of the text) splits into a quotient, its top
``QUOTIENT_BITS`` bits, and a remainder.  Every partition builds its own
counting filter: per quotient a run of sorted remainders with counters.  Runs
shuffle by quotient and merge by their sorted remainders, counters added, so
nothing is lost against one filter over all rows.  Only fingerprints counted
more than once go on: a Bloom filter of them (fixed size, so safe to broadcast)
and then an exact semi join route their rows, whose whole texts are compared
byte by byte (grouped by the text itself).  Texts whose fingerprint is alone
are unique and never move.

Hot groups: the filter holds a repeated fingerprint once per partition with its
count; routed rows are combined per task by text before they shuffle, then per
salt, then per text, so a group of copies that is a third of all rows meets as
a few rows.

Defined results: NULL text equals the empty text; of equal texts the row with
the largest id stays (a NULL id only if the group has no other; of fully equal
rows exactly one); columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.llm import bloom
from citylens.llm.common import keep_one_row_each, materialise, text_or_empty

QUOTIENT_BITS = 12
SALTS = 64
FLUSH_BYTES = 32 << 20   # texts a task combines before it emits them


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values and counters of several filters, equal values' counters added."""
    values = np.concatenate([v for v, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    values, back = np.unique(values, return_inverse=True)
    return values, np.bincount(back, weights=counts, minlength=values.size).astype(np.int64)


def partition_filters(fps: DataFrame) -> DataFrame:
    """``fps(fp)`` -> runs ``(quotient, remainders, counts)``, each partition its own filter."""
    low = 64 - QUOTIENT_BITS

    def run(batches):
        seen = [np.unique(b.column("fp").to_numpy().view(np.uint64), return_counts=True) for b in batches]
        if not seen:
            return
        values, counts = _merge(seen)
        quotients = (values >> np.uint64(low)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]]) if values.size else np.zeros(0, np.int64)
        cuts = first[1:]
        rest = values & np.uint64((1 << low) - 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(quotients[first]), pa.array([x.tobytes() for x in np.split(rest, cuts)] if first.size else [], pa.binary()),
             pa.array([x.tobytes() for x in np.split(counts, cuts)] if first.size else [], pa.binary())],
            names=["quotient", "remainders", "counts"])

    return fps.mapInArrow(run, "quotient bigint, remainders binary, counts binary")


def merged_counts(filters: DataFrame, at_least: int = 2) -> DataFrame:
    """Merge the runs of all partitions; ``(fp, n)`` of fingerprints counted ``at_least`` times."""
    low = 64 - QUOTIENT_BITS

    def run(batches):
        parts = []
        for b in batches:
            for q, r, c in zip(*(b.column(i).to_pylist() for i in ("quotient", "remainders", "counts"))):
                parts.append((np.frombuffer(r, np.uint64) | np.uint64(q << low), np.frombuffer(c, np.int64)))
        if parts:
            values, counts = _merge(parts)
            many = counts >= at_least
            yield pa.RecordBatch.from_arrays([pa.array(values[many].view(np.int64)), pa.array(counts[many])], names=["fp", "n"])

    parts = int(filters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return filters.repartition(parts, "quotient").mapInArrow(run, "fp bigint, n bigint")


def _combine(rows: DataFrame, blocks) -> DataFrame:
    """Rows whose fingerprint the filter passes, combined per task: ``(fp, text, salt, last_id, n)``."""
    kind = rows.schema["doc_id"].dataType

    def run(batches):
        filter_words, salt = blocks.value, TaskContext.get().partitionId() % SALTS
        groups, held = {}, 0

        def emit():
            if groups:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in groups.values()], pa.int64()), pa.array(list(groups), pa.string()),
                     pa.array([salt] * len(groups), pa.int32()), pa.array([g[1] for g in groups.values()], id_type),
                     pa.array([g[2] for g in groups.values()], pa.int64())], names=["fp", "text", "salt", "last_id", "n"])

        id_type = None
        for b in batches:
            id_type = b.column("doc_id").type
            hit = bloom.might_contain(filter_words, b.column("fp").to_numpy())
            b = b.filter(pa.array(hit))
            for i, fp, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "fp", "text"))):
                g = groups.get(text)
                if g is None:
                    groups[text] = [fp, i, 1]
                    held += len(text) + 200
                else:
                    g[1] = i if g[1] is None or (i is not None and i > g[1]) else g[1]
                    g[2] += 1
            if held > FLUSH_BYTES:
                yield from emit()
                groups, held = {}, 0
        yield from emit()

    return rows.mapInArrow(run, f"fp bigint, text string, salt int, last_id {kind.simpleString()}, n bigint")


def equal_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified groups of two or more equal texts: ``(sha, keep_id, group_size)``, sha as binary."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"),
                       F.xxhash64(text_or_empty(text_col)).alias("fp"))
    repeated = materialise(merged_counts(partition_filters(rows.select("fp"))), "cqf")
    blocks = spark.sparkContext.broadcast(bloom.build(repeated, "fp"))
    routed = (_combine(rows, blocks).groupBy("fp", "text", "salt")
              .agg(F.max("last_id").alias("last_id"), F.sum("n").alias("n")))
    groups = (routed.join(repeated.select("fp"), "fp", "left_semi").groupBy("fp", "text")
              .agg(F.max("last_id").alias("keep_id"), F.sum("n").alias("group_size")).where("group_size > 1"))
    return groups.select(F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size")


def _verdicts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per (id, text): ``doc_id, sha, text_key, n_rows, keep_id, group_size``."""
    text = text_or_empty(text_col)
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha"), F.xxhash64(text).alias("text_key"))
            .groupBy("doc_id", "sha", "text_key").agg(F.count("*").alias("n_rows")))
    groups = materialise(equal_groups(docs, id_col, text_col), "equal")
    return rows.join(groups, "sha", "left").select(
        "doc_id", "sha", "text_key", "n_rows",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return _verdicts(docs, id_col, text_col).select(
        "doc_id", "keep_id", "group_size", F.lower(F.hex("sha")).alias("text_sha256"),
        F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("i")).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with one row of each group of equal texts, the columns of ``docs``."""
    verdict = _verdicts(docs, id_col, text_col).select(
        "doc_id", "text_key", "n_rows", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))
    return keep_one_row_each(docs, materialise(verdict, "equal-verdict"), id_col, text_col)
