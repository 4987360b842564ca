"""Upsert table: the newest row per key in hash buckets that split as they grow (SNK-2, ST-4).

A row's bucket is the longest known prefix of its key's hash (extendible
hashing).  A merge reads and rewrites only the buckets that its keys touch, as
new folders; a bucket that has outgrown ``bucket_rows`` is split by more bits
when it is next rewritten.  A small manifest per version lists the buckets'
folders, and writing it is the commit: a merge that dies before leaves the
table as it was, a reader keeps the version it began with, and the work of a
merge grows with the rows it touches, not with the table.  The ``keep`` newest
manifests stay; folders that none of them names are removed after a commit.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylens.operators.windows import latest_per_key
from citylens.session import delete_folder, list_names, read_text, write_text

BUCKET_ROWS = 1_000_000
KEEP = 3


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    return sorted(int(n.rpartition("/")[2].removesuffix(".json")) for n in list_names(spark, f"{path}/manifests/*.json"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """``{"version", "buckets": [{"depth", "prefix", "folder", "rows"}]}`` of a version (the newest)."""
    known = versions(spark, path)
    if not known:
        return None
    return json.loads(read_text(spark, _manifest_path(path, known[-1] if version is None else version)))


def _manifest_path(path: str, version: int) -> str:
    return f"{path}/manifests/{version:012d}.json"


def read_upserted(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame | None:
    """The rows of a version (the newest); ``None`` if nothing was committed yet."""
    found = manifest(spark, path, version)
    if found is None:
        return None
    return _rows(spark, path, schema, found["buckets"])


def _rows(spark: SparkSession, path: str, schema: T.StructType, buckets: list[dict]) -> DataFrame:
    folders = [f"{path}/{b['folder']}" for b in buckets if b["folder"]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _prefix(depth: Column) -> Column:
    """The first ``depth`` bits of the key's hash ``_h``."""
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", F.col("_h"), F.lit(64) - depth))


def _splits(size: int, bucket_rows: int) -> int:
    """More bits that bring ``size`` rows down to ``bucket_rows`` a bucket."""
    bits = 0
    while size > bucket_rows << bits:
        bits += 1
    return bits


def merge(batch: DataFrame, path: str, keys: list[str], order: list[str], version: int, bucket_rows: int = BUCKET_ROWS,
          keep: int = KEEP) -> bool:
    """Commit ``batch`` as ``version``; False if that version or a later one is committed already, or nothing came."""
    spark = batch.sparkSession
    found = manifest(spark, path)
    if found is not None and found["version"] >= version:
        return False
    buckets = found["buckets"] if found else [{"depth": 0, "prefix": 0, "folder": None, "rows": 0}]
    deepest = max(b["depth"] for b in buckets)
    slots = [(slot, i) for i, b in enumerate(buckets)
             for slot in range(b["prefix"] << deepest - b["depth"], b["prefix"] + 1 << deepest - b["depth"])]
    directory = spark.createDataFrame(slots, "_slot long, _bucket int")

    def placed(rows: DataFrame) -> DataFrame:
        hashed = rows.withColumn("_h", F.xxhash64(*keys))
        return hashed.withColumn("_slot", _prefix(F.lit(deepest))).join(directory, "_slot").drop("_slot")

    fresh = placed(latest_per_key(batch, keys, order))
    arrived = {r["_bucket"]: r["count"] for r in fresh.groupBy("_bucket").count().collect()}          # at most one row a bucket
    if not arrived:
        return False
    depths = {i: buckets[i]["depth"] + _splits(max(buckets[i]["rows"], n), bucket_rows) for i, n in arrived.items()}
    stored = _rows(spark, path, batch.schema, [buckets[i] for i in arrived])
    merged = latest_per_key(fresh.unionByName(placed(stored)), keys, order)
    depth = spark.createDataFrame(list(depths.items()), "_bucket int, _depth int")
    labelled = merged.join(depth, "_bucket").withColumn("bucket", F.concat_ws("-", F.col("_depth"), _prefix(F.col("_depth"))))
    data = f"data/v={version}"
    labelled.select(*batch.columns, "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{data}")
    sizes = {r["bucket"]: r["count"] for r in spark.read.parquet(f"{path}/{data}").groupBy(F.col("bucket").cast("string").alias("bucket")).count().collect()}

    after = [b for i, b in enumerate(buckets) if i not in arrived]
    for i, deep in depths.items():
        extra = deep - buckets[i]["depth"]
        for prefix in range(buckets[i]["prefix"] << extra, buckets[i]["prefix"] + 1 << extra):
            label = f"{deep}-{prefix}"
            after.append({"depth": deep, "prefix": prefix, "folder": f"{data}/bucket={label}" if label in sizes else None, "rows": sizes.get(label, 0)})
    write_text(spark, _manifest_path(path, version), json.dumps({"version": version, "buckets": after}))
    _forget(spark, path, keep)
    return True


def _forget(spark: SparkSession, path: str, keep: int) -> None:
    """Remove manifests but the newest ones, and folders that none of those names."""
    known = versions(spark, path)
    for version in known[:-keep]:
        delete_folder(spark, _manifest_path(path, version))
    named = {b["folder"] for version in known[-keep:] for b in manifest(spark, path, version)["buckets"]}
    for folder in list_names(spark, f"{path}/data/v=*/bucket=*"):
        if "/".join(folder.split("/")[-3:]) not in named:
            delete_folder(spark, folder)
