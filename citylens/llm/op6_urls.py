"""URL filters: a blocked Bloom filter in front of an exact hash join.

Listed entries are keys: a whole canonical URL (``host/path``) that is blocked,
or a rule ``host + path prefix`` that blocks or allows its host, all subdomains
and every path that starts with the prefix.  A URL asks for its own key and,
for each host suffix of as many labels as a rule's host has and each length that
a rule's path has, for the key of that suffix and prefix.  The filter (fixed size, so safe to
broadcast) passes the keys that may be listed, the join on the key removes the
false positives, and the longest rule (then the longer host, then block) wins
over a listed URL.  Verdicts depend on the URL alone, so each distinct (host,
path) is judged once, however many rows share it.

Canonical host and path: the host follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, A-Z lower-cased; the path goes on up to ``?``, ``#`` or the
end.  A NULL url, or one without ``://``, has both empty and is allowed.

Defined results: repeated rows each get their row; a repeated rule counts once,
and a rule listed as both block and allow blocks; NULL entries are ignored;
columns other than id and url are ignored; empty tables give no rows; a very
long URL or one of very many labels costs no more keys than a short one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylens.llm import bloom
from citylens.llm.common import materialise

# The rules of the registered query (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# Host labels whose pages make the registered query's list of blocked URLs.
LISTED_LABELS = ["adult-x", "ads-track", "cheap-pills", "spam-farm"]
URL_MARK, RULE_MARK = "u:", "r:"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_urls(urls: DataFrame) -> DataFrame:
    """``urls(url)`` -> entries of whole canonical URLs."""
    return (urls.select(F.concat(F.lit(URL_MARK), host_of(F.col("url")), path_of(F.col("url"))).alias("key")).distinct()
            .select("key", F.lit(None).cast("string").alias("rule"), F.lit(0).alias("host_size"), F.lit("block").alias("entry_verdict")))


def rule_entries(rules: DataFrame) -> DataFrame:
    """``rules(host, path, verdict)`` -> entries of rules."""
    return (rules.where("host is not null and path is not null")
            .groupBy("host", "path").agg(F.max("verdict").alias("entry_verdict"))       # block sorts after allow
            .select(F.concat(F.lit(RULE_MARK), "host", F.lit("|"), "path").alias("key"), F.concat("host", "path").alias("rule"),
                    F.length("host").alias("host_size"), "entry_verdict"))


def candidate_keys(host: str, path: str, sizes: list[int], depths: list[int]) -> list[str]:
    """The URL's own key, and one per host suffix of as many labels and path prefix of as many characters as a rule has."""
    labels = host.split(".")
    suffixes = [".".join(labels[-n:]) for n in depths if n <= len(labels)]
    prefixes = [path[:n] for n in sizes if n <= len(path)]
    return [f"{URL_MARK}{host}{path}", *(f"{RULE_MARK}{s}|{p}" for s in suffixes for p in prefixes)]


def _possible(urls: DataFrame, blocks, sizes: list[int], depths: list[int]) -> DataFrame:
    """Keys of each (host, path) that pass the filter."""

    def run(batches):
        words = blocks.value
        for b in batches:
            keys, row = [], []
            for i, (h, p) in enumerate(zip(b.column("host").to_pylist(), b.column("path").to_pylist())):
                mine = candidate_keys(h, p, sizes, depths) if h or p else []
                keys.extend(mine)
                row.extend([i] * len(mine))
            hashes = np.array([xxhash.xxh64_intdigest(k.encode(), 42) for k in keys], dtype=np.uint64).view(np.int64)
            hit = np.flatnonzero(bloom.might_contain(words, hashes))
            at = pa.array([row[i] for i in hit], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("host").take(at), b.column("path").take(at),
                                              pa.array([keys[i] for i in hit], pa.string())], names=["host", "path", "key"])

    return urls.mapInArrow(run, "host string, path string, key string")


def judge(pages: DataFrame, rules: DataFrame, blocked: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: ``page_id, host, path, rule, verdict``.

    ``rules(host, path, verdict)``; ``blocked(url)`` lists whole URLs.  The lengths of the
    rules' paths and the numbers of labels of their hosts are collected (few numbers each),
    so a URL asks for as many keys as the rules need, however long it is.
    """
    spark = pages.sparkSession
    entries = materialise(rule_entries(rules).unionByName(listed_urls(blocked.where("url is not null"))), "url-entries")
    sizes = sorted(r["n"] for r in rules.where("path is not null").select(F.length("path").alias("n")).distinct().collect())
    depths = sorted(r["n"] for r in rules.where("host is not null").select(F.size(F.split("host", r"\.")).alias("n")).distinct().collect())
    blocks = spark.sparkContext.broadcast(bloom.build(entries.select(F.xxhash64("key").alias("h")), "h"))
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    exact = _possible(rows.select("host", "path").distinct(), blocks, sizes, depths).join(entries, "key")
    best = exact.groupBy("host", "path").agg(F.max(F.struct(
        F.coalesce(F.length("rule"), F.lit(-1)).alias("n"), "host_size", "entry_verdict", "rule")).alias("b"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.entry_verdict", F.lit("allow")).alias("verdict"))


def default_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def pages_of_listed_labels(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """URLs of pages one of whose host labels is listed: the query's stand-in for a block list."""
    labels = F.split(host_of(F.col(url_col)), r"\.")
    return pages.where(F.arrays_overlap(labels, F.array(*[F.lit(x) for x in LISTED_LABELS]))).select(F.col(url_col).alias("url"))
