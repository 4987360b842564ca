"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: A-Z lower-cased, words are runs of characters other than space
and ``\\x09-\\x0D``, shingles are 3 consecutive words joined by a space (a
shorter text is one shingle, no word gives fingerprint zero); bit j is one if
it is one in more than half of the shingles' XXH64 (seed 42), repeats counted.

Two fingerprints link if they differ in at most 3 bits.  Such a pair has a
meeting point within distance 1 of one and 2 of the other, so every fingerprint
emits the variants within half the radius and colliding variants name the
pairs.  Three facts keep the emission small without losing a pair:

* at distance 3 the parities differ, so only odd fingerprints need the radius 2
  variants (at distance 2 both reach the midpoint with one flip each);
* of three differing bits two lie in the same 32-bit half, so the two flips
  need only pairs inside a half;
* a variant's shuffle key is its top bits, so a fingerprint travels once per
  key that its variants can have and the task at that key expands them; a key
  with more than ``max_variants`` (a family of near copies shares its top bits)
  is dealt again by ``STEP`` more bits, so no piece of a task is larger.

Members of one collision are joined as a star around the member nearest to the
variant (distances verified), each task reduces its stars to a forest, and the
forests meet in ``connected_components``: no group is expanded into pairs.

Defined results: NULL text is empty (fingerprint zero, linked like any other);
equal texts share a fingerprint; NULL ids take part but never name a component
unless the component has no other id; repeated rows each return their row;
columns other than the id and the text are ignored; an empty table gives none.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.llm.common import keep_one_row_each, materialise, text_or_empty
from citylens.llm.components import connected_components

SEED = 42
SHINGLE = 3
RADIUS = 3
STEP = 6                 # more top bits by which a key with too many variants is dealt again
CHUNK = 1 << 16          # shingles hashed at a time: bounds memory for very long texts


def simhash64(text: str, width: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one whole text."""
    words = text.encode("utf-8").lower().split()     # bytes: ASCII case and ASCII blanks only
    if not words:
        return 0
    if len(words) < width:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(width))))
    ones, total, digest = np.zeros(64, dtype=np.int64), 0, xxhash.xxh64_intdigest
    while hashes := [digest(g, SEED) for g in islice(grams, CHUNK)]:
        block = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, fp)``: fp is the fingerprint as signed bigint, one row per document."""

    def run(batches):
        for b in batches:
            fps = np.array([simhash64(t) for t in b.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(fps)],
                                             names=["doc_id", "text_key", "fp"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("text_key"),
                       text_or_empty(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, text_key bigint, fp bigint")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the links a-b, by hooking and pointer jumping."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _variants(fps: np.ndarray, keys: np.ndarray, prefix: int):
    """All variants of ``fps`` whose top ``prefix`` bits are ``keys``: (variant, index, flips)."""
    low = 64 - prefix
    odd = (_popcount(fps) & 1).astype(bool)
    moved = (keys << np.uint64(low)) | (fps & np.uint64((1 << low) - 1))
    away = _popcount(moved ^ fps)
    ones = [1 << i for i in range(low)]
    twos = [(1 << i) | (1 << j) for i in range(low) for j in range(i) if i // 32 == j // 32]
    highs = [1 << i for i in range(32, low)]         # partners of a flipped top bit, in its half
    lows = [1 << i for i in range(low)] if low < 32 else []
    upper = (moved ^ fps) >> np.uint64(32) != 0
    out = [(moved, np.arange(fps.size), away)]
    for at, masks, flips in ((away == 0, ones, 1), ((away == 0) & odd, twos, 2), ((away == 1) & odd & upper, highs, 2),
                             ((away == 1) & odd & ~upper, lows, 2)):
        idx, m = np.flatnonzero(at), np.array(masks, dtype=np.uint64)
        out.append(((moved[idx, None] ^ m[None, :]).ravel(), np.repeat(idx, m.size), np.full(idx.size * m.size, flips)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _stars(fps: np.ndarray, keys: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of one block of keys, as two index arrays."""
    variant, idx, flips = _variants(fps, keys, prefix)
    order = np.argsort(flips, kind="stable")
    order = order[np.argsort(variant[order], kind="stable")]
    variant, idx, flips = variant[order], idx[order], flips[order]
    first = np.flatnonzero(np.r_[True, variant[1:] != variant[:-1]]) if variant.size else np.zeros(0, dtype=np.int64)
    centre = np.repeat(first, np.diff(np.r_[first, variant.size]))
    a, c = idx, idx[centre]
    ok = (flips[centre] <= 1) & (a != c) & (_popcount(fps[a] ^ fps[c]) <= RADIUS)
    return a[ok], c[ok]


def _away(prefix: int):
    return F.bit_count(F.shiftrightunsigned("fp", 64 - prefix).bitwiseXOR(F.col("key")))


def _deal(rows: DataFrame, prefix: int, more: int) -> DataFrame:
    """Rows ``(fp, key)`` by ``prefix`` top bits (NULL keys by none), dealt to the keys of ``more`` bits that their variants can have."""
    one = [1 << i for i in range(more)]
    at = 64 - prefix - more
    two = [(1 << i) | (1 << j) for i in range(more) for j in range(i) if (i + at) // 32 == (j + at) // 32]
    lists = [F.array(*[F.lit(m).cast("bigint") for m in masks]) for masks in ([0], one, two)]
    flips = _away(prefix) if prefix else F.lit(0)
    odd = F.bit_count("fp") % 2 == 1
    masks = (F.when((flips == 0) & odd, F.concat(*lists) if two else F.concat(*lists[:2]))
             .when((flips == 0) | ((flips == 1) & odd), F.concat(*lists[:2])).otherwise(lists[0]))
    bits = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << more) - 1).cast("bigint"))
    return rows.select("fp", "key", F.explode(masks).alias("mask")).select(
        "fp", F.shiftleft(F.coalesce("key", F.lit(0).cast("bigint")), more).bitwiseOR(bits.bitwiseXOR(F.col("mask"))).alias("key"))


def dealt_levels(distinct_fps: DataFrame, prefix: int, max_variants: int):
    """Every fingerprint with the keys of its variants, as (top bits, rows ``fp, key``): no key has more than ``max_variants``."""
    rows = _deal(distinct_fps.select("fp", F.lit(None).cast("bigint").alias("key")), 0, prefix)
    while True:
        low = 64 - prefix
        if not low:                                   # whole variants: at most all within distance 2 of one
            yield prefix, rows
            return
        cost = F.when(_away(prefix) == 0, 1 + low + low * low // 4).otherwise(33)
        hot = materialise(rows.groupBy("key").agg(F.sum(cost).alias("n")).where(F.col("n") > max_variants).select("key"), "simhash-hot")
        if hot.isEmpty():
            yield prefix, rows
            return
        yield prefix, rows.join(F.broadcast(hot), "key", "left_anti").select("fp", "key")
        again = materialise(rows.join(F.broadcast(hot), "key", "left_semi").select("fp", "key"), "simhash-again")
        more = min(STEP, low)
        rows = _deal(again, prefix, more)
        prefix += more


def links(distinct_fps: DataFrame, prefix: int, max_variants: int = 2_000_000) -> DataFrame:
    """Forest edges ``(u, v)`` whose components are those of all links within RADIUS bits."""
    return reduce(DataFrame.unionByName, [_links_by(rows, bits, max_variants) for bits, rows in dealt_levels(distinct_fps, prefix, max_variants)])


def _links_by(dealt: DataFrame, prefix: int, max_variants: int) -> DataFrame:
    """Forest edges of rows dealt by ``prefix`` top bits."""

    def run(batches):
        got = [(b.column("fp").to_numpy().view(np.uint64), b.column("key").to_numpy().astype(np.uint64)) for b in batches]
        if not got:
            return
        fps, keys = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(keys, kind="stable")
        fps, keys = fps[order], keys[order]
        low = 64 - prefix
        own = (fps >> np.uint64(low)) == keys
        cost = np.r_[0, np.cumsum(np.where(own, 1 + low + low * low // 4, 33))]
        bounds = np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), keys.size]
        spent = cost[bounds]
        nodes, index = np.unique(fps, return_inverse=True)
        a_all, b_all, at = [], [], 0
        while at < bounds.size - 1:                  # whole keys only, as many as fit a block
            nxt = max(at + 1, int(np.searchsorted(spent, spent[at] + max_variants, side="right")) - 1)
            begin, end = bounds[at], bounds[nxt]
            a, b = _stars(fps[begin:end], keys[begin:end], prefix)
            a_all.append(index[begin:end][a])
            b_all.append(index[begin:end][b])
            at = nxt
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        root = _roots(nodes.size, a, b)
        moved = np.flatnonzero(root != np.arange(nodes.size))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved].view(np.int64)), pa.array(nodes[root[moved]].view(np.int64))],
                                         names=["u", "v"])

    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "key").mapInArrow(run, "u bigint, v bigint")


def _prefix_bits(n: int, target: int = 500) -> int:
    """Top bits that deal n fingerprints to keys of about ``target``: sizes tasks, changes no result."""
    return min(28, max(4, math.ceil(math.log2(max(n, 1) / target + 1))))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, fp, root, component_id)`` with one row per document row."""
    marked = materialise(fingerprints(docs, id_col, text_col), "simhash")
    by_fp = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    forest = links(by_fp.select("fp"), _prefix_bits(by_fp.count()))
    roots = connected_components(forest)
    linked = by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = linked.join(least, "root").select("fp", "root", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable)."""
    return components(docs, id_col, text_col).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with one row of each component: that of the smallest id (of equal ids, one text)."""
    rows = components(docs, id_col, text_col).groupBy("doc_id", "text_key", "root", "component_id").agg(F.count("*").alias("n_rows"))
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    chosen = rows.where(first).groupBy("root").agg(F.min("text_key").alias("stays"))
    verdict = rows.join(chosen, "root").select(
        "doc_id", "text_key", "n_rows", (first & (F.col("text_key") == F.col("stays"))).alias("kept"))
    return keep_one_row_each(docs, materialise(verdict, "simhash-verdict"), id_col, text_col)
