"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of ASCII letters and digits (lower-cased) and non-ASCII
characters.  A window is 10 consecutive words of an item, or the whole item if
it has fewer (but not none).  Tasks scan the word windows of whole documents
against the set, verify every hash hit word by word and mark the words inside.

The set is built from blocks of items of at most ``max_windows`` windows, so
each broadcast has a known bound; a larger benchmark is scanned block after
block and the marks of a document are united, with the same result.

Defined results: a NULL or wordless text has no words and no hits; a NULL or
wordless item has no window; a NULL item id reads as an empty id; repeated
items count once; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.llm.common import free_name, materialise
from citylens.llm.tokens import scan, window_hashes, words

WINDOW = 10


class WindowSet:
    """Windows of some items by length: sorted hashes, their words and their items."""

    def __init__(self, items: list[tuple[str, str]], width: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            size = min(width, len(ids))
            for i in range(len(ids) - size + 1) if size else ():
                by_length.setdefault(size, {}).setdefault(tuple(ids[i:i + size]), set()).add(item_id)
        self.width = width
        self.lengths = {}
        for size, found in by_length.items():
            grams = np.array(list(found), dtype=np.int64).reshape(-1, size)
            hashes = np.array([window_hashes(g, size)[1][0] for g in grams], dtype=np.uint64)
            order = np.argsort(hashes, kind="stable")
            owners = list(found.values())
            self.lengths[size] = (hashes[order], grams[order], [sorted(owners[i]) for i in order])

    def find(self, ids: np.ndarray):
        """Verified occurrences: (window length, start position, the window's items)."""
        for size, (hashes, grams, owners) in self.lengths.items():
            at, h = window_hashes(ids, size)
            left, right = np.searchsorted(hashes, h, side="left"), np.searchsorted(hashes, h, side="right")
            for k in np.flatnonzero(right > left):
                window = ids[at[k]:at[k] + size]
                for row in range(left[k], right[k]):
                    if np.array_equal(grams[row], window):
                        yield size, int(at[k]), owners[row]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, max_windows: int):
    """The items in blocks of about ``max_windows`` words each, one block on the driver at a time."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")
                             ).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = max(1, math.ceil(size / 4 / max_windows))        # four bytes a word or more, at a guess
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for i in range(n):
        yield [(r["item"], r["text"]) for r in items.where(block == i).distinct().collect()]


def _scan_block(marked: DataFrame, grams, kind: str) -> DataFrame:
    """Unite each row's word intervals and items with those of one block."""

    def run(batches):
        known = grams.value
        for b in batches:
            texts = b.column("text").to_pylist()
            spans = [list(map(tuple, zip(s[::2], s[1::2]))) for s in b.column("spans").to_pylist()]
            items = [set(x) for x in b.column("items").to_pylist()]
            n_words = np.zeros(len(texts), dtype=np.int64)
            for first, counts, ids in scan(texts, known.vocabulary, known.width):
                n_words[first:first + counts.size] = counts
                begin = np.r_[0, np.cumsum(counts + known.width)][:-1]
                for size, at, owners in known.find(ids):
                    doc = int(np.searchsorted(begin, at, side="right")) - 1
                    spans[first + doc].append((at - int(begin[doc]), at - int(begin[doc]) + size))
                    items[first + doc].update(owners)
            flat = [[x for s in _united(v) for x in s] for v in spans]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text"), pa.array(n_words), pa.array(flat, pa.list_(pa.int32())),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=["doc_id", "text", "n_words", "spans", "items"])

    return marked.mapInArrow(run, f"doc_id {kind}, text string, n_words bigint, spans array<int>, items array<string>")


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", max_windows: int = 250_000) -> DataFrame:
    """Per document row: ``doc_id, text, n_words, spans, items`` (word intervals as flat start, end pairs)."""
    spark = docs.sparkSession
    state = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(0).cast("bigint").alias("n_words"),
                        F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    kind = state.schema["doc_id"].dataType.simpleString()
    for i, items in enumerate(_blocks(benchmark, item_id_col, item_text_col, max_windows)):
        grams = spark.sparkContext.broadcast(WindowSet(items))
        state = _scan_block(materialise(state, "decontaminate") if i else state, grams, kind)
    return state




def contamination(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and the item ids."""
    return (_n_hit(hits(docs, benchmark, **names)).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")))


def _n_hit(found: DataFrame) -> DataFrame:
    """Intervals are disjoint: ends minus starts."""
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return found.withColumn("n_hit", F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """Documents without any hit, all columns kept: a filter on the scan, nothing is joined or moved."""
    return _filter(docs, benchmark, id_col, text_col, remove_spans=False, **names)


def remove_contaminated_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """All documents, their hit words (and what stands between them) cut from the text."""
    return _filter(docs, benchmark, id_col, text_col, remove_spans=True, **names)


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return "".join([*out, text[last:]])


def _filter(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, remove_spans: bool,
            item_id_col: str = "item_id", item_text_col: str = "text", max_windows: int = 250_000) -> DataFrame:
    spark, cols, at = docs.sparkSession, docs.columns, docs.columns.index(text_col)
    carried = docs.withColumn(free_name(docs, "spans"), F.array().cast("array<int>")) if remove_spans else docs
    for i, items in enumerate(_blocks(benchmark, item_id_col, item_text_col, max_windows)):
        grams = spark.sparkContext.broadcast(WindowSet(items))
        carried = materialise(carried, "decontaminate") if i else carried
        carried = carried.mapInArrow(_marker(grams, at, remove_spans), carried.schema)
    if not remove_spans:
        return carried

    def cut(batches):
        for b in batches:
            spans = [list(zip(s[::2], s[1::2])) for s in b.column(len(cols)).to_pylist()]
            texts = [_cut(t, s) if s else t for t, s in zip(b.column(at).to_pylist(), spans)]
            kind = b.schema.field(at)
            yield b.set_column(at, kind, pa.array(texts, kind.type)).select(list(range(len(cols))))

    return carried.mapInArrow(cut, docs.schema)


def _marker(grams, at: int, remember: bool):
    """Map of batches: rows with a hit go, or get their word intervals into the last column."""

    def run(batches):
        known = grams.value
        for b in batches:
            texts = b.column(at).to_pylist()
            spans: list[list[tuple[int, int]]] = [[] for _ in texts]
            for first, counts, ids in scan(texts, known.vocabulary, known.width):
                begin = np.r_[0, np.cumsum(counts + known.width)][:-1]
                for size, pos, _ in known.find(ids):
                    doc = int(np.searchsorted(begin, pos, side="right")) - 1
                    spans[first + doc].append((pos - int(begin[doc]), pos - int(begin[doc]) + size))
            if not remember:
                yield b.filter(pa.array([not s for s in spans], pa.bool_()))
                continue
            before = b.column(b.num_columns - 1).to_pylist()
            flat = [[x for s in _united(list(zip(o[::2], o[1::2])) + n) for x in s] for o, n in zip(before, spans)]
            yield b.set_column(b.num_columns - 1, b.schema.field(b.num_columns - 1), pa.array(flat, pa.list_(pa.int32())))

    return run
