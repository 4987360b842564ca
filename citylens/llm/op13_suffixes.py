"""Suffix-array dedup: common-prefix-aware distributed merge sort of suffix runs.

A byte of a text goes if a string of ``LENGTH`` bytes covers it that also
starts in a document with a smaller id.

Suffixes.  A window is a string of ``LENGTH`` bytes.  Its anchor is the place of
its smallest ``GRAM``-byte hash (leftmost), so equal windows have their anchor
at the same distance.  Consecutive windows of one anchor form a *stretch*; only
the suffix at the anchor is sorted for a stretch (a sparse suffix array, about
one place in 14).  Two equal windows therefore lie in two stretches whose
suffixes share at least ``GRAM`` bytes.

Method.
1. Texts are packed into blocks of ``block_bytes`` and written once.
2. Anchor hashes that occur in one document only cannot be part of a link: the
   blocks' sorted hashes meet by hash range, and every block gets back the
   hashes that it shares with other documents.
3. Every block sorts the suffixes at its shared anchors, keeps one of equal
   ones (with the smallest id) and writes them as a run, front-coded: the
   length of the prefix shared with the suffix before, and the rest.  Runs are
   cut at common splitters and exchanged.
4. A task merges the runs of one range with a loser tree that carries the
   common prefix with the last winner: a contender with the longer one wins
   without a look at the text, equal ones are compared from there on.  Suffixes
   that share ``GRAM`` bytes leave the tree together; in this group the windows
   of every suffix are held against those of smaller ids.
5. The answers (a bit per window) go back to the blocks, which cut the texts.

Scale.  Texts are written once, compressed, and travel compressed when blocks
meet their answers.  A run has a suffix once, so copies - a third of all rows,
or a line in every document - meet at most once a block.  A gram with more
than ``hot`` different suffixes would make a large group: its windows are
sorted whole instead, as suffixes of their own, spread by all their bytes.
Splitters come from a sample of about ``16 x ranges`` suffixes (ranges are at
most 16,384); it steers the balance only.  Rows exchanged are blocks times ranges, so on large
clusters ``block_bytes`` grows with the executors' memory (a task holds about
12 bytes a byte of its block).

Defined results.  NULL text: empty.  Texts shorter than ``LENGTH``: kept.
Repeated rows and equal ids: a document is no source for its own id; a NULL id
comes after all others.  Empty table: no rows.  Very long texts: hashed in
pieces that overlap, none is cut.  Other columns of the input are
not read, so their names cannot clash.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.llm.common import materialise

# Bytes of a repeated string, bytes of an anchor (a multiple of 8).
LENGTH, GRAM = 50, 24
#: Most different suffixes of a gram that one group holds.
HOT = 20_000
BLOCK_BYTES = 8_000_000
MAX_RANGES = 16_384
#: Bytes of a block that the sample for the splitters looks at.
_PLACE = 60_000
_CHUNK = 1 << 16                                  # windows hashed at a time
_NO_ID = np.iinfo(np.int64).max
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LOW = np.uint64((1 << 17) - 1)

_BLOCKS = "block long, ids array<long>, sizes array<long>, data binary"
_GRAMS = "bucket int, block long, grams binary, kinds binary"
_SHARED = "block long, bucket int, grams binary, hot binary"
_RUNS = "range int, block long, run binary"
_ANSWERS = "block long, range int, n int, windows binary"
RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, "
          "spans array<struct<start:long,end:long>>, kept binary")


# ------------------------------------------------------------------ blocks
def _pack(block_bytes: int):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, nth, ids, texts, held = TaskContext.get().partitionId() << 32, 0, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                texts.append(text or b"")
                held += len(texts[-1])
                if held >= block_bytes:
                    yield _block_row(first | nth, ids, texts)
                    nth, ids, texts, held = nth + 1, [], [], 0
        if ids:
            yield _block_row(first | nth, ids, texts)
    return packed


def _block_row(block: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    data = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
         pa.array([data], pa.binary())], names=["block", "ids", "sizes", "data"])


def _unpacked(batch: pa.RecordBatch, row: int) -> tuple[int, list, np.ndarray, bytes]:
    """block, ids, starts of its texts (and the end), their bytes"""
    sizes = batch.column("sizes")[row].values.to_numpy()
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    data = pa.decompress(batch.column("data")[row].as_buffer(), decompressed_size=int(starts[-1]), codec="zstd", asbytes=True) if starts[-1] else b""
    return batch.column("block")[row].as_py(), batch.column("ids")[row].as_py(), starts, data


# ------------------------------------------------------------------ anchors and stretches
def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= _C[0]
    h ^= h >> np.uint64(32)
    h *= _C[1]
    h ^= h >> np.uint64(29)
    return h


def stretches(data: bytes, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The stretches of a block's texts: first window ``at``, number of windows ``n``, bytes before the
    anchor ``lead``, ``doc`` (number in the block), anchor hash ``h``, hash ``t`` of all the stretch's bytes."""
    found = []
    width = length - gram + 1
    for at in range(0, len(data) - length + 1, _CHUNK):
        piece = data[at:at + _CHUNK + length - 1]
        word = np.ndarray((len(piece) - 7,), "<u8", piece, strides=(1,)).copy()          # the 8 bytes at every place
        n_grams = len(piece) - gram + 1
        h = word[:n_grams] * _C[0]
        for k in range(8, gram, 8):
            h += word[k:k + n_grams] * _C[k // 8 % 3] ^ word[k:k + n_grams] >> np.uint64(23)
        h = _mixed(h)
        least = (h & ~_LOW) | np.arange(n_grams, dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[:span - width], least[width - span:])
        anchor = (least & _LOW).astype(np.int64)
        here = starts[np.searchsorted(starts, at):np.searchsorted(starts, at + len(anchor))] - at
        new = np.empty(len(anchor), bool)
        new[0] = True
        np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
        new[here] = True
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(anchor)) - 1
        doc = np.searchsorted(starts, first + at, "right") - 1
        last = np.minimum(last, starts[doc + 1] - length - at)                           # windows stay in their text
        keep = last >= first
        first, last, doc = first[keep], last[keep], doc[keep]
        t = np.zeros(len(first), np.uint64)
        for end in (first, last):                                                        # two windows cover the stretch
            for k in (*range(0, length - 7, 8), length - 8):
                t = (t ^ word[end + k]) * _C[1]
                t ^= t >> np.uint64(29)
        t += (last - first).astype(np.uint64) * _C[2]
        found.append((first + at, last - first + 1, anchor[first] - first, doc, h[anchor[first]], t))
    if not found:
        found = [(np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2]
    return dict(zip(("at", "n", "lead", "doc", "h", "t"), (np.concatenate(c) for c in zip(*found))))


# ------------------------------------------------------------------ grams that several documents share
def _grams_of(bits: int):
    """A block's distinct anchor hashes (``32 + bits`` bits) by hash range, as sorted 32-bit remainders; kinds:
    number of different stretches with the hash, times two, plus one if two of the block's documents have it."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, _, starts, data = _unpacked(batch, row)
                s = stretches(data, starts)
                h = s["h"] >> np.uint64(32 - bits)
                if not len(h):
                    continue
                order = np.argsort(h)
                h, t, doc = h[order], s["t"][order], s["doc"][order]
                at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                size = np.diff(np.append(at, len(h)))
                several = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
                count = np.ones(len(at), np.int64)
                more = np.flatnonzero(np.repeat(size > 1, size))                 # hashes that the block has more than once
                if len(more):
                    again = more[np.lexsort((t[more], h[more]))]
                    new = np.append(True, h[again][1:] != h[again][:-1])
                    other = (new | np.append(True, t[again][1:] != t[again][:-1])).astype(np.int64)
                    count[size > 1] = np.minimum(np.add.reduceat(other, np.flatnonzero(new)), 30_000)
                h, kind = h[at], (count * 2 + several).astype(np.uint16)
                cuts = np.searchsorted(h >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))
                used = np.flatnonzero(cuts[1:] > cuts[:-1])
                rest = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()),
                     pa.array([rest[cuts[b]:cuts[b + 1]].tobytes() for b in used], pa.binary()),
                     pa.array([kind[cuts[b]:cuts[b + 1]].tobytes() for b in used], pa.binary())], names=["bucket", "block", "grams", "kinds"])
    return grams


def _shared_grams(hot: int):
    def shared(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(g, np.uint32) for g in table["grams"].to_pylist()]
        gram, kind = np.concatenate(lists), np.concatenate([np.frombuffer(k, np.uint16) for k in table["kinds"].to_pylist()])
        of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(gram, kind="stable")
        at = np.flatnonzero(np.append(True, np.diff(gram[order]) != 0))
        size = np.diff(np.append(at, len(gram)))
        linked = (size > 1) | (np.maximum.reduceat(kind[order] & 1, at) > 0)
        heavy = np.add.reduceat((kind[order] >> 1).astype(np.int64), at) > hot
        keep, state = np.zeros(len(gram), bool), np.zeros(len(gram), np.uint8)
        keep[order], state[order] = np.repeat(linked, size), np.repeat(heavy, size)
        rows = [(b, gram[mine].tobytes(), state[mine].tobytes()) for i, b in enumerate(table["block"].to_pylist())
                if (mine := np.flatnonzero(keep & (of == i))).size] if keep.any() else []
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array([table["bucket"][0].as_py()] * len(rows), pa.int32()),
                         "grams": pa.array([r[1] for r in rows], pa.binary()), "hot": pa.array([r[2] for r in rows], pa.binary())})
    return shared


# ------------------------------------------------------------------ sorted runs
def _run(ids: list, starts: np.ndarray, data: bytes, shared: list, bits: int) -> dict:
    """A block's run: distinct stretches sorted by key, the smallest id of each, and the places behind it.

    The key of a stretch is the suffix at its anchor up to its last window's end, ``lead`` the bytes before;
    a window of a hot gram is a key of its own.  A first byte keeps the two kinds apart."""
    s = stretches(data, starts)
    if shared and len(s["h"]):
        known = np.concatenate([np.frombuffer(x["grams"], np.uint32).astype(np.uint64) | np.uint64(x["bucket"]) << np.uint64(32) for x in shared])
        heavy = np.concatenate([np.frombuffer(x["hot"], np.uint8) for x in shared])
        h = s["h"] >> np.uint64(32 - bits)
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        here = np.flatnonzero(known[at] == h)
        heavy = heavy[at[here]]
    else:
        here, heavy = np.zeros(0, np.int64), np.zeros(0, np.uint8)
    docs = np.array([_NO_ID if i is None else i for i in ids], np.int64)
    at, n, lead, doc, t = (s[c][here] for c in ("at", "n", "lead", "doc", "t"))
    dense = np.flatnonzero(heavy)
    if len(dense):                                                    # every window of a hot gram stands for itself
        rest, times = np.flatnonzero(heavy == 0), n[dense]
        each = np.repeat(at[dense], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        window = np.ones(len(each), np.int64)
        at, n, lead = np.append(at[rest], each), np.append(n[rest], window), np.append(lead[rest], window * 0)
        doc, t = np.append(doc[rest], np.repeat(doc[dense], times)), np.append(t[rest], _window_hash(data, each))
        kind = np.append(np.zeros(len(rest), np.uint8), np.ones(len(each), np.uint8))
    else:
        kind = np.zeros(len(at), np.uint8)
    of, first = _distinct(data, at, n, t)
    keys = [b"\1" + data[a:b] if k else b"\0" + data[a:b] for k, a, b in
            zip(kind[first].tolist(), (at + lead)[first].tolist(), (at + n)[first] + LENGTH - 1)]
    order = sorted(range(len(keys)), key=keys.__getitem__)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    of, first = rank[of], first[order]
    least = np.full(len(keys), _NO_ID)
    doc = docs[doc]
    np.minimum.at(least, of, doc)
    leads = [data[a:b] for a, b in zip(at[first].tolist(), (at + lead)[first].tolist())]
    return {"keys": [keys[i] for i in order], "leads": leads, "least": least, "of": of, "at": at, "n": n, "doc": doc}


def _window_hash(data: bytes, at: np.ndarray) -> np.ndarray:
    t = np.zeros(len(at), np.uint64)
    word = np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))
    for k in (*range(0, LENGTH - 7, 8), LENGTH - 8):
        t = (t ^ word[at + k]) * _C[1]
        t ^= t >> np.uint64(29)
    return t


def _distinct(data: bytes, at: np.ndarray, n: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the distinct stretch, a place of each): grouped by hash, equal only if all bytes are."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(t, kind="stable")
    new = np.append(True, (t[order][1:] != t[order][:-1]) | (n[order][1:] != n[order][:-1]))
    group = np.cumsum(new) - 1
    first = order[np.flatnonzero(new)]
    like = first[group]
    word = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    same = np.ones(len(order), bool)
    for end in (0, n[order] - 1):                                     # two windows cover a stretch
        for k in (*range(0, LENGTH - 7, 8), LENGTH - 8):
            same &= word[at[order] + end + k] == word[at[like] + end + k]
    other = np.flatnonzero(~same)
    group[other] = len(first) + np.arange(len(other))
    of = np.empty(len(at), np.int64)
    of[order] = group
    return of, np.append(first, order[other])


def _common(keys: list[bytes]) -> np.ndarray:
    """Length of the prefix that a key shares with the one before."""
    size = np.array([len(k) for k in keys], np.int64)
    widest = int(size.max())
    padded = np.frombuffer(b"".join([k.ljust(widest, b"\0") for k in keys]), np.uint8).reshape(len(keys), widest)
    differ = padded[1:] != padded[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), widest)
    return np.append(0, np.minimum(common, np.minimum(size[1:], size[:-1])))


def _front_coded(keys: list[bytes], leads: list[bytes], least: np.ndarray) -> bytes:
    """Length of the prefix shared with the key before, the rest of the key, the lead, the smallest id."""
    common = _common(keys).astype(np.uint16)
    rest = b"".join([k[c:] for k, c in zip(keys, common.tolist())])
    raw = b"".join([common.tobytes(), np.array([len(k) for k in keys], np.uint16).tobytes(), np.array([len(x) for x in leads], np.uint16).tobytes(),
                    least.tobytes(), rest, *leads])
    return len(keys).to_bytes(4, "little") + len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


class Run:
    """A front-coded run as it comes: keys, the prefix shared with the key before, leads, smallest ids."""

    def __init__(self, packed: bytes):
        n, size = (int.from_bytes(packed[i:i + 4], "little") for i in (0, 4))
        raw = pa.decompress(packed[8:], decompressed_size=size, codec="zstd", asbytes=True)
        self.common, lengths, leads = (np.frombuffer(raw, np.uint16, n, 2 * n * i).tolist() for i in range(3))
        self.least = np.frombuffer(raw, np.int64, n, 6 * n).tolist()
        self.keys, self.leads, at, key = [], [], 14 * n, b""
        for common, length in zip(self.common, lengths):
            key = key[:common] + raw[at:at + length - common]
            at += length - common
            self.keys.append(key)
        for length in leads:
            self.leads.append(raw[at:at + length])
            at += length


def _runs_of(bits: int, splitters: list[bytes]):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, ids, starts, data = _unpacked(batch, row)
                run = _run(ids, starts, data, batch.column("shared")[row].as_py(), bits)
                keys = run["keys"]
                cuts = [0, *(bisect.bisect_left(keys, s) for s in splitters), len(keys)]
                used = [i for i in range(len(cuts) - 1) if cuts[i + 1] > cuts[i]]
                for at in range(0, len(used), 256):
                    some = used[at:at + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()),
                         pa.array([_front_coded(*(run[c][cuts[i]:cuts[i + 1]] for c in ("keys", "leads", "least"))) for i in some], pa.binary())],
                        names=["range", "block", "run"])
    return runs


# ------------------------------------------------------------------ merge
def merged(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """All keys of the runs in order as (run, place in it, prefix shared with the key before).

    A loser tree: an inner node holds the loser of its match and the prefix
    it shares with the winner.  Of two contenders that both follow the last
    winner, the one that shares more with it is smaller; where they share
    equally much, the comparison starts behind that prefix.
    """
    size = 1 << max(0, len(runs) - 1).bit_length()
    key: list[bytes | None] = [r.keys[0] if r.keys else None for r in runs] + [None] * (size - len(runs))
    common, place, loser = [0] * size, [0] * size, [0] * size

    def match(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix is then the one shared with the winner"""
        x, y = key[a], key[b]
        if y is None or x is None:
            return (a, b) if y is None else (b, a)
        p = common[a]
        if p != common[b]:
            return (a, b) if p > common[b] else (b, a)
        if x[p:] == y[p:]:
            common[b] = len(x)
            return a, b
        least = min(len(x), len(y))
        while p < least and x[p] == y[p]:
            p += 1
        if p == len(x) or p < len(y) and x[p] < y[p]:
            common[b] = p
            return a, b
        common[a] = p
        return b, a

    winners = list(range(size))
    node = size
    while len(winners) > 1:
        node //= 2
        pairs = [match(winners[2 * i], winners[2 * i + 1]) for i in range(node)]
        loser[node:2 * node] = [b for _, b in pairs]
        winners = [a for a, _ in pairs]
    best = winners[0]
    while key[best] is not None:
        at = place[best]
        yield best, at, common[best]
        run = runs[best]
        place[best] = at = at + 1
        if at < len(run.keys):
            key[best], common[best] = run.keys[at], run.common[at]
        else:
            key[best] = None
        node = (size + best) // 2
        while node:
            best, loser[node] = match(best, loser[node])
            node //= 2


def windows_of_smaller(group: list[tuple[int, bytes, bytes]], length: int = LENGTH) -> list[int]:
    """For the (smallest id, key, lead) of suffixes that share a gram: a bit per window, set if a smaller id has it."""
    whole: dict[bytes, int] = {}                  # smallest id of a whole stretch
    texts = [lead + key[1:] for _, key, lead in group]
    for text, (doc, _, _) in zip(texts, group):
        whole[text] = min(doc, whole.get(text, doc))
    bits = dict.fromkeys(whole, 0)
    if len(whole) > 1:
        seen: dict[bytes, int] = {}               # smallest id of a window
        for text, doc in sorted(whole.items(), key=lambda x: x[1]):
            for w in range(len(text) - length + 1):
                if seen.setdefault(text[w:w + length], doc) < doc:
                    bits[text] |= 1 << w
    return [bits[text] if doc == whole[text] else (1 << len(text) - length + 1) - 1 for text, (doc, _, _) in zip(texts, group)]


def _merge(table: pa.Table) -> pa.Table:
    runs = [Run(r) for r in table["run"].to_pylist()]
    answers = [np.zeros(len(r.keys), np.uint64) for r in runs]

    def settle(group: list[tuple[int, int]]) -> None:
        if len(group) > 1:
            for (r, at), bits in zip(group, windows_of_smaller([(runs[r].least[at], runs[r].keys[at], runs[r].leads[at]) for r, at in group])):
                if bits:
                    answers[r][at] = bits

    group: list[tuple[int, int]] = []
    for r, at, common in merged(runs):
        if common <= (LENGTH if runs[r].keys[at][0] else GRAM):
            settle(group)
            group = []
        group.append((r, at))
    settle(group)
    return pa.table({"block": table["block"], "range": table["range"], "n": pa.array([len(a) for a in answers], pa.int32()),
                     "windows": pa.array([pa.compress(a.tobytes(), codec="zstd", asbytes=True) for a in answers], pa.binary())})


# ------------------------------------------------------------------ cutting the texts
def _cut(bits: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, ids, starts, data = _unpacked(batch, row)
                run = _run(ids, starts, data, batch.column("shared")[row].as_py(), bits)
                gone = _removed(run, batch.column("answers")[row].as_py() or [], len(data))
                yield from _rows(ids, starts, data, gone)
    return cut


def _removed(run: dict, answers: list, size: int) -> np.ndarray:
    """True for every byte that goes."""
    gone = np.zeros(size + 1, np.int32)
    if not run["keys"]:
        return gone[:-1] > 0
    raw = [pa.decompress(a["windows"], decompressed_size=8 * a["n"], codec="zstd", asbytes=True) for a in answers]
    bits = np.frombuffer(b"".join(raw), np.uint64)
    of, at, count = run["of"], run["at"], run["n"]
    every = (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)
    told = np.where(run["doc"] > run["least"][of], every, bits[of])         # all windows, if the block has a smaller id
    whole = told == every
    np.add.at(gone, at[whole], 1)
    np.add.at(gone, (at + count)[whole] + LENGTH - 1, -1)
    some = np.flatnonzero(~whole & (told != 0))
    for w in range(int(count[some].max()) if len(some) else 0):
        hit = at[some[told[some] >> np.uint64(w) & np.uint64(1) == 1]] + w
        np.add.at(gone, hit, 1)
        np.add.at(gone, hit + LENGTH, -1)
    return np.cumsum(gone[:-1], dtype=np.int32) > 0


def _rows(ids: list, starts: np.ndarray, data: bytes, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
    raw = np.frombuffer(data, np.uint8)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
    rows, held = [], 0
    for doc_id, a, b in zip(ids, starts[:-1].tolist(), starts[1:].tolist()):
        here = gone[a:b]
        removed = int(here.sum())
        spans, kept = [], data[a:b]
        if removed:
            edge = np.flatnonzero(np.diff(np.concatenate([[False], here, [False]]).view(np.int8)))
            spans = [{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())]
            kept = raw[a:b][~here].tobytes()
        rows.append({"doc_id": doc_id, "n_bytes": b - a, "n_removed": removed, "n_spans": len(spans), "spans": spans, "kept": kept})
        held += len(kept)
        if held > 4_000_000 or len(rows) >= 5_000:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


# ------------------------------------------------------------------ operator
def _sample(share: float):
    """A share, by hash, of the stretches of one place in every block, for the splitters."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, _, starts, data = _unpacked(batch, row)
                at = int(_mixed(np.array([block], np.uint64))[0] % np.uint64(max(1, len(data) - _PLACE)))
                some = data[at:at + _PLACE]
                s = stretches(some, np.array([0, len(some)]))
                mine = np.flatnonzero(_mixed(s["t"].copy()) / 2.0 ** 64 < share)
                first, lead = s["at"][mine].tolist(), s["lead"][mine].tolist()
                yield pa.RecordBatch.from_arrays([pa.array([some[p + x:p + x + GRAM] for p, x in zip(first, lead)], pa.binary()),
                                                  pa.array([some[p:p + LENGTH] for p in first], pa.binary())], names=["suffix", "window"])
    return sample


def _splitters(blocks: DataFrame, n_blocks: int, ranges: int) -> list[bytes]:
    """Bounds of the ranges: most for suffixes at anchors, one in eight for windows of hot grams."""
    share = 16 * ranges / (max(1, n_blocks) * _PLACE / 16)               # about 16 sampled suffixes a range
    sample = blocks.mapInArrow(_sample(share), "suffix binary, window binary").collect()
    bounds = set()
    for kind, column, n in ((b"\x00", "suffix", ranges), (b"\x01", "window", max(1, ranges // 8))):
        keys = sorted(kind + bytes(r[column]) for r in sample)
        bounds |= {keys[len(keys) * i // n] for i in range(1, n)} if keys else set()
    return sorted(bounds | {b"\x01"})


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: bytes, removed bytes, maximal removed spans and the bytes that are kept."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    blocks = materialise(texts.mapInArrow(_pack(block_bytes), _BLOCKS), "suffix-blocks")
    n_blocks, n_bytes = blocks.agg(F.count("*"), F.coalesce(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")), F.lit(0))).first()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_RANGES, max(2 * partitions, n_bytes // 16_000_000))
    bits = min(24, math.ceil(math.log2(max(2 * partitions, n_bytes // 16_000_000))))

    grams = blocks.mapInArrow(_grams_of(bits), _GRAMS)
    shared = materialise(grams.groupBy("bucket").applyInArrow(_shared_grams(hot), _SHARED), "suffix-shared")
    of_block = shared.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "grams", "hot"))).alias("shared"))
    known = blocks.join(of_block, "block", "left")
    runs = known.mapInArrow(_runs_of(bits, _splitters(blocks, n_blocks, ranges)), _RUNS)
    answers = runs.groupBy("range").applyInArrow(_merge, _ANSWERS)
    told = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("range", "n", "windows"))).alias("answers"))
    return known.join(told, "block", "left").mapInArrow(_cut(bits), RESULT)
