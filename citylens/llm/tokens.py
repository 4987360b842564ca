"""Word scanning with numpy inside tasks: whole texts to word numbers of a small vocabulary.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all
non-ASCII characters; every other ASCII character separates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# A-Z to a-z, ASCII letters and digits and bytes of non-ASCII characters kept, the rest to a blank.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

SLICE_BYTES = 4 << 20    # text scanned at a time: bounds the word lists in memory


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_TO_WORDS).split() if text else []


def scan(texts: list[str | None], vocabulary: dict[bytes, int], gap: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of whole texts: (first text's index, word counts, word numbers).

    Unknown words are -1; ``gap`` times -1 after each text keeps windows inside it.
    """
    get, pad = vocabulary.get, [-1] * gap
    first, held, ids, counts = 0, 0, [], []
    for i, text in enumerate(texts):
        w = words(text)
        ids.extend(get(x, -1) for x in w)
        ids.extend(pad)
        counts.append(len(w))
        held += len(text) if text else 0
        if held >= SLICE_BYTES:
            yield first, np.array(counts), np.array(ids, dtype=np.int64)
            first, held, ids, counts = i + 1, 0, [], []
    if counts:
        yield first, np.array(counts), np.array(ids, dtype=np.int64)


def window_hashes(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose ``width`` words are all known, and the windows' 64-bit polynomial hashes."""
    if ids.size < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    unknown = np.r_[0, np.cumsum(ids < 0)]
    at = np.flatnonzero(unknown[width:] == unknown[:-width])
    known, h = (ids + 1).astype(np.uint64), np.zeros(at.size, dtype=np.uint64)
    for j in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + known[at + j]
        h ^= h >> np.uint64(29)
    return at, h
