"""Words and hashes of whole Arrow batches of texts, without a Python loop over words.

A word is a run of bytes other than space and the control characters 9 to 13. Hashes are
polynomials over the lower-cased (A-Z) bytes, mixed to 64 bits; equal words have equal
hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
SEGMENT_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

_POWERS: dict[str, np.ndarray] = {}


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `most` bytes: first and last row, bytes, offsets.

    A longer text comes alone, whole.
    """
    if not len(column):
        return
    data, offsets = text_buffers(column)
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), len(offsets) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of its text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = np.ones(len(data) + 1, dtype=bool)
    inside[:-1] = (data != 32) & ((data < 9) | (data > 13))
    inside[-1] = False
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-2]
    starts = np.flatnonzero(inside[:-1] & (~before | cut[:-1]))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SEGMENT_BYTES + 1)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, step in (("up", BASE), ("down", inverse)):
            each = np.full(size, step, dtype=np.uint64)
            each[0] = 1
            _POWERS[name] = np.cumprod(each)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased."""
    out = np.empty(len(starts), dtype=np.uint64)
    low = 0
    while low < len(starts):
        first = starts[low]
        high = max(int(np.searchsorted(ends, first + SEGMENT_BYTES, side="right")), low + 1)
        part = data[first : ends[high - 1]]
        part = np.where((part >= 65) & (part <= 90), part + np.uint8(32), part).astype(np.uint64)
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part + np.uint64(1)) * up[: len(part)], out=sums[1:])
        s, e = starts[low:high] - first, ends[low:high] - first
        out[low:high] = (sums[e] - sums[s]) * down[s]
        low = high
    return mixed(out)


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of words of each text."""
    return np.bincount(word_bounds(data, offsets)[2], minlength=len(offsets) - 1)


def shingles(words: np.ndarray, owner: np.ndarray, texts: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of `length` words in a row, and their offsets per text, ascending within a text.

    A text with fewer words has its whole sequence as its one shingle; one without words
    has none.
    """
    counts = np.bincount(owner, minlength=texts)
    first = np.concatenate([[0], np.cumsum(counts)])
    whole = np.zeros(len(words), dtype=np.uint64)
    for k in range(length):
        moved = words[k:]
        rolled = np.zeros(len(words), dtype=np.uint64)
        rolled[: len(moved)] = mixed(moved + np.uint64(k + 1))
        whole = whole * BASE + rolled
    last = first[1:][owner] if len(owner) else owner
    full = np.arange(len(words)) + length <= last
    hashes, texts_of = mixed(whole[full]), owner[full]
    short = np.flatnonzero((counts > 0) & (counts < length))
    if len(short):
        lone = np.zeros(len(short), dtype=np.uint64)
        for k in range(length - 1):
            there = counts[short] > k
            at = np.minimum(first[short] + k, len(words) - 1)
            lone = np.where(there, mixed(lone * BASE + words[at] + np.uint64(k + 1)), lone)
        hashes, texts_of = np.concatenate([hashes, lone]), np.concatenate([texts_of, short])
    order = np.lexsort((hashes, texts_of))
    hashes, texts_of = hashes[order], texts_of[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (texts_of[1:] != texts_of[:-1])
    hashes, texts_of = hashes[fresh], texts_of[fresh]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(texts_of, minlength=texts))])
