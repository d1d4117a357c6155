"""Words and word shingles of whole text columns as numpy arrays, for use inside Arrow tasks.

Words are runs of bytes other than space and U+0009 to U+000D, compared with A-Z in lower case. A word's hash is a
polynomial over its bytes, mixed; a shingle's hash combines the hashes of its words in order. All hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, last row (exclusive), their bytes, and their offsets in them."""
    whole = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = whole.buffers()
    ends = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(whole):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
        yield first, last, bytes_[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _power(direction: str, n: int) -> np.ndarray:
    have = _powers[direction]
    if len(have) < n:
        factor = np.full(max(n, SLICE_BYTES + 1), _BASE if direction == "up" else _UNBASE, np.uint64)
        factor[0] = 1
        _powers[direction] = have = np.cumprod(factor, dtype=np.uint64)
    return have


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its row, the place of its first byte and of the byte behind it. In order."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    here, before, after = inside[1:-1], inside[:-2].copy(), inside[2:].copy()
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts], after[cuts - 1] = False, False
    starts, ends = np.flatnonzero(here & ~before), np.flatnonzero(here & ~after) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """A hash of each word, A-Z taken as a-z unless ``fold_case`` is false."""
    lower = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0)) if fold_case else data
    summed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * _power("up", len(data))[: len(data)], out=summed[1:])
    values = (summed[ends] - summed[starts]) * _power("down", len(data) + 1)[starts]
    return mix(values + (ends - starts).astype(np.uint64) * _STEP)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row as parallel arrays (row, hash), sorted by row and hash.

    A shingle has ``size`` words; a row with fewer words has them all as its only shingle, a row without words has none.
    """
    row, starts, ends = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    folded = np.full(max(0, len(row) - size + 1), size, np.uint64)
    for k in range(size):
        folded = folded * _STEP + hashes[k : k + len(folded)]
    whole = row[: len(folded)] == row[size - 1 :] if len(folded) else np.zeros(0, bool)
    out_row, out_hash = row[: len(folded)][whole], mix(folded[whole])
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        first = np.searchsorted(row, short)
        value, n = n_words[short].astype(np.uint64), n_words[short]
        for k in range(size - 1):
            more = k < n
            value[more] = value[more] * _STEP + hashes[first[more] + k]
        out_row, out_hash = np.concatenate([out_row, short]), np.concatenate([out_hash, mix(value)])
    order = np.lexsort((out_hash, out_row))
    out_row, out_hash = out_row[order], out_hash[order]
    new = np.ones(len(out_row), bool)
    new[1:] = (out_row[1:] != out_row[:-1]) | (out_hash[1:] != out_hash[:-1])
    return out_row[new], out_hash[new]
