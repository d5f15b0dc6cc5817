"""Word-shingle sets of a batch of texts as numpy arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from quarry.llm.pretokens import span_hashes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

_A, _B = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def mixed(x: np.ndarray, by: np.uint64 = _A) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * by
    return x ^ (x >> np.uint64(29))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased, and the word's row. Words are runs of
    bytes other than space and the five control characters next to tab."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
    rows = np.searchsorted(offsets, begins, side="right") - 1
    return span_hashes(_LOWER[data], begins, ends), rows


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows, sorted by row and hash, and the rows' bounds
    in them. A row with fewer words than ``size`` has one shingle of all its words."""
    n = len(offsets) - 1
    words, rows = word_hashes(data, offsets)
    counts = np.bincount(rows, minlength=n)
    first = np.cumsum(counts) - counts
    starts = np.maximum(counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(n), starts)
    at = np.repeat(first - (np.cumsum(starts) - starts), starts) + np.arange(starts.sum())
    length = np.minimum(counts[owner], size)
    value = np.zeros(len(at), np.uint64)
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    for k in range(size):
        value = mixed(value * _B + np.where(k < length, padded[at + k], np.uint64(0)))
    value = mixed(value + length.astype(np.uint64), _B)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))
