"""Periodic runs of words by internal pattern matching.

A run is a maximal stretch of words with smallest period q and length at least
``max(MIN_WORDS, 3 q)``. Let b be the largest power of two up to q, but 8 at least:
such a run holds a whole aligned block of b words (its start a multiple of b) together
with the block's copy q words on, as b - 1 + b + q is at most the run's length. So it is
enough to ask, for every aligned block of every dyadic length, where the block occurs
again in the windows next to it.

Blocks are asked of a suffix array of each text: the positions whose first 8 words
occur again in the text are sorted by their first 8, 16, 32, ... words (equal prefixes
share a group, each group is an interval of the array; what has become single is not
sorted on), and a wavelet tree over the array answers range-successor queries: the first
place in an interval that is not before x. Occurrences of a block of b words that start
in a window of b words form one arithmetic progression (periodicity lemma), so its first
two and its last occurrence give them all: the candidate periods. Candidates are carried
to both sides by the groups' names, longest first, and what is long enough is compared
byte by byte at the end.

Texts are handled whole, in chunks of rows within one narrow pass; a text larger than
a chunk is a chunk of its own. A task holds about 100 bytes for each word of its
chunk, and 4 more for each dyadic length and word that recurs.

Defined results: a null or empty text has no words, no runs and an empty collapsed
text; words are runs of bytes other than space and the five control characters next to
tab; repeated rows, ids that are null and ties are rows like any other; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from quarry.llm.common import row_chunks, utf8_column
from quarry.llm.pretokens import span_hashes
from quarry.llm.shingles import mixed

MIN_WORDS, MIN_EXPONENT = 24, 3
BLOCK = 8
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_P, _Q = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and row of every word."""
    if not len(data):
        return (np.empty(0, np.int64),) * 3
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
    return begins, ends, np.searchsorted(offsets, begins, side="right") - 1


class WaveletTree:
    """Places 0..n-1 in the array's order, as one bit row for each binary digit."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.ones, self.zeros = [], []
        row = values.astype(np.int64)
        for k in reversed(range(self.bits)):
            bit = (row >> k) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(len(row) - int(bit.sum()))
            row = np.concatenate((row[bit == 0], row[bit == 1]))

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of array[lo:hi] are less than x."""
        x = np.clip(x, 0, (1 << self.bits) - 1)
        lo, hi, count = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        for k, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros):
            up = ((x >> k) & 1).astype(bool)
            lo1, hi1 = ones[lo], ones[hi]
            count += np.where(up, (hi - lo) - (hi1 - lo1), 0)
            lo, hi = np.where(up, zeros + lo1, lo - lo1), np.where(up, zeros + hi1, hi - hi1)
        return count

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th least value of array[lo:hi] (which has that many)."""
        lo, hi, n, found = lo.copy(), hi.copy(), n.copy(), np.zeros(len(lo), np.int64)
        for k, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros):
            lo1, hi1 = ones[lo], ones[hi]
            low = (hi - lo) - (hi1 - lo1)
            up = n >= low
            n = np.where(up, n - low, n)
            found |= up.astype(np.int64) << k
            lo, hi = np.where(up, zeros + lo1, lo - lo1), np.where(up, zeros + hi1, hi - hi1)
        return found

    def window(self, lo, hi, start, stop) -> tuple[np.ndarray, ...]:
        """Range successors: first, second and last value of array[lo:hi] in
        [start, stop), and how many there are (missing ones repeat the last)."""
        before, n = self.below(lo, hi, start), self.below(lo, hi, stop)
        n = n - before
        some = np.flatnonzero(n)
        lo, hi, before, n = lo[some], hi[some], before[some], n[some]
        first, last = self.nth(lo, hi, before), self.nth(lo, hi, before + n - 1)
        second = self.nth(lo, hi, before + np.minimum(1, n - 1))
        return some, first, second, last, n


class SuffixArray:
    """Recurring positions of all rows of a chunk in the order of what follows them.

    ``names[k]`` holds, for each recurring position, its group among those of equal
    first ``BLOCK << k`` words in its row (-1: it is alone there). A group's name is
    its first place in the array, so [name, name + size) is its interval.
    """

    def __init__(self, codes: np.ndarray, rows: np.ndarray):
        grams, span = codes, 1
        while span < BLOCK:
            grams = mixed(grams[:-span] * _P + grams[span:], _Q) if len(grams) > span else grams[:0]
            span *= 2
        at = np.arange(len(grams))
        inside = rows[at + BLOCK - 1] == rows[at] if len(at) else np.zeros(0, bool)
        at = at[inside]
        keys = mixed(grams[at] ^ (rows[at].astype(np.uint64) * _P), _Q)
        order = np.argsort(keys, kind="stable")
        fresh = np.ones(len(order), bool)
        fresh[1:] = keys[order][1:] != keys[order][:-1]
        group = np.cumsum(fresh) - 1
        kept = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        self.positions = np.sort(at[order[kept]])  # recurring positions
        self.place = np.full(len(codes) + 1, -1, np.int64)
        self.place[self.positions] = np.arange(len(self.positions))
        self.array = self.place[at[order[kept]]]  # of places
        self.names: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []  # of the group that begins at an array index
        live = np.arange(len(self.array))  # array indexes that are not alone
        starts = np.flatnonzero(fresh[kept])
        while len(live):
            heads = np.zeros(len(live), bool)
            heads[starts] = True
            group = np.cumsum(heads) - 1
            name = np.full(len(self.positions), -1, np.int64)
            name[self.array[live]] = live[starts][group]
            size = np.zeros(len(self.array) + 1, np.int64)
            size[live[starts]] = np.bincount(group)
            self.names.append(name)
            self.sizes.append(size)
            # Order each group by the name of what follows its block.
            span = BLOCK << (len(self.names) - 1)
            here = self.array[live]
            after = self._name_at(name, self.positions[here] + span)
            after = np.where(after < 0, -1 - here, after)  # what is alone is unlike all others
            order = np.lexsort((after, group))
            self.array[live] = here[order]
            after, group = after[order], group[order]
            heads = np.ones(len(live), bool)
            heads[1:] = (after[1:] != after[:-1]) | (group[1:] != group[:-1])
            parts = np.cumsum(heads) - 1
            kept = np.bincount(parts)[parts] > 1
            live, heads = live[kept], heads[kept]
            starts = np.flatnonzero(heads)

    def _name_at(self, name: np.ndarray, position: np.ndarray) -> np.ndarray:
        place = self.place[np.clip(position, 0, len(self.place) - 1)]
        return np.where((place >= 0) & (position >= 0), name[place], -1)

    def extend(self, x: np.ndarray, y: np.ndarray, codes: np.ndarray, rows: np.ndarray, ahead: bool) -> np.ndarray:
        """Length of the longest common stretch that begins (or ends) at x and y."""
        x, y, total = x.copy(), y.copy(), np.zeros(len(x), np.int64)
        sign = 1 if ahead else -1
        for k in reversed(range(len(self.names))):
            span = BLOCK << k
            a, b = (x, y) if ahead else (x - span, y - span)
            one, two = self._name_at(self.names[k], a), self._name_at(self.names[k], b)
            step = np.where((one >= 0) & (one == two), span, 0)
            x, y, total = x + sign * step, y + sign * step, total + step
        open_ = np.ones(len(x), bool)
        for _ in range(BLOCK - 1):
            a, b = (x, y) if ahead else (x - 1, y - 1)
            fine = (a >= 0) & (b < len(codes))
            a, b = np.where(fine, a, 0), np.where(fine, b, 0)
            open_ &= fine & (codes[a] == codes[b]) & (rows[a] == rows[b])
            x, y, total = x + sign * open_, y + sign * open_, total + open_
        return total


def _candidates(codes: np.ndarray, rows: np.ndarray, first_word: np.ndarray) -> tuple[SuffixArray, np.ndarray, np.ndarray]:
    """Positions and periods: each aligned dyadic block that occurs again next to it."""
    suffixes = SuffixArray(codes, rows)
    if not len(suffixes.array):
        return suffixes, np.empty(0, np.int64), np.empty(0, np.int64)
    tree = WaveletTree(suffixes.array)
    own = suffixes.positions - first_word[rows[suffixes.positions]]
    found_p, found_q = [], []
    for k, (name, size) in enumerate(zip(suffixes.names, suffixes.sizes)):
        b = BLOCK << k
        asked = np.flatnonzero((name >= 0) & (own % b == 0))
        at, lo = suffixes.positions[asked], name[asked]
        # Periods from b to 2 b - 1; the shortest blocks serve the shorter periods too.
        for near, far in [(b, 2 * b)] + ([(1, b)] if k == 0 else []):
            start = np.searchsorted(suffixes.positions, at + near)
            stop = np.searchsorted(suffixes.positions, at + far)
            some, first, second, last, n = tree.window(lo, lo + size[lo], start, stop)
            first, second, last = (suffixes.positions[v] for v in (first, second, last))
            step = np.where(n > 1, second - first, 1)
            member = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            # A progression, unless two blocks' hashes were equal by chance.
            places = np.minimum(np.repeat(first, n) + member * np.repeat(step, n), np.repeat(last, n))
            p = np.repeat(at[some], n)
            found_p.append(p)
            found_q.append(places - p)
    return suffixes, np.concatenate(found_p), np.concatenate(found_q)


def _found(codes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """All runs of a chunk of coded words: (row, start, length, period), start in the
    row's words, by row, start and period."""
    first_word = np.searchsorted(rows, np.arange(n_rows))
    suffixes, p, q = _candidates(codes, rows, first_word)
    if not len(p):
        return np.empty((0, 4), np.int64)
    left = suffixes.extend(p, p + q, codes, rows, ahead=False)
    right = suffixes.extend(p, p + q, codes, rows, ahead=True)
    start, length = p - left, left + right + q
    fine = length >= np.maximum(MIN_WORDS, MIN_EXPONENT * q)
    found = np.unique(np.stack((start, length, q), axis=1)[fine], axis=0)
    # Multiples of a period cover the same stretch: the smallest is the period.
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[fresh]
    row = rows[found[:, 0]]
    found = np.column_stack((row, found[:, 0] - first_word[row], found[:, 1], found[:, 2]))
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def runs_of(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """All runs of a chunk's words, each compared byte by byte.

    Words are coded by 64-bit hashes. Should two codes or blocks be equal by chance, so
    that a run fails the comparison, the words are numbered and the blocks hashed anew.
    """
    if not len(begins):
        return np.empty((0, 4), np.int64)
    sizes = ends - begins
    at = np.concatenate(([0], np.cumsum(sizes)))
    letters = data[np.arange(at[-1]) + np.repeat(begins - at[:-1], sizes)]
    first_word = np.searchsorted(rows, np.arange(n_rows))

    def same(row: int, start: int, length: int, period: int) -> bool:
        a, b = first_word[row] + start, first_word[row] + start + length
        return np.array_equal(sizes[a : b - period], sizes[a + period : b]) and np.array_equal(
            letters[at[a] : at[b - period]], letters[at[a + period] : at[b]]
        )

    codes, salt = span_hashes(data, begins, ends), 0
    while True:
        found = _found(codes, rows, n_rows)
        if all(same(*run) for run in found.tolist()):
            return found
        salt += 1
        text = letters.tobytes()
        known: dict[bytes, int] = {}
        numbers = [known.setdefault(text[a:b], len(known)) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        codes = mixed(np.array(numbers, np.uint64) * _P + np.uint64(salt), _Q)


def _collapsed(data, begins, ends, rows, dropped, n_rows) -> pa.Array:
    """Kept words of every row, joined by one space."""
    kept = np.flatnonzero(~dropped)
    delta = np.zeros(len(data) + 1, np.int32)
    delta[begins[kept]] += 1
    delta[ends[kept]] -= 1
    mask = np.cumsum(delta[:-1]) > 0
    follows = kept[:-1][rows[kept[1:]] == rows[kept[:-1]]]  # words with another one behind them
    out = data.copy()
    out[ends[follows]] = 0x20
    mask[ends[follows]] = True
    sizes = np.bincount(rows[kept], ends[kept] - begins[kept], n_rows) + np.bincount(rows[follows], minlength=n_rows)
    offsets = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))
    return pa.Array.from_buffers(
        pa.large_string(), n_rows, [None, pa.py_buffer(offsets), pa.py_buffer(out[mask].tobytes())]
    ).cast(pa.string())


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``n_words``, ``runs`` (start, length, period; by start and period)
    and ``collapsed``: the words that no run holds after its first period, joined by
    one space."""
    run_type = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    out = StructType(
        [
            StructField("doc_id", docs.schema[id_col].dataType),
            StructField("n_words", LongType()),
            StructField("runs", ArrayType(run_type)),
            StructField("collapsed", StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        for chunk in row_chunks(batches, "text"):
            n = chunk.num_rows
            data, offsets = utf8_column(chunk.column("text"))
            begins, ends, rows = word_spans(data, offsets)
            found = runs_of(data, begins, ends, rows, n)
            first_word = np.searchsorted(rows, np.arange(n))
            delta = np.zeros(len(rows) + 1, np.int64)
            begin = first_word[found[:, 0]] + found[:, 1]
            np.add.at(delta, begin + found[:, 3], 1)
            np.add.at(delta, begin + found[:, 2], -1)
            dropped = np.cumsum(delta[:-1]) > 0
            spans = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
            ends_of = np.searchsorted(found[:, 0], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    pa.array(np.bincount(rows, minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends_of), spans),
                    _collapsed(data, begins, ends, rows, dropped, n),
                ],
                schema=schema,
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, out)
