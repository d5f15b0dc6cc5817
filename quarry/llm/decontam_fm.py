"""Benchmark decontamination with an FM-index for each training shard.

A shard is a few megabytes of consecutive documents inside one task. Its words
become symbols of the benchmark's vocabulary; any other word ends a run, as no
test phrase can go across it. Over the runs a suffix array gives the
Burrows-Wheeler transform, kept as a wavelet tree with ranks. All test phrases
(windows of ``window`` words) are searched backward at once; the rows found are
located by stepping back to the nearest sampled suffix position, the words
found are compared with the phrase's own, and overlapping occurrences merge
into removal spans.

Nothing is shuffled: every task indexes what it reads and drops the index. The
benchmark goes to all workers in blocks of at most ``block_bytes`` of text; more
than one block means one pass for each, merged per document.

Defined results: a null or empty text has no words and no hits; an item without
words has no phrase; items of equal id count once, a null id counts as "null".
Repeated rows are judged each. Other columns are ignored unless kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import row_chunks, tidy, utf8_column
from quarry.llm.pretokens import span_hashes

WINDOW = 10
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 16 << 20
SAMPLE_EVERY = 16
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True

SPANS = "array<struct<start:int,stop:int>>"


class Phrases:
    """Distinct windows of benchmark items over their vocabulary.

    ``words`` are the vocabulary in hash order (symbol k + 1 is ``words[k]``);
    ``windows`` has one row of symbols for each distinct window, right-aligned.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
            for k in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[k : k + window]), set()).add(item)
        vocabulary = sorted({w for phrase in found for w in phrase})
        hashes = np.array([word_hash(w) for w in vocabulary], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.words = hashes[order], [vocabulary[k] for k in order]
        symbol = {w: k + 1 for k, w in enumerate(self.words)}
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.windows = np.zeros((len(found), window), np.int64)
        for k, phrase in enumerate(found):
            self.windows[k, window - len(phrase) :] = [symbol[w] for w in phrase]
        self.items = [sorted(x) for x in found.values()]


def word_hash(word: bytes) -> int:
    return int(span_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


class WaveletTree:
    """Symbols by bits, highest first: each level keeps the running count of ones,
    and the symbols move on with zeros before ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in reversed(range(bits)):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, first: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before rows ``first`` and ``upto``."""
        node = np.zeros_like(first)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - k)) & 1 == 1
            node, first, upto = (np.where(bit, zeros + ones[x], x - ones[x]) for x in (node, first, upto))
        return first - node, upto - node


class FMIndex:
    """Index of a sequence of symbols from 1 on, cut into runs by zeros (the last
    symbol must be a zero). Zeros are all different: no comparison goes past one."""

    def __init__(self, text: np.ndarray, sample_every: int = SAMPLE_EVERY):
        n = len(text)
        stops = text == 0
        rows = _suffix_array(text, stops)
        before = text[rows - 1]
        before[rows == 0] = 0
        top = int(text.max(initial=0))
        self.first_row = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.bwt = before
        self.tree = WaveletTree(before, max(1, top.bit_length()))
        run_start = np.ones(n, bool)
        run_start[1:] = stops[:-1]
        sampled = (run_start | (np.arange(n) % sample_every == 0))[rows]
        self.sampled, self.samples, self.sample_at = sampled, rows[sampled], np.cumsum(sampled) - 1

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and row after the last of each window (rows of symbols, right-aligned)."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), len(self.bwt), np.int64)
        top = len(self.first_row) - 2
        for step in range(windows.shape[1]):
            live = np.flatnonzero((step < lengths) & (low < high))
            symbol = windows[live, windows.shape[1] - 1 - step]
            absent = symbol > top
            high[live[absent]] = low[live[absent]]
            live, symbol = live[~absent], symbol[~absent]
            a, b = self.tree.rank(symbol, low[live], high[live])
            low[live], high[live] = self.first_row[symbol] + a, self.first_row[symbol] + b
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back until a sampled position; a run's
        first position is always sampled, so no step goes over a zero."""
        steps, rows = np.zeros(len(rows), np.int64), rows.copy()
        open_rows = np.flatnonzero(~self.sampled[rows])
        while len(open_rows):
            at = rows[open_rows]
            symbol = self.bwt[at]
            rank, _ = self.tree.rank(symbol, at, at)
            rows[open_rows] = self.first_row[symbol] + rank
            steps[open_rows] += 1
            open_rows = open_rows[~self.sampled[rows[open_rows]]]
        return self.samples[self.sample_at[rows]] + steps


def _suffix_array(text: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Prefix doubling; positions whose rank is settled leave the sorting."""
    n = len(text)
    rank = np.zeros(n + 1, np.int64)  # rank: the first row of the position's group
    rank[n] = -1
    order = np.argsort(np.where(stops, 0, text), kind="stable")
    ordered = text[order]
    first = np.ones(n, bool)
    first[1:] = (ordered[1:] != ordered[:-1]) | (ordered[1:] == 0)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    last = np.append(first[1:], True)
    rows = np.flatnonzero(~(first & last))
    step = 1
    while len(rows):
        pos = order[rows]
        by = np.lexsort((rank[np.minimum(pos + step, n)], rank[pos]))
        pos = pos[by]
        group, after = rank[pos], rank[np.minimum(pos + step, n)]
        order[rows] = pos
        new = np.ones(len(rows), bool)
        new[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        rank[pos] = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        single = new & np.append(new[1:], True)
        rows = rows[~single]
        step *= 2
    return order


def find_hits(
    data: np.ndarray, offsets: np.ndarray, phrases: Phrases
) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
    """Words, merged hit spans (in words) and items of each text of one shard."""
    n_docs = len(offsets) - 1
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n_docs)]
    items: list[list[str]] = [[] for _ in range(n_docs)]
    lower = _LOWER[data]
    inside = np.zeros(len(lower) + 1, bool)
    inside[:-1] = _IS_WORD[lower]
    edge = np.zeros(len(lower) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(inside[:-1] & (np.concatenate(([True], ~inside[:-2])) | edge[:-1])) if len(lower) else np.empty(0, np.int64)
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge[1:])) + 1 if len(lower) else np.empty(0, np.int64)
    doc_of = np.searchsorted(offsets, begins, side="right") - 1
    n_words = np.bincount(doc_of, minlength=n_docs)
    if not len(begins) or not len(phrases.lengths):
        return n_words, spans, items
    hashes = span_hashes(lower, begins, ends)
    at = np.minimum(np.searchsorted(phrases.hashes, hashes), len(phrases.hashes) - 1)
    symbols = np.where(phrases.hashes[at] == hashes, at + 1, 0)

    # Runs of known words inside one document; shorter ones than any phrase hold none.
    known = symbols > 0
    run_start = known.copy()
    run_start[1:] &= ~known[:-1] | (doc_of[1:] != doc_of[:-1])
    starts = np.flatnonzero(run_start)
    run_end = known.copy()
    run_end[:-1] &= ~known[1:] | (doc_of[1:] != doc_of[:-1])
    sizes = np.flatnonzero(run_end) + 1 - starts
    long = sizes >= phrases.lengths.min()
    starts, sizes = starts[long], sizes[long]
    if not len(starts):
        return n_words, spans, items
    total = int(sizes.sum()) + len(sizes)
    step = np.ones(total, np.int64)
    heads = np.cumsum(sizes + 1) - (sizes + 1)
    step[heads] = starts - np.concatenate(([0], (starts + sizes)[:-1]))
    word_at = np.cumsum(step)  # a run's words, then one place for its end
    text = np.zeros(total, np.int64)
    body = np.ones(total, bool)
    body[heads + sizes] = False
    text[body] = symbols[word_at[body]]

    index = FMIndex(text)
    low, high = index.search(phrases.windows, phrases.lengths)
    counts = high - low
    if not counts.any():
        return n_words, spans, items
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    word = word_at[index.locate(rows)]
    size = phrases.lengths[which]

    # The words found, byte by byte.
    hit = _covered(word, size, len(symbols))
    for k in np.flatnonzero(hit).tolist():
        if lower[begins[k] : ends[k]].tobytes() != phrases.words[symbols[k] - 1]:
            good = (word + size <= k) | (word > k)
            word, size, which = word[good], size[good], which[good]
    hit = _covered(word, size, len(symbols))
    doc_first = np.concatenate(([0], np.cumsum(n_words)))
    left = np.flatnonzero(hit & ~np.concatenate(([False], hit[:-1] & (doc_of[1:] == doc_of[:-1]))))
    right = np.flatnonzero(hit & ~np.concatenate((hit[1:] & (doc_of[1:] == doc_of[:-1]), [False]))) + 1
    for a, b, d in zip(left.tolist(), right.tolist(), doc_of[left].tolist()):
        spans[d].append((a - int(doc_first[d]), b - int(doc_first[d])))
    pairs = np.unique(np.stack((doc_of[word], which), 1), axis=0)
    found: dict[int, set[str]] = {}
    for d, w in pairs.tolist():
        found.setdefault(d, set()).update(phrases.items[w])
    for d, own in found.items():
        items[d] = sorted(own)
    return n_words, spans, items


def _covered(starts: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    delta = np.bincount(starts, minlength=n + 1) - np.bincount(starts + sizes, minlength=n + 1)
    return np.cumsum(delta)[:n] > 0


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: id, the columns ``keep``, ``n_words``, ``spans`` (merged hit words,
    first and after the last) and ``items`` (ids as sorted strings)."""
    given = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text).alias("text")
    )
    total = given.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    rows = docs.select(
        F.struct(id_col, *keep).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    passes = []
    for k in range(blocks):
        own = given.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k) if blocks > 1 else given
        passes.append(_search_block(rows, [(r.item, r.text) for r in own.collect()], window, blocks > 1))
    if blocks == 1:
        return passes[0].select("row.*", "n_words", "spans", "items")
    merged = passes[0]
    for one in passes[1:]:
        merged = merged.unionByName(one)
    # Rows of equal id, kept columns and text are the same row as often as it came.
    both = merged.groupBy("row", "digest", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.expr(f"count(*) div {blocks}").alias("times"),
    )
    single = both.select("row", "n_words", _merge_spans(F.col("spans")).alias("spans"), "items", "times")
    again = F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")
    return single.select("*", again).select("row.*", "n_words", "spans", "items")


def _merge_spans(spans):
    """Union of word spans as an expression: sorted, then overlapping or touching ones joined."""
    empty = F.array().cast(SPANS)

    def add(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= span["start"])
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop")
        )
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def _search_block(rows: DataFrame, items: list[tuple[str, str | None]], window: int, digest: bool) -> DataFrame:
    phrases = rows.sparkSession.sparkContext.broadcast(Phrases(items, window))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in row_chunks(batches, "text", SHARD_BYTES):
            data, offsets = utf8_column(shard.column("text"))
            n_words, spans, items = find_hits(data, offsets, phrases.value)
            span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    shard.column("row"),
                    shard.column("digest"),
                    pa.array(n_words, pa.int64()),
                    pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], span_type),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["row", "digest", "n_words", "spans", "items"],
            )

    row = rows.schema["row"].dataType.simpleString()
    hashed = F.md5("text") if digest else F.lit("")
    return rows.select("row", "text", hashed.alias("digest")).mapInArrow(
        run, f"row {row}, digest string, n_words long, spans {SPANS}, items array<string>"
    )


