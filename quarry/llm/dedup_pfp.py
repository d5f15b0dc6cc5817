"""Repeated byte strings by prefix-free parsing.

A byte is removed if a string of ``SIZE`` bytes that covers it starts anywhere
else in the corpus. Corpus order (all text positions sorted by what follows)
brings equal strings together; prefix-free parsing finds that order from
phrases instead of from every position:

* Parsing. A rolling hash over ``GRAM`` bytes triggers at the position where it is least among
  the positions of a ``SIZE``-byte string. All starts with one trigger are a
  phrase, which with the ``SIZE`` - 1 bytes after it is a dictionary word. Equal
  strings have equal triggers at equal places, so only phrases with a trigger
  string that occurs again go on; unique text ends here.
* Dictionary. Equal words are one entry with a count: every start in a word that
  occurs again is repeated, so highly repetitive text is settled phrase by phrase.
* Order. What is left are suffixes of distinct words. They are sorted in two
  steps, first by the bytes common to ``BLOCK`` neighbouring starts, then each
  start by its ``SIZE`` bytes, and equal neighbours are repeated.

Only equality of the first ``SIZE`` bytes matters, never which suffix is
smaller. So the suffix arrays of dictionary and parse are kept as classes of
equal keys: shuffles sort 128-bit fingerprints of the suffixes (64-bit ones
where a collision can only add candidates) instead of the bytes. No step holds
more than a chunk of text, no group is collected, and hot keys are counted with
partial sums and joined back with plain joins that adaptive execution can split.

Defined results: a null text is empty; a text under ``SIZE`` bytes loses nothing;
repeated rows remove each other. Matches never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_shuffles, row_chunks, stage, utf8_column
from quarry.llm.pretokens import _powers_to

SIZE = 200
GRAM = 32
BLOCK = 16
CHUNK_BYTES = 2 << 20
_POSITION_BITS = 31  # a text is at most 2 GB

_rng = np.random.default_rng(5)
_TABLES = [_rng.integers(0, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_MUL = np.uint64(0xD6E8FEB86659FD93)

WORDS = "uid long, n int, data binary, at array<int>, size array<int>, lead array<int>, pos array<int>, weight array<int>"


class Hashes:
    """Rolling hash of any span of ``data``, by prefix sums."""

    def __init__(self, data: np.ndarray, table: int = 0):
        up, self.down = _powers_to(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[table][data] * up[: len(data)], out=sums[1:])
        self.sums = sums

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        h = (self.sums[stop] - self.sums[start]) * self.down[start]
        h ^= h >> np.uint64(32)
        h *= _MUL
        return h ^ (h >> np.uint64(29))


def phrases(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Phrases of texts laid end to end: row, first start, number of starts, trigger
    position (all in ``data``), and the hash of the trigger string."""
    none = np.empty(0, np.int64)
    last = len(data) - size + 1
    if last <= 0 or size <= GRAM:
        return none, none, none, none, none.astype(np.uint64)
    hashes = Hashes(data)
    grams = np.arange(len(data) - GRAM + 1)
    least = hashes.of(grams, grams + GRAM)
    least &= ~np.uint64((1 << _POSITION_BITS) - 1)
    least |= grams.astype(np.uint64)
    width, reach = size - GRAM + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if width > reach:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    trigger = (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    lengths = np.diff(offsets)
    full = np.flatnonzero(lengths >= size)
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, offsets[full], 1)
    np.add.at(edge, offsets[full] + lengths[full] - size + 1, -1)
    inside = np.cumsum(edge)[:last] > 0
    new = np.ones(last, bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (inside[1:] != inside[:-1])
    new[offsets[full]] = True
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, last))
    real = inside[first]
    first, count = first[real], count[real]
    at = trigger[first]
    row = np.searchsorted(offsets, first, side="right") - 1
    return row, first, count, at, hashes.of(at, at + GRAM)


def _numbered(row: np.ndarray) -> np.ndarray:
    """Place of each phrase among those of its row."""
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    return np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + count[0] - 1, first[1] .., end to end."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32))


def _lists(row: np.ndarray, n_rows: int, values: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n_rows))))
    return pa.ListArray.from_arrays(_ints(ends), _ints(values))


class Words:
    """Blocks of window starts with the bytes they reach, from rows of the schema WORDS."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch
        data = batch.column("data")
        lengths = np.array([len(x.as_py()) for x in data], np.int64)
        self.data = np.frombuffer(b"".join(x.as_py() for x in data), np.uint8)
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        sizes = batch.column("at").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.repeat(np.arange(batch.num_rows), sizes)
        self.item = _numbered(self.row)
        flat = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "size", "lead", "pos", "weight")}
        self.at = flat["at"] + offsets[self.row]
        self.size, self.lead, self.pos, self.weight = (flat[c] for c in ("size", "lead", "pos", "weight"))

    def select(self, items: np.ndarray, size: int, block: int | None) -> pa.RecordBatch | None:
        """Rows with the chosen items only, cut into blocks of starts if asked."""
        row, at, count, lead, pos, weight = (
            x[items] for x in (self.row, self.at, self.size, self.lead, self.pos, self.weight)
        )
        # Bytes: one piece for each run of items that follow each other without a gap.
        joins = np.zeros(len(at), bool)
        joins[1:] = (row[1:] == row[:-1]) & (at[1:] == at[:-1] + count[:-1])
        heads = np.flatnonzero(~joins)
        tails = np.append(heads[1:], len(at)) - 1
        begin, length = at[heads], at[tails] + count[tails] - 1 + size - at[heads]
        held = self.data[_ragged(begin, length)]
        piece = np.cumsum(~joins) - 1
        rows, new_row = np.unique(row, return_inverse=True)
        piece_first = np.cumsum(length) - length
        row_first = piece_first[np.searchsorted(row[heads], rows)]
        new_at = at - begin[piece] + piece_first[piece] - row_first[new_row]
        ends = np.append(row_first[1:], len(held))
        if block:
            starts = _ragged(np.zeros(len(at), np.int64), count)
            owner = np.repeat(np.arange(len(at)), count)
            part = (lead[owner] - starts) // block
            new = np.ones(len(starts), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])
            first = np.flatnonzero(new)
            owner, skip = owner[first], starts[first]
            count = np.diff(np.append(first, len(starts)))
            new_row, new_at, lead, pos, weight = (
                new_row[owner], new_at[owner] + skip, lead[owner] - skip, pos[owner] + skip, weight[owner]
            )
        blob = held.tobytes()
        keep = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [
                self.batch.column("uid").take(keep),
                self.batch.column("n").take(keep),
                pa.array([blob[a:b] for a, b in zip(row_first.tolist(), ends.tolist())], pa.binary()),
                *(_lists(new_row, len(rows), v) for v in (new_at, count, lead, pos, weight)),
            ],
            ["uid", "n", "data", "at", "size", "lead", "pos", "weight"],
        )


def _trigger_strings(texts: DataFrame, size: int) -> DataFrame:
    """Trigger strings (hashes) that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in row_chunks(batches, "text", CHUNK_BYTES):
            *_, gram = phrases(*utf8_column(chunk.column("text")), size)
            keys, counts = np.unique(gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([_longs(keys), pa.array(counts)], ["gram", "c"])

    counted = texts.select("text").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))
    return counted.where("c > 1").select("gram")


def _occurrences(texts: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in row_chunks(batches, "text", CHUNK_BYTES):
            row, *_, gram = phrases(*utf8_column(chunk.column("text")), size)
            uid = chunk.column("uid").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [_longs(gram), pa.array(uid[row]), _ints(_numbered(row))], ["gram", "uid", "item"]
            )

    return texts.select("uid", "text").mapInArrow(run, "gram long, uid long, item int")


def _words(chosen: DataFrame, size: int) -> DataFrame:
    """Dictionary words of the phrases named by ``items``, one row for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in row_chunks(batches, "text", CHUNK_BYTES):
            data, offsets = utf8_column(chunk.column("text"))
            row, first, count, at, _ = phrases(data, offsets, size)
            lists = chunk.column("items")
            owner = np.repeat(np.arange(chunk.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            named = lists.flatten().to_numpy(zero_copy_only=False)
            base = np.searchsorted(row, np.arange(chunk.num_rows))
            sizes = np.bincount(row, minlength=chunk.num_rows)
            good = named < sizes[owner]
            items = np.sort(base[owner[good]] + named[good])
            if not len(items):
                continue
            raw = data.tobytes()
            copies = chunk.column("copies").to_numpy(zero_copy_only=False)
            whole = pa.RecordBatch.from_arrays(
                [
                    chunk.column("uid"),
                    chunk.column("n"),
                    pa.array([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.binary()),
                    *(
                        _lists(row, chunk.num_rows, v)
                        for v in (first - offsets[row], count, at - first, first - offsets[row], np.minimum(copies, 2)[row])
                    ),
                ],
                ["uid", "n", "data", "at", "size", "lead", "pos", "weight"],
            )
            yield Words(whole).select(items, size, None)

    return chosen.select("uid", "n", "text", "items", "copies").mapInArrow(run, WORDS)


def _keys(words: DataFrame, size: int, block: int, level: str) -> DataFrame:
    """Keys of the words' items: of the whole word, of the bytes common to an aligned
    block of starts, or of each start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                w = Words(batch.slice(k, 256))
                at, item, pos, count = w.at, np.arange(len(w.at)), w.pos, w.size
                if level == "word":
                    start, stop = at, at + count - 1 + size
                elif level == "block":
                    aligned = (w.lead - (count - 1)) // block * block  # the block's least lead
                    start = at + w.lead - aligned
                    stop = start - (block - 1) + size
                else:
                    item = np.repeat(item, count)
                    starts = _ragged(np.zeros(len(at), np.int64), count)
                    start, pos = at[item] + starts, pos[item] + starts
                    stop, count = start + size, np.ones(len(start), np.int64)
                pair = [Hashes(w.data, t).of(start, stop) for t in range(2)]
                uid, n = (w.batch.column(c).to_numpy(zero_copy_only=False)[w.row[item]] for c in ("uid", "n"))
                yield pa.RecordBatch.from_arrays(
                    [
                        *map(_longs, pair), pa.array(uid), pa.array(n), _ints(w.item[item]), _ints(pos),
                        _ints(count), _ints(w.weight[item]),
                    ],
                    ["k1", "k2", "uid", "n", "item", "pos", "size", "weight"],
                )

    return words.mapInArrow(
        run, "k1 long, k2 long, uid long, n int, item int, pos int, size int, weight int"
    )


def _narrow(words: DataFrame, items: DataFrame, size: int, block: int | None) -> DataFrame:
    """``words`` with only the given items (uid, n, item, weight), their weights set anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                w = Words(part.select(["uid", "n", "data", "at", "size", "lead", "pos", "weight"]))
                first = np.searchsorted(w.row, np.arange(part.num_rows))
                owner, chosen, weights = [], [], []
                for r, pairs in enumerate(part.column("chosen").to_pylist()):
                    best: dict[int, int] = {}
                    for p in pairs:
                        best[p["item"]] = max(best.get(p["item"], 0), p["weight"])
                    for item, weight in sorted(best.items()):
                        owner.append(r)
                        chosen.append(item)
                        weights.append(weight)
                at = first[np.array(owner, np.int64)] + np.array(chosen, np.int64)
                w.weight[at] = weights
                yield w.select(at, size, block)

    lists = items.groupBy("uid", "n").agg(F.collect_list(F.struct("item", "weight")).alias("chosen"))
    return words.join(lists, ["uid", "n"]).select(*words.columns, "chosen").mapInArrow(run, WORDS)


def repeated_spans(
    docs: DataFrame, size: int = SIZE, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: id, the columns ``keep``, ``n_bytes``, ``spans`` (maximal removed byte
    runs) and ``kept`` (the remaining bytes)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(
        F.struct(id_col, *keep).alias("row"),
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("uid"),
        F.octet_length(text).alias("n"),
    )
    spark = docs.sparkSession
    long_texts = texts.where(F.col("n") >= size)

    again = stage(_trigger_strings(long_texts, size), "pfp-triggers")
    free_shuffles(spark)
    flagged = _occurrences(long_texts, size).join(again, "gram", "left_semi")
    named = flagged.groupBy("uid").agg(F.collect_set("item").alias("items"))
    copies = long_texts.groupBy("uid", "n").agg(F.min("id").alias("holder"), F.count("*").alias("copies"))
    chosen = stage(named.join(copies, "uid"), "pfp-phrases")
    free_shuffles(spark)
    # One holder of each text speaks for all its copies.
    held = (
        long_texts.alias("t")
        .join(chosen.alias("c"), (F.col("t.uid") == F.col("c.uid")) & (F.col("t.n") == F.col("c.n")))
        .where(F.col("t.id").eqNullSafe(F.col("c.holder")))
        .select("t.uid", "t.n", "t.text", "c.items", "c.copies")
    )
    words = stage(_words(held, size), "pfp-words")
    free_shuffles(spark)

    # Words that occur again are repeated as a whole.
    keyed = _keys(words, size, block, "word")
    entries = keyed.groupBy("k1", "k2").agg(
        F.sum("weight").alias("total"), F.min(F.struct("uid", "n", "item")).alias("holder")
    )
    # Staged, so that the join below has two plain exchanges and can split a hot key.
    repeated = stage(entries.where("total > 1").select("k1", "k2", "holder"), "pfp-entries")
    settled = stage(
        keyed.join(repeated, ["k1", "k2"], "left").select(
            "uid", "n", "item", "pos", "size", F.col("holder").isNotNull().alias("again"),
            F.coalesce(F.col("holder") == F.struct("uid", "n", "item"), F.lit(False)).alias("holds"),
        ),
        "pfp-settled",
    )
    free_shuffles(spark)
    # The others meet one holder of each repeated word, which counts twice.
    open_items = settled.where("NOT again OR holds").select(
        "uid", "n", "item", F.when(F.col("again"), 2).otherwise(1).alias("weight")
    )
    blocks = stage(_narrow(words, open_items, size, block), "pfp-blocks")
    free_shuffles(spark)
    keyed = _keys(blocks, size, block, "block")
    common = keyed.groupBy("k1").agg(F.count("*").alias("c"), F.min("weight").alias("low"))
    shared = stage(common.where("c > 1 AND low = 1").select("k1"), "pfp-shared")
    near = keyed.join(shared, "k1", "left_semi").select("uid", "n", "item", "weight")
    starts = stage(_narrow(blocks, stage(near, "pfp-near"), size, None), "pfp-starts")
    free_shuffles(spark)
    keyed = _keys(starts, size, block, "start")
    counted = keyed.groupBy("k1", "k2").agg(F.sum("weight").alias("total"))
    equal = stage(counted.where("total > 1").select("k1", "k2"), "pfp-equal")
    found = keyed.where("weight = 1").join(equal, ["k1", "k2"], "left_semi").select("uid", "n", "pos", "size")
    hits = settled.where("again").select("uid", "n", "pos", "size").unionByName(found)
    removed = stage(
        hits.groupBy("uid", "n").agg(
            F.collect_list(F.struct(F.col("pos").alias("start"), (F.col("pos") + F.col("size") - 1 + size).alias("stop"))).alias("hits")
        ),
        "pfp-hits",
    )
    free_shuffles(spark)
    return _cut(texts.join(removed, ["uid", "n"], "left").select("row", "text", "hits"))


def _cut(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for chunk in row_chunks(batches, "text", CHUNK_BYTES):
            data, offsets = utf8_column(chunk.column("text"))
            hits = chunk.column("hits")
            owner = np.repeat(np.arange(chunk.num_rows), np.nan_to_num(hits.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            flat = hits.flatten()
            edge = np.zeros(len(data) + 1, np.int64)
            for name, step in (("start", 1), ("stop", -1)):
                np.add.at(edge, offsets[owner] + flat.field(name).to_numpy(zero_copy_only=False), step)
            gone = np.cumsum(edge)[:-1] > 0
            raw = data[~gone].tobytes()
            left = np.concatenate(([0], np.cumsum(~gone)))[offsets].tolist()
            first = np.zeros(len(data) + 1, bool)
            first[offsets] = True
            begin = np.flatnonzero(gone & (np.concatenate(([True], ~gone[:-1])) | first[:-1])) if len(data) else np.empty(0, np.int64)
            end = np.flatnonzero(gone & (np.concatenate((~gone[1:], [True])) | first[1:])) + 1 if len(data) else begin
            row = np.searchsorted(offsets, begin, side="right") - 1
            spans: list[list[dict[str, int]]] = [[] for _ in range(chunk.num_rows)]
            for r, a, b in zip(row.tolist(), (begin - offsets[row]).tolist(), (end - offsets[row]).tolist()):
                spans[r].append({"start": a, "stop": b})
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("row"),
                    pa.array(np.diff(offsets)),
                    pa.array(spans, span_type),
                    pa.array([raw[a:b] for a, b in zip(left[:-1], left[1:])], pa.binary()),
                ],
                ["row", "n_bytes", "spans", "kept"],
            )

    row = rows.schema["row"].dataType.simpleString()
    cut = rows.mapInArrow(run, f"row {row}, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary")
    return cut.select("row.*", "n_bytes", "spans", "kept")
