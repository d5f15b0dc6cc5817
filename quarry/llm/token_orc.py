"""Token ids as ORC: integer run-length encoded id lists in ``doc_id`` order,
with row indexes and Bloom filters on ``doc_id``.

Writing: rows are range-partitioned by ``doc_id`` and sorted inside each
partition, so every file and every stripe covers one id range; one task writes
one file. ORC stores the id lists with its integer run-length encoding, keeps
minimum and maximum of ``doc_id`` per stripe and row group, and a Bloom filter
per row group. Reading: Spark splits files by stripe, and a filter on ``doc_id``
skips stripes and row groups by these.

Defined results: a null text is empty and becomes the end id alone; rows of the
same ``doc_id`` follow each other, ordered by a hash of their text; a null
``doc_id`` comes first. A text that holds a string of an added token is encoded
by the library whole. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import pretokens as pt
from quarry.llm.common import row_chunks, small_batches, tidy, with_offsets
from quarry.llm.token_count import load

END_ID = 0
STRIPE_BYTES = 64 << 20
ROW_GROUP = 10_000
BLOOM_FPP = 0.01
WINDOW_BYTES = 2 << 20

FILE_SCHEMA = "part int, doc_id long, local_start long, ids array<int>"


class Encoder:
    """One worker's encoding state for a byte-level vocabulary."""

    def __init__(self, path: str):
        self.tok = load(path)
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        model = self.tok.model
        self.memo = pt.Memo(lambda s: [t.id for t in model.tokenize(pt.as_letters(s))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and the length of each."""
        slow = {
            k: np.array(self.tok.encode(t, add_special_tokens=False).ids, np.uint32)
            for k, t in enumerate(texts)
            if any(s in t for s in self.specials)
        }
        window = pt.resolve(["" if k in slow else t for k, t in enumerate(texts)], "byte", self.memo)
        first, sizes = self.memo.ends[window.slots], np.diff(self.memo.ends)[window.slots]
        lengths = np.bincount(window.doc_of, sizes, len(texts)).astype(np.int64)
        for k, ids in slow.items():
            lengths[k] = len(ids)
        lengths += 1
        ends = np.cumsum(lengths)
        out = np.full(ends[-1] if len(texts) else 0, END_ID, np.uint32)
        # A pre-token's place: tokens before it, and one end id for each text before.
        quick = np.ones(len(texts), bool)
        quick[list(slow)] = False
        before = np.cumsum(sizes) - sizes
        doc_first = np.concatenate(([0], np.cumsum(np.bincount(window.doc_of, sizes, len(texts)))))[:-1]
        place = before + ((ends - lengths) - doc_first.astype(np.int64))[window.doc_of]
        steps = np.arange(sizes.sum()) - np.repeat(before, sizes)
        out[np.repeat(place, sizes) + steps] = self.memo.ids[np.repeat(first, sizes) + steps]
        for k, ids in slow.items():
            out[ends[k] - lengths[k] : ends[k] - 1] = ids
        return out, lengths


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_token_orc(
    docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    stripe_bytes: int = STRIPE_BYTES, row_group: int = ROW_GROUP, bloom_fpp: float = BLOOM_FPP,
) -> None:
    """Encode every whole text and write the ids below ``path`` in ``doc_id`` order."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part, start = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for chunk in row_chunks(batches, "text", WINDOW_BYTES):
            ids, lengths = state.encode([t or "" for t in chunk.column("text").to_pylist()])
            ends = np.concatenate(([0], np.cumsum(lengths)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(lengths), part, np.int32)),
                    chunk.column("doc_id"),
                    pa.array(start + ends[:-1]),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32))),
                ],
                ["part", "doc_id", "local_start", "ids"],
            )
            start += int(ends[-1])

    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("tie"),
    )
    ordered = given.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    writer = (
        ordered.mapInArrow(run, FILE_SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(bloom_fpp))
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(row_group))
        .option("orc.create.index", "true")
    )
    with small_batches(docs.sparkSession):
        writer.orc(path)


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """The written rows: ``part``, ``doc_id``, ``local_start``, ``ids``. Filters on
    ``doc_id`` are pushed down to stripe and row-group statistics and Bloom filters."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``start``, ``n_tokens`` and ``ids_crc32``.

    ``start`` adds the ids of all earlier files (one total per file) to the
    document's place in its own file.
    """

    @tidy
    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            values = column.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            starts = np.concatenate(([0], ends[:-1]))
            crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part"),
                    batch.column("doc_id"),
                    batch.column("local_start"),
                    pa.array(ends - starts),
                    pa.array(crcs, pa.int64()),
                ],
                ["part", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )

    rows = read_token_orc(spark, path).mapInArrow(
        crc, "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    )
    totals = read_token_orc(spark, path).groupBy("part").agg(F.sum(F.size("ids").cast("long")).alias("total"))
    return rows.join(with_offsets(totals, "part", "total", "offset"), "part").select(
        "doc_id",
        (F.col("offset") + F.col("local_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
