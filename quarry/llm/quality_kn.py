"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model predicts each byte from the ``ORDER`` - 1 before it, so a gram is one integer
and no alphabet has to be fixed. It is trained on trusted documents (labelled
good and not toxic, four fifths of them); its counts, continuation counts,
context totals and probabilities are tables that meet in joins on the gram, cut
into shards by Spark's hash exchange. None is collected: the driver sees four
counts-of-counts for each order, for the discounts.

Documents are dealt into blocks of about ``BLOCK_BYTES``. A block sends each of its
distinct grams once, with the trusted count; the probabilities come back to the
block the same way, and the block's documents are scored against them. So the
shuffled rows grow with blocks times distinct grams, not with text length.

A document is kept if its perplexity and that of its worst stretches are each at most
the ``QUANTILE`` of the trusted documents of its language that were held out of
training, times ``SLACK``. The first sees the whole text, the second a few foreign
words in it. The worst stretches: of each ``CELL`` bytes the ``WINDOW`` bytes of least
probability, and of these the worst ``1 / WORST`` (one at least), averaged. Their number
grows with the text, so that a long text is not worse for having more of them; the
single worst window would drop clean long documents.

Defined results: a null or empty text has no perplexity and is not kept; a null
language is a language of its own; a language without held-out trusted
documents takes the quantiles of all, and with none at all every scored document
is kept; rows of one doc_id share its labels (trusted only if all say so).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_shuffles, stage

ORDER = 4
BLOCK_BYTES = 8 << 20
HELD_OUT_SHARE = 5
QUANTILE = 0.99
SLACK = 1.02
WINDOW = 6
CELL = 64
WORST = 32
ZSTD_LEVEL = 5
_BYTE = 8


def text_grams(data: np.ndarray) -> np.ndarray:
    """The gram that ends at each byte; zero bytes stand before the text."""
    padded = np.concatenate((np.zeros(ORDER - 1, np.int64), data.astype(np.int64)))
    out = np.zeros(len(data), np.int64)
    for k in range(ORDER):
        out = (out << _BYTE) | padded[k : k + len(data)]
    return out


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose every label says good and not toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return labels.groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("trusted")).where("trusted")


def _blocks(docs: DataFrame, id_col: str, text_col: str, lang_col: str, n_blocks: int) -> DataFrame:
    """Documents with a block number and compressed text, to be dealt by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
        for batch in batches:
            packed = [pack.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("block", "doc_id", "lang")), pa.array(packed, pa.binary())],
                ["block", "doc_id", "lang", "packed"],
            )

    given = docs.select(
        _block_of(F.col(id_col).cast("long"), n_blocks).alias("block"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return given.mapInArrow(run, "block int, doc_id long, lang string, packed binary")


def _block_of(doc_id: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(n_blocks)).cast("int")


def _unpack(column: pa.ChunkedArray) -> Iterator[np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    for value in column:
        yield np.frombuffer(unpack.decompress(value.as_py()), np.uint8)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_SHARE == 0, F.lit(False))


def _block_grams(blocks: DataFrame, training: DataFrame) -> DataFrame:
    """Per block: each distinct gram and its count in the block's training documents."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = set(right["doc_id"].to_pylist())
        seen, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        parts, weights, size = [], [], 0
        rows = left.num_rows
        for k, (doc_id, data) in enumerate(zip(left["doc_id"].to_pylist(), _unpack(left["packed"]))):
            parts.append(text_grams(data))
            weights.append(np.full(len(data), doc_id in ids))
            size += len(data)
            if size > 1 << 20 or k + 1 == rows:
                grams, inverse = np.unique(np.concatenate([seen, *parts]), return_inverse=True)
                counts = np.bincount(
                    inverse, np.concatenate([counts, *weights]), minlength=len(grams)
                ).astype(np.int64)
                seen, parts, weights, size = grams, [], [], 0
        block = left["block"][0].as_py() if rows else 0
        return pa.table({"block": pa.array(np.full(len(seen), block, np.int32)), "gram": seen, "c": counts})

    return blocks.groupBy("block").cogroup(training.groupBy("block")).applyInArrow(run, "block int, gram long, c long")


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ of one order, from its counts-of-counts."""
    n = counts.agg(*(F.coalesce(F.sum((F.col("a") == k).cast("long")), F.lit(0)) for k in range(1, 5))).first()
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = []
    for k in range(1, 4):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        out.append(min(max(d, 0.0), float(k)))
    return out


def probabilities(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, p) for every row of ``grams``: the interpolated probability of its last
    byte after the others. ``counts`` (gram, a) are the training counts."""
    queries, tables = [grams], [counts]
    for order in range(ORDER - 1, 0, -1):
        tail = F.col("gram").bitwiseAND(F.lit((1 << (_BYTE * order)) - 1)).alias("gram")
        queries.append(queries[-1].select(tail).distinct())
        # Continuation counts: the distinct bytes seen before a gram.
        tables.append(stage(tables[-1].groupBy(tail).agg(F.count("*").alias("a")), "kn-continuations"))
    lower = None
    for order in range(1, ORDER + 1):
        asked, counted = queries[ORDER - order], tables[ORDER - order]
        d1, d2, d3 = _discounts(counted)
        a = F.col("a")
        discount = F.when(a == 1, d1).when(a == 2, d2).otherwise(d3)
        context = F.shiftright("gram", _BYTE).alias("context")
        contexts = counted.groupBy(context).agg(F.sum("a").alias("total"), F.sum(discount).alias("freed"))
        known = (
            asked.join(counted, "gram", "left")
            .withColumn("context", F.shiftright("gram", _BYTE))
            .join(contexts, "context", "left")
            .withColumn("tail", F.col("gram").bitwiseAND(F.lit((1 << (_BYTE * (order - 1))) - 1)))
        )
        if lower is None:
            known = known.withColumn("below", F.lit(1.0 / (1 << _BYTE)))
        else:
            known = known.join(lower.select(F.col("gram").alias("tail"), F.col("p").alias("below")), "tail")
        own = F.coalesce(F.greatest(a - discount, F.lit(0.0)), F.lit(0.0))
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            (own + F.col("freed") * F.col("below")) / F.col("total")
        )
        lower = stage(known.select("gram", p.alias("p")), "kn-probabilities")
    return lower


def worst_stretches(log_p: np.ndarray) -> float:
    """Mean log probability per byte of the worst stretches of a (non-empty) text."""
    if len(log_p) <= WINDOW:
        return float(log_p.mean())
    sums = np.concatenate(([0.0], np.cumsum(log_p)))
    windows = sums[WINDOW:] - sums[:-WINDOW]
    least = np.sort(np.minimum.reduceat(windows, np.arange(0, len(windows), CELL)))
    return float(least[: -(-len(least) // WORST)].mean()) / WINDOW


def _score(blocks: DataFrame, logs: DataFrame) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, order = right["gram"].to_numpy(), np.argsort(right["gram"].to_numpy())
        grams, log_p = grams[order], right["log_p"].to_numpy()[order]
        sizes, totals, worst = [], [], []
        for data in _unpack(left["packed"]):
            sizes.append(len(data))
            own = log_p[np.searchsorted(grams, text_grams(data))] if len(data) else np.empty(0)
            totals.append(float(own.sum()))
            worst.append(worst_stretches(own) if len(data) else None)
        return pa.table(
            {
                "doc_id": left["doc_id"], "lang": left["lang"],
                "n_bytes": pa.array(sizes, pa.int64()), "log_p": pa.array(totals, pa.float64()),
                "worst": pa.array(worst, pa.float64()),
            }
        )

    return blocks.groupBy("block").cogroup(logs.groupBy("block")).applyInArrow(
        run, "doc_id long, lang string, n_bytes long, log_p double, worst double"
    )


def judge_quality(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK,
    block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Per row: ``doc_id``, ``lang``, ``n_bytes``, ``perplexity`` (per byte), ``threshold``
    of its language, ``kept``, and perplexity and threshold of the worst stretches."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    n_blocks = int(-(-total // block_bytes)) or 1
    blocks = _blocks(docs, id_col, text_col, lang_col, n_blocks)
    trusted = trusted_ids(labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic"))
    training = trusted.where(~held_out(F.col("doc_id"))).select(
        _block_of(F.col("doc_id"), n_blocks).alias("block"), "doc_id"
    )
    sent = stage(_block_grams(blocks, training), "kn-grams")
    free_shuffles(spark)
    summed = stage(sent.groupBy("gram").agg(F.sum("c").alias("a")), "kn-counts")
    model = probabilities(summed.select("gram"), summed.where("a > 0"))
    free_shuffles(spark)
    logs = sent.select("block", "gram").join(model, "gram").select("block", "gram", F.log("p").alias("log_p"))
    perplexity = F.when(F.col("n_bytes") > 0, F.exp(-F.col("log_p") / F.col("n_bytes")))
    scored = stage(
        _score(blocks, logs).select(
            "doc_id", "lang", "n_bytes", perplexity.alias("perplexity"), F.exp(-F.col("worst")).alias("worst_perplexity")
        ),
        "kn-scores",
    )
    free_shuffles(spark)
    sample = scored.join(trusted.where(held_out(F.col("doc_id"))), "doc_id", "left_semi").where("perplexity IS NOT NULL")
    limits = {"perplexity": "threshold", "worst_perplexity": "worst_threshold"}
    at = [(F.percentile_approx(c, quantile, 10_000) * slack).alias(t) for c, t in limits.items()]
    by_lang = sample.groupBy("lang").agg(*at)
    overall = sample.agg(*at).first()
    limit = [F.coalesce(F.col(f"t.{t}"), F.lit(overall[t]).cast("double")).alias(t) for t in limits.values()]
    passed = [F.coalesce(F.col(c) <= F.col(t), F.lit(True)) for c, t in limits.items()]
    return (
        scored.alias("s")
        .join(by_lang.alias("t"), F.col("s.lang").eqNullSafe(F.col("t.lang")), "left")
        .select("s.*", *limit)
        .withColumn("kept", F.col("perplexity").isNotNull() & passed[0] & passed[1])
        .select("doc_id", "lang", "n_bytes", "perplexity", "threshold", "kept", "worst_perplexity", "worst_threshold")
    )
