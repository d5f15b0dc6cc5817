"""Mixing sources to target weights by capped water-filling.

Every source gets words in proportion to its weight, but never more than
``max_epochs`` times its size; what a full source cannot take is shared again
among the others by weight, until no target is above its cap. The mix has as
many words as the input.

Each document is then repeated ``floor(rate)`` whole times (rate = target over
source size), and the fractional repetition goes to a seeded sample of whole
documents: those whose seeded hash is at most the source's threshold. The
threshold is found exactly, so that a source's taken words miss its target by
less than one document: a histogram over hash buckets (pre-aggregated before
the shuffle) names the bucket in which the target is crossed, and only that
bucket's rows are put in order.

Only two numbers per round of the filling reach the driver. Sources (one row
each) are joined back by Catalyst's choice; no document row is shuffled on its
source unless the source table is too large to broadcast, and then the join is
a plain one that adaptive execution splits when a source is hot.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a document of size 0 takes 0 words; repeated rows with equal id
and text share one hash and are taken alike; an empty table gives no rows.
Other columns stay inside ``row`` and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20240601
HASH_BITS = 60
BUCKET_BITS = 12


def seeded_hash(seed: int, id_col: str, text_col: str) -> Column:
    """60 bits of an MD5 of seed, id and text: uniform, and portable to other engines."""
    parts = [F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col))]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``sizes`` (source, source_size) with ``weight`` and ``target``.

    Weights repeat over the sources in code-point order, null last. The window
    that numbers them has one row per source.
    """
    n = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    cycle = F.array(*map(F.lit, weights))
    weighted = stage(
        sizes.withColumn("weight", F.element_at(cycle, (n % len(weights) + 1).cast("int")))
        .withColumn("cap", max_epochs * F.col("source_size")),
        "mix-sources",
    )
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        capped, open_weight = weighted.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        raised = (total - capped) / open_weight if open_weight else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("cap").cast("double"), F.lit(float(level)) * F.col("weight"))
    return weighted.withColumn("target", target)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per input row: ``row`` (all its columns), ``size``, ``source_size``,
    ``target`` (of its source), ``copies`` and ``taken`` (copies times size)."""
    sized = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        seeded_hash(seed, id_col, text_col).alias("h"),
    )
    bucket = F.shiftright("h", HASH_BITS - BUCKET_BITS)
    buckets = stage(
        sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "mix-buckets"
    )
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = stage(
        targets.withColumn("whole", F.floor(rate).cast("long"))
        .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
        .drop("cap", "weight"),
        "mix-targets",
    )

    # The bucket in which a source's extra words are reached.
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    running = buckets.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    crossed = (
        running.alias("b")
        .join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
        .where((F.col("before") < F.col("extra")) & (F.col("before") + F.col("words") >= F.col("extra")))
        .select("p.*", "bucket", "before")
    )
    # Inside it, the last document whose middle is not past the target.
    inside = (
        sized.select("source", "size", "h")
        .alias("d")
        .join(
            crossed.alias("c"),
            F.col("d.source").eqNullSafe(F.col("c.source")) & (bucket == F.col("c.bucket")),
        )
        .select("c.source", "d.size", "d.h", "c.before", "c.extra", "c.bucket")
    )
    same_or_lower = Window.partitionBy("source").orderBy("h").rangeBetween(Window.unboundedPreceding, 0)
    lower = F.shiftleft("bucket", HASH_BITS - BUCKET_BITS) - 1
    threshold = (
        inside.withColumn("upto", F.col("before") + F.sum("size").over(same_or_lower))
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("upto") - F.col("size") / 2 <= F.col("extra"), F.col("h"))).alias("h_in"),
            F.min(lower).alias("h_low"),
        )
        .select("source", F.coalesce("h_in", "h_low").alias("h_max"))
    )
    rules = stage(
        plan.alias("p")
        .join(threshold.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")), "left")
        .select("p.*", F.coalesce("t.h_max", F.lit(-1)).alias("h_max")),
        "mix-rules",
    )
    copies = F.col("r.whole") + (F.col("h") <= F.col("r.h_max")).cast("long")
    return (
        sized.alias("d")
        .join(rules.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")))
        .select("row", "size", "source_size", "target", copies.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken, with its own columns."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.where("copies > 0").select("row", times.alias("copy")).select("row.*")
