"""An index of the ids of a stored table: Bloom filters by day, from built-in bitmaps.

Each load adds, for every day it stored ids of, one filter of about ``BITS_PER_ID``
bits an id, cut into buckets of 32,768 bits (the size of Spark's bitmap aggregates):
(day, run, n_bits, bucket, bits, layout). All ``HASHES`` bits of an id lie in one bucket.
Building is one partial aggregate over the stored ids; asking joins each asked id with
its one bucket of each filter of its own day. A filter of another layout than ours tells
nothing: all asked ids of its day are taken for stored. An id that is not stored is taken for stored in less than one of a thousand
cases; those few are then looked up in the table's folders of their days, so nothing
else of the table's history is ever read.

An id is looked for on its own day: a feed's event keeps its creation time.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 32_768
BITS_PER_ID = 16
HASHES = 5
SCHEMA = "day date, n_bits long, bucket long, bits binary, layout int"
LAYOUT = 2
#: Days are put as literals into the filters that prune folders, up to so many.
MOST_DAYS = 2_000


def _bucket(key: str, n_bits: Column) -> Column:
    """The bucket of an id's bits in a filter of ``n_bits``."""
    return F.pmod(F.xxhash64(F.lit(-1), F.col(key)), (n_bits / BUCKET_BITS).cast("long"))


def _bits(key: str) -> list[Column]:
    """The bits that stand for an id, inside its bucket."""
    return [F.pmod(F.xxhash64(F.lit(k), F.col(key)), F.lit(BUCKET_BITS).cast("long")) for k in range(HASHES)]


def filters_of(ids: DataFrame, key: str, day: str) -> DataFrame:
    """Filter buckets of (key, day) rows."""
    per_day = ids.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("_n"))
    powers = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") * BITS_PER_ID / BUCKET_BITS)))
    sized = per_day.select("day", (F.pow(F.lit(2.0), powers) * BUCKET_BITS).cast("long").alias("n_bits"))
    bits = (
        ids.select(F.col(key).alias("_key"), F.col(day).alias("day"))
        .join(sized, "day")
        .select("day", "n_bits", _bucket("_key", F.col("n_bits")).alias("bucket"), F.explode(F.array(*_bits("_key"))).alias("_bit"))
    )
    built = bits.groupBy("day", "n_bits", "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))
    return built.withColumn("layout", F.lit(LAYOUT))


def perhaps_stored(asked: DataFrame, key: str, day: str, index: DataFrame) -> DataFrame:
    """The (key, day) rows of ``asked`` that some filter of their day holds.

    ``index`` has the filters' columns and ``run``; a filter is one (day, run).
    """
    ours = F.col("layout").eqNullSafe(F.lit(LAYOUT))
    filters = index.where(ours).select("day", "run", "n_bits").distinct()
    ids = asked.select(F.col(key).alias("_key"), F.col(day).alias("day"))
    wanted = ids.join(filters, "day").select("_key", "day", "run", _bucket("_key", F.col("n_bits")).alias("bucket"))
    met = wanted.join(index.where(ours).select("day", "run", "bucket", "bits"), ["day", "run", "bucket"])
    held = met.where(reduce(lambda a, b: a & b, [_is_set(bit) for bit in _bits("_key")])).select("_key", "day")
    untold = ids.join(index.where(~ours).select("day").distinct(), "day", "left_semi")
    return held.unionByName(untold).select(F.col("_key").alias(key), F.col("day").alias(day)).distinct()


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def days_of(rows: DataFrame, day: str) -> list[dt.date] | None:
    """The days of ``rows`` (None, if there are too many to name)."""
    found = rows.select(day).distinct().limit(MOST_DAYS + 1).collect()
    return None if len(found) > MOST_DAYS else sorted(r[0] for r in found if r[0] is not None)


def on_days(rows: DataFrame, day: str, days: list[dt.date] | None) -> DataFrame:
    """Rows of those days: a filter on the folders."""
    return rows if days is None else rows.where(F.col(day).isin(days) if days else F.lit(False))
