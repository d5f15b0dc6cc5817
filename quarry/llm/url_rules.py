"""URL rules by a sort-merge range join.

A host is written with its labels reversed and a dot after each, so the keys of
a host and all its subdomains share a prefix: a rule's host becomes one
interval of the sorted keys. Pages and rule intervals are cut into the same key
ranges, sorted together, and swept once; the sweep keeps a stack of the rules'
hosts whose intervals are open (they nest, as prefixes do) and asks each for
its longest fitting path.

Key ranges are cut at quantiles of a bounded sample of page keys with a hash of
the row added, so that even one url that holds most rows is split. A rule goes
to every range that its interval meets. Nothing but the sampled keys (about
``SAMPLE_KEYS``, whatever the number of pages) reaches the driver.

Defined results: a null url or one without ``://`` has empty host and path and
fits no rule; the longest rule (host and path together) wins, a longer host
before a shorter one, block before allow; a page that no rule fits gets the
default verdict. Repeated rows are judged each.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import hash_sample

DEFAULT_VERDICT = "allow"
SAMPLE_KEYS = 20_000
RANGES_PER_PARTITION = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``a.b.c`` as ``c.b.a.``; an empty host has an empty key."""
    dotted = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    return F.when(host == "", F.lit("")).otherwise(dotted)


def _key_bytes(key: str, path: str) -> bytes:
    return (key + path).encode("utf-8", "surrogatepass")


class Sweep:
    """Open rule hosts, innermost last, while sorted rows go by."""

    def __init__(self) -> None:
        self.open: list[tuple[str, dict[str, tuple[str, str]]]] = []

    def close_before(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def add_rule(self, key: str, host: str, path: str, action: str) -> None:
        self.close_before(key)
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, {}))
        paths = self.open[-1][1]
        if paths.get(path, ("", ""))[0] != "block":
            paths[path] = (action, host + path)

    def judge(self, key: str, path: str) -> tuple[str, str] | None:
        self.close_before(key)
        best, rank = None, (-1, -1)
        for host, paths in self.open:
            for size in sorted({len(p) for p in paths if len(p) <= len(path)}, reverse=True):
                hit = paths.get(path[:size])
                if hit:
                    if (len(hit[1]), len(host)) > rank:
                        best, rank = hit, (len(hit[1]), len(host))
                    break
        return best


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT,
    id_col: str = "page_id", url_col: str = "url", sample_keys: int = SAMPLE_KEYS,
) -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``.

    ``rules`` has ``host``, ``path`` and ``action`` (allow or block).
    """
    spark = pages.sparkSession
    url = F.col(url_col)
    id_type = pages.schema[id_col].dataType.simpleString()
    keyed = pages.select(
        F.lit(1).alias("kind"),
        F.col(id_col).alias("id"),
        url_host(url).alias("host"),
        url_path(url).alias("path"),
        F.lit("").alias("action"),
        F.abs(F.xxhash64(id_col, url_col) % 1_000_000_007).alias("salt"),
    ).withColumn("key", host_key(F.col("host")))
    ruled = rules.select(
        F.lit(0).alias("kind"),
        F.lit(None).cast(id_type).alias("id"),
        F.translate("host", _UPPER, _LOWER).alias("host"),
        "path",
        "action",
        F.lit(0).cast("long").alias("salt"),
    ).withColumn("key", host_key(F.col("host")))

    parts = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = hash_sample(keyed, sample_keys, pages.count(), F.xxhash64(F.lit("sample"), "id", "host", "path"))
    sample = picked.select("key", "path", "salt").collect()
    points = sorted((_key_bytes(r.key, r.path), r.salt) for r in sample)
    cuts = [points[k * len(points) // parts] for k in range(1, parts)] if points else []
    fields = "kind int, id {0}, host string, path string, action string, salt long, key string".format(id_type)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, to = [], []
            kinds, keys, paths, salts = (batch.column(c).to_pylist() for c in ("kind", "key", "path", "salt"))
            for k, (kind, key, path, salt) in enumerate(zip(kinds, keys, paths, salts)):
                if kind:
                    rows.append(k)
                    to.append(bisect_right(cuts, (_key_bytes(key, path), salt)))
                else:
                    low = key.encode("utf-8", "surrogatepass")
                    first, last = bisect_left(cuts, (low, -1)), bisect_right(cuts, (low + b"\xff", 0))
                    rows += [k] * (last - first + 1)
                    to += range(first, last + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), *(c.take(pa.array(rows, pa.int64())) for c in batch.columns)],
                ["part", *batch.schema.names],
            )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = None, Sweep()
        for batch in batches:
            names = ("part", "kind", "host", "path", "action", "key")
            out, rows = [], []
            for k, (p, kind, host, path, action, key) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
                if p != part:
                    part, state = p, Sweep()
                if kind:
                    out.append(state.judge(key, path))
                    rows.append(k)
                else:
                    state.add_rule(key, host, path, action)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(at) for c in ("id", "host", "path")),
                    pa.array([o and o[1] for o in out], pa.string()),
                    pa.array([o[0] if o else default for o in out], pa.string()),
                ],
                ["id", "host", "path", "rule", "verdict"],
            )

    placed = keyed.unionByName(ruled).mapInArrow(place, f"part int, {fields}")
    ordered = placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    # A rule's key is a prefix of the keys it covers, so it sorts before them.
    ordered = ordered.sortWithinPartitions("part", "key", "kind", "path", "salt")
    judged = ordered.mapInArrow(sweep, f"id {id_type}, host string, path string, rule string, verdict string")
    return judged.withColumnRenamed("id", id_col)
