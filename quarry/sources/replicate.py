"""Full-refresh copy of a set of relational tables (SRC-6 + SNK-6).

A replication spec names streams (``schema.table``) with optional per-stream
options over shared defaults, and a target name template
(``{stream_schema}_{stream_table}``). Each stream is read in parallel — JDBC
split into range queries, or Parquet — and replaces its target table; all targets
are swapped by one commit. Nothing is staged on the driver.

A range read is cut either by a number between its least and greatest value
(``partition_column``), or by columns of any type and distribution (``split_by``: uuid,
text, time, skewed numbers) at bounds that the database finds in their order, the same
number of rows apart.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sinks.warehouse import Warehouse

Reader = Callable[[str, dict], DataFrame]

ROWS_PER_QUERY = 1_000_000
FETCH_SIZE = 10_000


@dataclass
class ReplicationSpec:
    streams: dict[str, dict | None]
    defaults: dict = field(default_factory=lambda: {"mode": "full-refresh", "object": "{stream_schema}_{stream_table}"})

    def options(self, stream: str) -> dict:
        merged = dict(self.defaults)
        merged.update(self.streams.get(stream) or {})
        return merged

    @staticmethod
    def target(template: str, stream: str) -> str:
        schema, _, table = stream.rpartition(".")
        return template.format(stream_schema=schema or "public", stream_table=table)


# Rows of the split columns, numbered in their order, for the database to cut at.
NUMBERED = "SELECT {columns}, ROW_NUMBER() OVER (ORDER BY {columns}) AS rn FROM {table} WHERE {present}"


def sql_literal(value) -> str:
    """A bound as SQL text (times in the escapes that every JDBC driver knows)."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        return "'" + str(value).replace("'", "''") + "'"
    return str(value)


def _before(columns: list[str], bound: tuple) -> str:
    """Rows before ``bound`` in the columns' order; rows that lack a value come first."""
    own, rest = columns[0], columns[1:]
    value = sql_literal(bound[0])
    less = f"{own} IS NULL OR {own} < {value}"
    return f"({less} OR ({own} = {value} AND {_before(rest, bound[1:])}))" if rest else f"({less})"


def _from(columns: list[str], bound: tuple) -> str:
    """All other rows: at ``bound`` or behind it."""
    own, rest = columns[0], columns[1:]
    value = sql_literal(bound[0])
    if not rest:
        return f"({own} >= {value})"
    return f"({own} > {value} OR ({own} = {value} AND {_from(rest, bound[1:])}))"


def range_predicates(columns: list[str], bounds: list[tuple]) -> list[str]:
    """Conditions that deal every row, whatever it lacks, to exactly one range."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{_from(columns, a)} AND {_before(columns, b)}" for a, b in zip(bounds, bounds[1:])]
    return [_before(columns, bounds[0]), *inner, _from(columns, bounds[-1])]


def equal_bounds(
    spark: SparkSession, url: str, table: str, columns: list[str], rows_per_query: int, properties: dict,
    numbered: str = NUMBERED,
) -> list[tuple]:
    """Values of ``columns`` every ``rows_per_query`` rows of their order, asked of the
    database: as many values as there are range queries reach the driver."""
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    listed = ", ".join(columns)
    rows = numbered.format(columns=listed, table=table, present=present)
    asked = f"(SELECT {listed}, rn FROM ({rows}) n WHERE MOD(rn, {rows_per_query}) = 0) b"
    found = spark.read.jdbc(url, asked, properties=properties).collect()
    # The database's order, not the driver's: text may be collated there.
    ordered = [tuple(r)[:-1] for r in sorted(found, key=lambda r: r[len(columns)])]
    return [b for k, b in enumerate(ordered) if k == 0 or b != ordered[k - 1]]


def jdbc_reader(
    spark: SparkSession,
    url: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    rows_per_query: int = ROWS_PER_QUERY,
    numbered: str = NUMBERED,
) -> Reader:
    """Reads ``schema.table`` over JDBC as parallel range queries.

    With ``split_by`` (a stream's option: one or more columns) the ranges hold about
    ``rows_per_query`` rows each, whatever the columns' types and values are. If one value
    of the first column is that of many rows, name a second one that tells them apart,
    such as the key: rows of equal values in all the columns stay together. ``numbered``
    is the database's way to number ordered rows, if not the standard one.

    Else a numeric column must be named (``partition_column``, or the stream's option of
    that name): without one a table of any size would be one task. One query
    pushed to the database gives its bounds and the row count, from which the
    number of ranges follows, about ``rows_per_query`` rows each. The bounds only
    spread the work: rows outside them, or without a value, still land in the
    first or last range.
    """
    props = {"fetchsize": str(FETCH_SIZE), **(properties or {})}

    def read(stream: str, options: dict) -> DataFrame:
        split_by = options.get("split_by")
        if split_by:
            columns = [split_by] if isinstance(split_by, str) else list(split_by)
            bounds = equal_bounds(spark, url, stream, columns, rows_per_query, props, numbered)
            return spark.read.jdbc(url, stream, predicates=range_predicates(columns, bounds), properties=props)
        column = options.get("partition_column", partition_column)
        if not column:
            raise ValueError(f"{stream}: name a numeric partition_column, or split_by, to read it in parallel")
        bounds = spark.read.jdbc(
            url,
            f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n FROM {stream}) b",
            properties=props,
        ).first()
        if bounds[0] is None:  # no value to cut at: at most rows without one
            return spark.read.jdbc(url, stream, properties=props)
        lo, hi = int(bounds[0]), int(bounds[1])
        return spark.read.jdbc(
            url,
            stream,
            column=column,
            lowerBound=lo,
            upperBound=hi + 1,
            numPartitions=max(1, min(-(-int(bounds[2]) // rows_per_query), hi - lo + 1)),
            properties=props,
        )

    return read


def parquet_reader(spark: SparkSession, root: str) -> Reader:
    """Reads ``schema.table`` from ``<root>/<schema>/<table>`` Parquet folders."""

    def read(stream: str, options: dict) -> DataFrame:
        schema, _, table = stream.rpartition(".")
        return spark.read.parquet(f"{root.rstrip('/')}/{schema}/{table}")

    return read


def content_hash(df: DataFrame) -> DataFrame:
    """One row: ``content_hash``, the sum of a digest of each row, whatever their order.

    Values are hashed as text: times to the microsecond, fractions to six places.
    """

    def text(f) -> Column:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind in ("float", "double"):
            c = c.cast("decimal(38,6)")
        return F.coalesce(c.cast("string"), F.lit("~"))

    digest = F.md5(F.concat_ws("|", *(text(f) for f in sorted(df.schema.fields, key=lambda f: f.name))))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("content_hash"))


def replicate(spec: ReplicationSpec, reader: Reader, warehouse: Warehouse, database: str = "main") -> DataFrame:
    """Copy every stream; return one row per target: name, rows, columns, content hash.

    All targets are swapped by one commit. Rows were counted while they were written;
    the hash reads the written tables when the summary is read.
    """
    targets = []
    with warehouse.commit(database) as writing:
        for stream in spec.streams:
            opts = spec.options(stream)
            if opts.get("mode", "full-refresh") != "full-refresh":
                raise ValueError(f"unsupported replication mode {opts.get('mode')!r} for {stream}")
            target = ReplicationSpec.target(opts["object"], stream)
            writing.replace_table(reader(stream, opts), target)
            targets.append(target)
    return reduce(DataFrame.unionByName, [_summary(warehouse, database, t) for t in targets])


def _summary(warehouse: Warehouse, database: str, target: str) -> DataFrame:
    kept = warehouse.statistics(database, target).first()
    return content_hash(warehouse.table(database, target)).select(
        F.lit(target).alias("table_name"),
        F.lit(kept.num_rows).cast("long").alias("num_rows"),
        F.lit(kept.column_count).alias("column_count"),
        "content_hash",
    )
