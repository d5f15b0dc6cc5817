"""ARR-4: packed JSON to tables, down to a level.

The record is level 0; going into an object or a list is one level more. Down to
``max_level`` objects become columns (``payload__comment__id``) and lists child tables
(``<table>__payload__commits``) that carry the record's key and their place in the list;
what lies deeper stays packed as JSON text. A list of plain values gives a child table
with one column ``value``.

What is in the data is found by the data: one aggregate (``schema_of_variant_agg``)
gives the types of all keys, per kind of record; nothing but that schema reaches the
driver. Numbers are ``bigint`` where all are whole, else ``double``; a key whose values
are of different kinds stays packed; a key that only holds nulls has no column. Text
that is not JSON stays in ``<column>__unparsed``.

Unpacking is narrow: each table is one scan of the packed column, and each list is
lifted before it is exploded, so a child row does not carry its record.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DecimalType, DoubleType, FloatType, IntegralType, NullType, StringType, StructType,
)

from quarry.functions.naming import snake

PLAIN = {"bigint": IntegralType, "double": (DecimalType, DoubleType, FloatType), "boolean": BooleanType, "string": StringType}


@dataclass(frozen=True)
class Leaf:
    """A column: its name, path and type (None: packed JSON text)."""

    name: str
    path: tuple[str, ...]
    type: str | None


@dataclass
class Table:
    """A table found in packed records: its columns, and its lists as tables of their own."""

    name: str
    leaves: list[Leaf] = field(default_factory=list)
    lists: list[tuple[tuple[str, ...], Table]] = field(default_factory=list)


def variant_types(described: str | None) -> DataType:
    """The type that ``schema_of_variant`` describes, as a Spark type."""
    if described is None:
        return NullType()
    # Quoted names first: an OBJECT inside one is no type.
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), described)
    return DataType.fromDDL(ddl)


def found_types(rows: DataFrame, column: str, kind: str | None = None) -> dict[object, DataType]:
    """The types in a packed column for each value of ``kind`` (one entry None without it)."""
    variant = F.try_parse_json(F.col(column))
    keys = [F.col(kind).alias("kind")] if kind else [F.lit(None).cast("string").alias("kind")]
    found = rows.select(*keys, variant.alias("v")).groupBy("kind").agg(F.schema_of_variant_agg("v").alias("types"))
    return {r.kind: variant_types(r.types) for r in found.collect()}


def _plain(t: DataType) -> str | None:
    return next((name for name, kind in PLAIN.items() if isinstance(t, kind)), None)


def layout(t: DataType, name: str, column: str, max_level: int = 2) -> Table:
    """The tables that a packed column of type ``t`` unpacks to. The column itself is
    level 1."""
    table = Table(name)
    taken: set[str] = set()

    def add(t: DataType, names: tuple[str, ...], path: tuple[str, ...], level: int, into: Table) -> None:
        if isinstance(t, NullType):
            return
        if isinstance(t, StructType) and t.fields and level <= max_level:
            for f in t.fields:
                add(f.dataType, (*names, snake(f.name)), (*path, f.name), level + 1, into)
        elif isinstance(t, ArrayType) and level <= max_level:
            child = Table("__".join((into.name, *names)))
            into.lists.append((path, child))
            if isinstance(t.elementType, (StructType, ArrayType)):
                own = () if isinstance(t.elementType, StructType) else ("list",)
                add(t.elementType, own, (), level + 1 if own else level, child)
            elif not isinstance(t.elementType, NullType):
                child.leaves.append(Leaf("value", (), _plain(t.elementType)))
        else:
            label = "__".join(names) or "value"
            while (into.name, label) in taken:  # two keys of one name in snake case
                label += "_"
            taken.add((into.name, label))
            into.leaves.append(Leaf(label, path, _plain(t)))

    add(t, (column,), (), 1, table)
    return table


def _at(v: str, path: tuple[str, ...], kind: str) -> Column:
    if not path:
        return F.try_variant_get(F.col(v), "$", kind)
    steps = "".join(f"['{p}']" if "'" not in p else f'["{p}"]' for p in path)
    return F.try_variant_get(F.col(v), "$" + steps, kind)


def _column(v: str, leaf: Leaf) -> Column:
    value = F.to_json(_at(v, leaf.path, "variant")) if leaf.type is None else _at(v, leaf.path, leaf.type)
    return value.alias(leaf.name)


def tables_of(rows: DataFrame, keys: list[str], table: Table, v: str = "_v", level: int = 0) -> dict[str, DataFrame]:
    """The table of ``rows`` (which hold a variant ``v``) and its child tables. A child's
    rows have the keys of their record, ``list_idx`` (``list_idx_2`` for a list inside
    a list's elements) and their columns."""
    others = [c for c in rows.columns if c != v]
    out = {table.name: rows.select(*others, *(_column(v, leaf) for leaf in table.leaves))}
    for path, child in table.lists:
        idx = "list_idx" if level == 0 else f"list_idx_{level + 1}"
        lifted = rows.select(*keys, _at(v, path, "array<variant>").alias("_list"))
        exploded = lifted.select(*keys, F.posexplode("_list").alias(idx, v))
        out |= tables_of(exploded, [*keys, idx], child, v, level + 1)
    return out


def unpacked(
    rows: DataFrame, keys: list[str], name: str, column: str = "payload", max_level: int = 2,
    types: DataType | None = None,
) -> dict[str, DataFrame]:
    """``rows`` with the packed ``column`` unpacked, and a child table for each of its
    lists. ``types`` (of ``found_types``) saves the aggregate that finds them."""
    if types is None:
        types = next(iter(found_types(rows, column).values()), NullType())
    table = layout(types, name, column, max_level)
    parsed = rows.withColumn("_v", F.try_parse_json(F.col(column)))
    unparsed = F.when(F.col("_v").isNull(), F.col(column)).alias(f"{column}__unparsed")
    kept = [c for c in rows.columns if c != column]
    return tables_of(parsed.select(*kept, unparsed, "_v"), keys, table)
