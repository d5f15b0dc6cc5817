"""Column expressions that reproduce the reference warehouse's cast rules.

The derived SQL was written for an engine whose casts differ from Spark's in
three places that change results (measured, see SURVEY §2.8):

* ``x::integer`` rounds to the nearest integer, ties to even, for doubles
  (Spark truncates);
* ``count::float / count::float`` stays 32-bit (Spark widens to double);
* ``DATE_TRUNC('day', ts)`` keeps a timestamp; the table contract says date.

All helpers are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StringType


def round_to_int(c: Column, source_type=DoubleType()) -> Column:
    """``c::integer`` with round-half-even for floating input.

    Doubles go through ``rint`` (ties to even). Decimals round half up, which
    is what the reference engine does for them. Text is read as a decimal
    first, so '2.7' becomes 3 instead of an ANSI cast error.
    """
    if isinstance(source_type, (DoubleType, FloatType)):
        return F.rint(c).cast("int")
    if isinstance(source_type, DecimalType):
        return F.round(c, 0).cast("int")
    if isinstance(source_type, StringType):
        return F.round(c.cast("decimal(38,10)"), 0).cast("int")
    return c.cast("int")


def float32(c: Column) -> Column:
    return c.cast("float")


def ratio32(num: Column, den: Column) -> Column:
    """32-bit quotient, as ``float / float`` gives in the reference engine."""
    return (num.cast("float") / den.cast("float")).cast("float")


def day_of(ts: Column) -> Column:
    """``DATE_TRUNC('day', ts)`` cast to the declared ``date`` column type.

    For TIMESTAMP_NTZ input this is free of the session time zone.
    """
    return ts.cast("date")

