"""Column naming and parsing helpers for normalised tables."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def snake(name: str) -> str:
    """``createdAt`` -> ``created_at``, ``avatarUrl`` -> ``avatar_url``."""
    return _CAMEL.sub("_", name).lower()


def flat_columns(struct_col: str, struct_type: StructType, prefix: str | None = None) -> list[Column]:
    """PRJ-3: a struct column as ``parent__field`` columns, snake-cased.

    ``author`` with ``login, avatarUrl`` gives ``author__login``,
    ``author__avatar_url``. Nested structs recurse with another ``__``.
    """
    prefix = snake(prefix if prefix is not None else struct_col.split(".")[-1])
    out: list[Column] = []
    for f in struct_type.fields:
        path = f"{struct_col}.{f.name}"
        name = f"{prefix}__{snake(f.name)}"
        if isinstance(f.dataType, StructType):
            out.extend(flat_columns(path, f.dataType, name))
        else:
            out.append(F.col(path).alias(name))
    return out


def utc_timestamp(text: Column) -> Column:
    """ISO-8601 text (``...Z`` or with an offset) as a UTC TIMESTAMP_NTZ.

    The API writes UTC with a ``Z`` suffix; that wall-clock time is the answer
    and is parsed directly. Any other offset takes the general path: the
    instant is parsed with its zone, shown as wall-clock time in the session
    zone, then moved to UTC. Neither depends on the session setting.
    """
    general = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.to_timestamp(text).cast("timestamp_ntz"))
    return F.when(text.endswith("Z"), F.to_timestamp_ntz(text)).otherwise(general)


def readable_timestamp(text: Column) -> Column:
    """``utc_timestamp``, but null for a text that is not a time."""
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(text.endswith("Z"), text.try_cast("timestamp_ntz")).otherwise(zoned)


def iso_text(ts_ntz: Column) -> Column:
    """A UTC TIMESTAMP_NTZ rendered the way the API sends it, microseconds kept."""
    return F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
