"""Staging: cut lineage by writing a DataFrame once as Parquet in the shared
checkpoint folder, then reading it back.

Unlike ``DataFrame.checkpoint()`` (serialized rows), a staged copy is columnar:
later reads prune columns, including nested ones, and push filters into the
scan. Use it where several outputs read the same expensive input, such as
parsed landed pages.

A row of nested data may hold thousands of elements, and a reader holds up to 4,096 rows
of a row group at a time. So with ``wide_rows`` the row groups are small, and their size is
looked at from the first row on: a task then holds a few pages, however many a file has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.session import scratch_path

SMALL_ROW_GROUPS = {"parquet.block.size": str(2 * 1024 * 1024), "parquet.page.size.row.check.min": "1"}


def stage_parquet(df: DataFrame, label: str, wide_rows: bool = False) -> DataFrame:
    path = scratch_path(df.sparkSession, "stage", label)
    df.write.mode("errorifexists").options(**(SMALL_ROW_GROUPS if wide_rows else {})).parquet(path)
    return df.sparkSession.read.parquet(path)
