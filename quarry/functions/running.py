"""Running totals that never put a whole group into one task.

A plain ``sum() OVER (PARTITION BY g ORDER BY o)`` sorts every row of ``g`` in
one task. Here rows are cut into blocks of ``block`` consecutive order values:
sums inside a block use a window over at most ``block`` rows, and the offset of
each block is a running sum over the (``block`` times fewer) block totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 1024


def exclusive_running(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    value_col: str,
    out_col: str,
    how: str = "sum",
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Add ``out_col`` = sum (or max) of ``value_col`` over earlier rows of the group.

    "Earlier" is a smaller integer ``order_col``; order values are expected to
    be unique within a group (page numbers, pull numbers). A row with no
    earlier rows gets 0 for a sum and NULL for a max.
    """
    agg = {"sum": F.sum, "max": F.max}[how]
    with_block = df.withColumn("_blk", F.floor(F.col(order_col) / block))
    inner = Window.partitionBy(*group_cols, "_blk").orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = with_block.withColumn("_in_blk", agg(value_col).over(inner))

    totals = with_block.groupBy(*group_cols, "_blk").agg(agg(value_col).alias("_blk_agg"))
    outer = Window.partitionBy(*group_cols).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group_cols, "_blk", agg("_blk_agg").over(outer).alias("_blk_off"))
    joined = local.join(offsets, [*group_cols, "_blk"])
    if how == "sum":
        value = (F.coalesce(F.col("_blk_off"), F.lit(0)) + F.coalesce(F.col("_in_blk"), F.lit(0))).cast("long")
    else:
        value = F.greatest(F.col("_blk_off"), F.col("_in_blk"))
    return joined.withColumn(out_col, value).drop("_blk", "_in_blk", "_blk_off")


def exclusive_running_sum(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    value_col: str,
    out_col: str,
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    return exclusive_running(df, group_cols, order_col, value_col, out_col, "sum", block)
