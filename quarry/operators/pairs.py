"""Skew-safe left-outer expansion of two one-to-many children per key.

``parent LEFT JOIN a ON key LEFT JOIN b ON key`` returns, for every parent row,
the product of its ``a`` rows and its ``b`` rows (one NULL row stands in for an
empty side). Written as two chained sort-merge joins, one hot key puts all of
its ``a`` rows, all of its ``b`` rows and the whole ``|a| x |b|`` output into a
single task, and AQE cannot split the right side of a left outer join.

The plan here keeps the exact result and bounds every task:

1. Per-key counts of both children are partial aggregates (map-side combine),
   so a hot key costs nothing extra to count.
2. The per-key sizes are staged as Parquet, so each child meets them in an
   *inner* join whose two sides are plain exchanges: AQE then splits a hot key.
3. The product of a key's children is laid out on a grid: ``a`` rows hash into
   ``ceil(n_a / cell)`` row bands, ``b`` rows into ``ceil(n_b / cell)`` column
   bands; each ``a`` row is copied once per column band and each ``b`` row once
   per row band, and the pair join runs on ``(key, band_a, band_b)``. Every
   pair meets in exactly one cell and a cell holds about ``cell`` rows of each
   side. A key with at most ``cell`` rows on each side is not copied at all.
4. Parents with an empty side ride the same join as a NULL-padded row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sinks.staging import stage_parquet

# Rows of each side that share one grid cell; a cell yields at most cell**2
# pairs. 2,000 keeps a cell's output near four million narrow rows.
DEFAULT_CELL_ROWS = 2000


def _band(n: Column, cell: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / F.lit(cell))).cast("long")


def _row_hash(cols: list[str]) -> Column:
    """Hash of a row with its tag, so that equal rows spread over the bands too."""
    return F.xxhash64(*cols, "_tag")


def _null_columns(df: DataFrame, names: list[str]) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [F.lit(None).cast(types[n]).alias(n) for n in names]


def outer_product_by_key(
    parent: DataFrame,
    a: DataFrame,
    b: DataFrame,
    key: str,
    a_key: str,
    b_key: str,
    cell_rows: int = DEFAULT_CELL_ROWS,
) -> DataFrame:
    """``parent ⟕ a ON parent[key] = a[a_key] ⟕ b ON parent[key] = b[b_key]``.

    ``parent`` may repeat a key (each copy gets the full product) and may hold
    NULL keys (kept once, both sides NULL). Columns of ``a`` and ``b`` other
    than their key columns must not collide with each other or with
    ``parent``'s. The output has parent columns, then ``a``'s, then ``b``'s.

    Plan: the left side holds every ``a`` row with its parent columns, plus one
    row with NULL ``a`` columns for each parent without ``a`` rows; the right
    side holds the ``b`` rows. Both are laid out on the key's grid and meet in
    one left join on ``(key, band_a, band_b)``. A left row that finds no ``b``
    in its cell is kept only when its key has no ``b`` rows at all; otherwise
    its pairs are made in other cells. So every pair is made exactly once and
    keys without ``b`` rows keep their NULL-padded row.
    """
    parent_cols = parent.columns
    a_cols = [c for c in a.columns if c != a_key]
    b_cols = [c for c in b.columns if c != b_key]
    out_cols = parent_cols + a_cols + b_cols

    # The tag is given where the child is read, before any shuffle, so a task that
    # runs again gives the same one.
    tag = F.monotonically_increasing_id()
    a_rows = a.withColumn("_tag", tag).withColumnRenamed(a_key, key).where(F.col(key).isNotNull())
    b_rows = b.withColumn("_tag", tag).withColumnRenamed(b_key, key).where(F.col(key).isNotNull())

    # per-key sizes: partial + final aggregates, one row per key
    a_n = a_rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n_a"))
    b_n = b_rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n_b"))

    # NULL-key parents match nothing: they pass straight through.
    null_parents = parent.where(F.col(key).isNull()).select(
        *parent_cols, *_null_columns(a_rows, a_cols), *_null_columns(b_rows, b_cols)
    )
    sized = stage_parquet(
        parent.where(F.col(key).isNotNull())
        .join(a_n, key, "left")
        .join(b_n, key, "left")
        .withColumn("_n_a", F.coalesce(F.col("_n_a"), F.lit(0)))
        .withColumn("_n_b", F.coalesce(F.col("_n_b"), F.lit(0))),
        "pair_parents",
    )

    # left side: a rows with parent columns (inner join, AQE may split a hot
    # key), plus the parents that have no a rows
    with_a = a_rows.join(sized, key).select(*parent_cols, *a_cols, "_n_a", "_n_b", "_tag")
    without_a = sized.where(F.col("_n_a") == 0).select(
        *parent_cols, *_null_columns(a_rows, a_cols), "_n_a", "_n_b", F.lit(0).cast("long").alias("_tag")
    )
    left = (
        with_a.unionByName(without_a)
        .withColumn("_band_a", F.pmod(_row_hash(a_cols), _band(F.col("_n_a"), cell_rows)))
        .withColumn("_band_b", F.explode(F.sequence(F.lit(0).cast("long"), _band(F.col("_n_b"), cell_rows) - 1)))
    )

    # right side: b rows of keys that have b rows, copied over the a bands
    key_sizes = stage_parquet(
        b_n.join(a_n, key, "left").withColumn("_n_a", F.coalesce(F.col("_n_a"), F.lit(0))), "pair_sizes"
    )
    right = (
        b_rows.join(key_sizes, key)
        .withColumn("_band_b", F.pmod(_row_hash(b_cols), _band(F.col("_n_b"), cell_rows)))
        .withColumn("_band_a", F.explode(F.sequence(F.lit(0).cast("long"), _band(F.col("_n_a"), cell_rows) - 1)))
        .select(key, "_band_a", "_band_b", *b_cols, F.lit(True).alias("_hit"))
    )

    joined = left.join(right, [key, "_band_a", "_band_b"], "left")
    paired = joined.where(F.col("_hit").isNotNull() | (F.col("_n_b") == 0)).select(*out_cols)
    return paired.unionByName(null_parents)
