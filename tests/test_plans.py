"""Scale rules checked on the physical plans of every registered query."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tools.catalog import QUERIES

SF = "/root/testdata/sf0.001"

FORBIDDEN = (
    "CartesianProduct",  # no cross joins
    "BroadcastNestedLoopJoin",  # no non-equi / nested-loop joins
    "BatchEvalPython",  # no row-at-a-time Python UDFs
    "ArrowEvalPython",  # no Python at all: everything is built in
    "FlatMapGroupsInPandas",
)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forbidden_operators(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert not [op for op in FORBIDDEN if op in plan]


def test_stand_in_filters_reach_the_scan(spark):
    plan = _plan(QUERIES["top_comment_authors"](spark, SF))
    import re

    pushed = re.findall(r"PushedFilters: \[In\(event_type, \[([a-z,]+)\]\)\]", plan)
    assert sorted(",".join(sorted(p.split(","))) for p in pushed) == ["click,error", "purchase,signup,view"]
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_aggregates_are_partial_before_the_shuffle(spark):
    plan = _plan(QUERIES["team_performance_summary"](spark, SF))
    assert "partial_count(1)" in plan and "partial_avg(" in plan


def test_no_list_is_gathered_from_a_whole_parent(spark):
    """Nesting groups by list part, and no window orders all rows of a parent."""
    from tools import fixture_pages as fx

    plan = _plan(fx.conversation_pages(spark, SF))
    assert "keys=[conv_id" in plan and "list_offset" in plan
    windows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert windows and all("_block" in line for line in windows)


def test_hot_user_is_split_in_the_activity_product(spark):
    """80% of the tickets on one key: the child join is a skew join, nothing is lost."""
    from quarry.operators.pairs import outer_product_by_key

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "16",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        parent = spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("p"), "id").alias("p"))
        hot = F.when(F.col("id") % 5 < 4, 7).otherwise(F.col("id") % 200)
        a = spark.range(0, 100_000, 1, 8).select(hot.alias("k"), F.md5(F.col("id").cast("string")).alias("a"))
        b = spark.range(100).select((F.col("id") * 2 + 1).alias("k"), F.col("id").alias("b"))
        out = outer_product_by_key(parent, a, b, "k", "k", "k")
        n = out.select(F.count("a").alias("n"))
        assert n.first().n == 100_000
        n.collect()
        assert "skew=true" in n._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_equal_rows_spread_over_the_bands(spark):
    from quarry.operators.pairs import outer_product_by_key

    parent = spark.range(1).select(F.col("id").alias("k"))
    a = spark.range(0, 1000, 1, 4).select(F.lit(0).cast("long").alias("k"), F.lit("same").alias("a"))
    b = spark.range(0, 10).select(F.lit(0).cast("long").alias("k"), F.lit("too").alias("b"))
    assert outer_product_by_key(parent, a, b, "k", "k", "k", cell_rows=100).count() == 10_000


def test_exploded_children_do_not_carry_their_parent_list(spark):
    """Each comment row must not keep the whole item (and its list): that
    makes exploding k comments cost O(k^2) bytes."""
    from quarry.operators import normalize as nz
    from tools import fixture_pages as fx

    plan = _plan(nz.comments(fx.conversation_pages(spark, SF), "issues"))
    generates = [line for line in plan.splitlines() if "Generate posexplode(_list" in line]
    assert generates and all("item#" not in line for line in generates)


def test_lists_are_built_behind_the_last_shuffle(spark):
    """Landed pages and bundles: rows are shuffled flat, no gathered list is."""
    from tools import fixture_pages as fx

    for build in (fx.conversation_pages, fx.event_comment_pages, fx.comment_bundles):
        lines = _plan(build(spark, SF)).splitlines()
        first_shuffle = next(k for k, line in enumerate(lines) if "Exchange " in line)
        gathered = [k for k, line in enumerate(lines) if "collect_list(" in line]
        assert gathered and max(gathered) < first_shuffle


def test_reactions_are_shuffled_once_to_their_comments(spark):
    from quarry.operators import normalize as nz

    groups = "reaction_groups array<struct<content:string,createdAt:string>>"
    comments = spark.createDataFrame([("c1", None)], f"id string, {groups}")
    node = "struct<id:string,reactions:struct<totalCount:bigint,nodes:array<string>>>"
    bundles = spark.createDataFrame([(1, {"n": ("c1", (1, ["x"]))})], f"request_no int, data map<string,{node}>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        attached = nz.attach_reactions(comments, nz.bundle_nodes(bundles))
        assert _plan(attached).count("Exchange ") == 2
        assert [(r.id, r.reactions_total_count) for r in attached.collect()] == [("c1", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
