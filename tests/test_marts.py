"""Edge cases of the six derived tables on toy rows."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.pairs import outer_product_by_key
from quarry.plans import marts

COMMENT_SCHEMA = "id string, author__login string, created_at timestamp_ntz"


def _comments(spark, rows):
    return spark.createDataFrame(rows, COMMENT_SCHEMA)


def test_top_comment_authors_counts_null_author_as_group(spark):
    t = dt.datetime(2024, 1, 1, 10)
    issues = _comments(spark, [("1", "a", t), ("2", None, t), ("3", None, t), ("4", "a", t)])
    prs = _comments(spark, [("5", "a", t)])
    out = marts.top_comment_authors(issues, prs).collect()
    assert [tuple(r) for r in out] == [("a", 2, "issue"), (None, 2, "issue"), ("a", 1, "pull_request")]


def test_top_comment_authors_union_forms_agree(spark):
    t = dt.datetime(2024, 1, 1, 10)
    issues = _comments(spark, [(str(i), f"u{i % 3}", t) for i in range(20)])
    prs = _comments(spark, [(str(i), f"u{i % 4}", t) for i in range(15)])

    def two_branch(df, tag):
        return df.groupBy(F.col("author__login").alias("username")).agg(
            F.count(F.lit(1)).alias("total_comments")
        ).withColumn("type", F.lit(tag))

    expected = two_branch(issues, "issue").unionByName(two_branch(prs, "pull_request"))
    got = marts.top_comment_authors(issues, prs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_comment_volume_by_day_is_a_date(spark):
    issues = _comments(
        spark,
        [("1", "a", dt.datetime(2024, 1, 1, 0, 0)), ("2", "b", dt.datetime(2024, 1, 1, 23, 59, 59, 999999))],
    )
    prs = _comments(spark, [("3", "a", dt.datetime(2024, 1, 2, 0, 0))])
    out = marts.comment_volume_by_day(issues, prs)
    assert dict(out.dtypes)["day"] == "date"
    assert [tuple(r) for r in out.collect()] == [
        (dt.date(2024, 1, 1), 2, "issue"),
        (dt.date(2024, 1, 2), 1, "pull_request"),
    ]


def test_avg_comment_length_empty_branch_keeps_its_row(spark):
    issues = spark.createDataFrame([("héllo",), ("ab",)], "body string")
    prs = spark.createDataFrame([], "body string")
    out = {r.type: r.avg_length for r in marts.avg_comment_length(issues, prs).collect()}
    assert out == {"issue": 3.5, "pull_request": None}


def test_team_performance_skips_nulls_in_averages_not_in_count(spark):
    tickets = spark.createDataFrame(
        [("t1", 10, None, 5), ("t1", 20, 100, None), ("t2", None, None, None)],
        "team_name string, seconds_to_first_reply long, seconds_to_last_close long, csat_rating long",
    )
    rows = {r.team_name: r for r in marts.team_performance_summary(tickets).collect()}
    assert rows["t1"].total_tickets == 2
    assert rows["t1"].avg_first_reply_secs == 15.0
    assert rows["t1"].avg_resolution_secs == 100.0
    assert rows["t1"].avg_csat == 5.0
    assert rows["t2"].total_tickets == 1 and rows["t2"].avg_csat is None
    # best CSAT first, NULL last
    assert [r.team_name for r in marts.team_performance_summary(tickets).collect()] == ["t1", "t2"]


def test_nps_rounds_half_to_even_and_keeps_first_twelve_groups(spark):
    rows = [(2.5, 10), (3.5, 0), (None, 9)]
    # months 0..14 present except 5: LIMIT 12 keeps the first twelve groups, so 13 is in
    rows += [(float(m), 9) for m in range(15) if m != 5]
    df = spark.createDataFrame(rows, "months_subscribed double, nps_response long")
    out = marts.nps_by_subscription_month(df).collect()
    months = [r.months_subscribed for r in out]
    assert months == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12]
    by_month = {r.months_subscribed: r.NPS for r in out}
    assert by_month[2] == 100.0  # 2.5 -> 2 (ties to even) joins month 2's promoter
    assert by_month[4] == 0.0  # 3.5 -> 4: one promoter, one detractor
    assert dict(marts.nps_by_subscription_month(df).dtypes) == {"months_subscribed": "int", "NPS": "float"}


@pytest.mark.parametrize("kind, want", [
    ("double", [2, 4, -2, None]),  # ties to even
    ("decimal(10,2)", [3, 4, -3, None]),  # ties away from zero
    ("string", [3, 4, -3, None]),  # text is read as a decimal
])
def test_months_round_by_their_type(spark, kind, want):
    texts = spark.createDataFrame([("2.5",), ("3.5",), ("-2.5",), (None,)], "m string")
    months = texts.select(F.col("m").cast(kind).alias("months_subscribed"), F.lit(10).alias("nps_response"))
    got = [r.months_subscribed for r in marts.nps_by_subscription_month(months).collect()]
    assert got == sorted((m for m in want if m is not None)) + [None]


def test_tables_come_in_their_order(spark):
    issues = _comments(spark, [("1", "a", dt.datetime(2024, 1, 2)), ("2", "a", dt.datetime(2024, 1, 1)), ("3", None, dt.datetime(2024, 1, 1))])
    prs = _comments(spark, [("4", "b", dt.datetime(2024, 1, 1))])
    top = marts.top_comment_authors(issues, prs).collect()
    assert [r.total_comments for r in top] == [2, 1, 1] and top[0].username == "a"
    days = marts.comment_volume_by_day(issues, prs).collect()
    assert [(r.day.day, r.type) for r in days] == [(1, "issue"), (1, "pull_request"), (2, "issue")]


def test_nps_null_score_counts_in_total_only(spark):
    df = spark.createDataFrame([(1.0, 10), (1.0, None), (1.0, 3), (1.0, 7)], "months_subscribed double, nps_response long")
    (row,) = marts.nps_by_subscription_month(df).collect()
    assert math.isclose(row.NPS, 0.0)
    df2 = spark.createDataFrame([(1.0, 10), (1.0, None)], "months_subscribed double, nps_response long")
    (row2,) = marts.nps_by_subscription_month(df2).collect()
    assert math.isclose(row2.NPS, 50.0)


# ---------------------------------------------------------------------------
# user activity: the skew-safe product equals the chained left joins


def _brute(parent, a, b):
    out = []
    for p in parent:
        key = p[0]
        a_rows = [r for r in a if key is not None and r[0] == key] or [(None, None)]
        b_rows = [r for r in b if key is not None and r[0] == key] or [(None, None)]
        for ar in a_rows:
            for br in b_rows:
                out.append((key, p[1], ar[1], br[1]))
    return sorted(out, key=repr)


keys = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    parent=st.lists(st.tuples(keys, st.text("xy", max_size=2)), max_size=6),
    a=st.lists(st.tuples(keys, st.integers(0, 50)), max_size=14),
    b=st.lists(st.tuples(keys, st.integers(100, 150)), max_size=14),
    cell=st.sampled_from([1, 2, 3, 1000]),
)
def test_outer_product_matches_brute_force(spark, parent, a, b, cell):
    p_df = spark.createDataFrame(parent, "k long, p string")
    a_df = spark.createDataFrame(a, "k long, av long")
    b_df = spark.createDataFrame(b, "k long, bv long")
    got = outer_product_by_key(p_df, a_df, b_df, "k", "k", "k", cell_rows=cell).collect()
    assert sorted(map(tuple, got), key=repr) == _brute(parent, a, b)


def test_user_activity_row_count_on_driver_tables(spark):
    from tools.catalog import q_user_core_activity_summary
    from tools import standins as s

    sf = "/root/testdata/sf0.001"
    df = q_user_core_activity_summary(spark, sf)
    t = s.tickets(spark, sf).groupBy("user_id").count().withColumnRenamed("count", "T")
    e = s.app_events(spark, sf).groupBy("user_id").count().withColumnRenamed("count", "E")
    u = s.users(spark, sf)
    expected = (
        u.join(t, u.id == t.user_id, "left")
        .join(e, u.id == e.user_id, "left")
        .select((F.greatest(F.coalesce("T", F.lit(0)), F.lit(1)) * F.greatest(F.coalesce("E", F.lit(0)), F.lit(1))).alias("n"))
        .agg(F.sum("n"))
        .first()[0]
    )
    assert df.count() == expected == 10299


def test_hot_user_is_spread_over_grid_cells(spark):
    parent = spark.createDataFrame([(1, "hot"), (2, "cold")], "k long, p string")
    a = spark.range(0, 50).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("av"))
    b = spark.range(0, 40).select(F.lit(1).cast("long").alias("k"), (F.col("id") + 1000).alias("bv"))
    out = outer_product_by_key(parent, a, b, "k", "k", "k", cell_rows=8)
    assert out.count() == 50 * 40 + 1
    assert out.where("k = 1").select("av", "bv").distinct().count() == 2000


def test_outer_product_with_key_only_children(spark):
    parent = spark.createDataFrame([(1, "p"), (2, "q")], "k long, p string")
    a = spark.createDataFrame([(1,), (1,)], "k long")
    b = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k long")
    out = outer_product_by_key(parent, a, b, "k", "k", "k", cell_rows=1)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "p")] * 6 + [(2, "q")]


def test_comment_volume_union_forms_agree(spark):
    issues = _comments(spark, [(str(i), "a", dt.datetime(2024, 1, 1 + i % 5, i % 24)) for i in range(40)])
    prs = _comments(spark, [(str(i), "b", dt.datetime(2024, 1, 3 + i % 4, i % 24)) for i in range(30)])

    def two_branch(df, tag):
        return df.groupBy(F.col("created_at").cast("date").alias("day")).agg(
            F.count(F.lit(1)).alias("num_comments")
        ).withColumn("type", F.lit(tag))

    expected = two_branch(issues, "issue").unionByName(two_branch(prs, "pull_request"))
    got = marts.comment_volume_by_day(issues, prs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
