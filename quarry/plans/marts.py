"""The six derived reporting tables, as DataFrame plans.

Each function takes the reference-shaped input DataFrames and returns the
table the reference's SQL would create, typed by its contract in
``quarry.schemas``. Sources and sinks are separate (``quarry.sources``,
``quarry.sinks.warehouse``), so the same plan runs on driver stand-ins, on
normalised landed pages or on replicated product tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.casts import day_of, float32, ratio32, round_to_int
from quarry.operators.pairs import DEFAULT_CELL_ROWS, outer_product_by_key

ISSUE = "issue"
PULL_REQUEST = "pull_request"


# SRT-1..3: how the stored tables are ordered (nulls last); a reader asks for it by
# ``Warehouse.ordered_table``.
STORED_ORDER = {
    "top_comment_authors": ["total_comments desc", "username", "type"],
    "comment_volume_by_day": ["day", "type"],
    "team_performance_summary": ["avg_csat desc", "team_name"],
    "nps_by_subscription_month": ["months_subscribed"],
}


def _tagged(issue_df: DataFrame, pr_df: DataFrame, *cols) -> DataFrame:
    """Both comment tables in one relation with a ``type`` tag.

    One aggregate over the tagged union replaces a union of two aggregates:
    one shuffle instead of two, the same rows (SURVEY §2.6, SET-1).
    """
    return issue_df.select(*cols, F.lit(ISSUE).alias("type")).unionByName(
        pr_df.select(*cols, F.lit(PULL_REQUEST).alias("type"))
    )


def top_comment_authors(issue_comments: DataFrame, pr_comments: DataFrame) -> DataFrame:
    """Q1: comments per author and type, most active first. NULL author is a group."""
    tagged = _tagged(issue_comments, pr_comments, F.col("author__login").alias("username"))
    return (
        tagged.groupBy("type", "username")
        .agg(F.count(F.lit(1)).alias("total_comments"))
        .select("username", "total_comments", "type")
        .orderBy(F.col("total_comments").desc_nulls_last(), F.col("username").asc_nulls_last(), "type")
    )


def comment_volume_by_day(issue_comments: DataFrame, pr_comments: DataFrame) -> DataFrame:
    """Q2: comments per calendar day and type, oldest day first."""
    tagged = _tagged(issue_comments, pr_comments, day_of(F.col("created_at")).alias("day"))
    return (
        tagged.groupBy("type", "day")
        .agg(F.count(F.lit(1)).alias("num_comments"))
        .select("day", "num_comments", "type")
        .orderBy(F.col("day").asc_nulls_last(), "type")
    )


def avg_comment_length(issue_comments: DataFrame, pr_comments: DataFrame) -> DataFrame:
    """Q3: mean body length per type.

    Kept as two global aggregates so each type yields its row even when its
    table is empty (value NULL), as ``AVG`` over no rows does in SQL.
    """

    def one(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(F.avg(F.length("body")).alias("avg_length")).select(
            F.lit(tag).alias("type"), "avg_length"
        )

    return one(issue_comments, ISSUE).unionByName(one(pr_comments, PULL_REQUEST))


def team_performance_summary(tickets: DataFrame) -> DataFrame:
    """Q4: tickets per team with mean reply, resolution and CSAT; best CSAT first."""
    return (
        tickets.groupBy("team_name")
        .agg(
            F.count(F.lit(1)).alias("total_tickets"),
            F.avg("seconds_to_first_reply").alias("avg_first_reply_secs"),
            F.avg("seconds_to_last_close").alias("avg_resolution_secs"),
            F.avg("csat_rating").alias("avg_csat"),
        )
        .orderBy(F.col("avg_csat").desc_nulls_last(), F.col("team_name").asc_nulls_last())
    )


def nps_by_subscription_month(nps_responses: DataFrame, months: int = 12) -> DataFrame:
    """Q5: net promoter score per whole month subscribed, first ``months`` groups.

    ``LIMIT 12`` after ``ORDER BY 1`` keeps the first twelve month groups
    present (not months <= 12), NULL month last. The casts reproduce the
    reference engine: months round half to even, counts and ratios are 32-bit.
    """
    month_type = nps_responses.schema["months_subscribed"].dataType
    monthly = (
        nps_responses.select(
            round_to_int(F.col("months_subscribed"), month_type).alias("months_subscribed"),
            F.col("nps_response"),
        )
        .groupBy("months_subscribed")
        .agg(
            F.count_if(F.col("nps_response") >= 9).alias("n_promoters"),
            F.count_if(F.col("nps_response") <= 6).alias("n_detractors"),
            F.count(F.lit(1)).alias("n_responses"),
        )
    )
    nps = (
        ratio32(F.col("n_promoters"), F.col("n_responses"))
        - ratio32(F.col("n_detractors"), F.col("n_responses"))
    ) * float32(F.lit(100))
    return (
        monthly.select("months_subscribed", nps.cast("float").alias("NPS"))
        .orderBy(F.col("months_subscribed").asc_nulls_last())
        .limit(months)
    )


def user_core_activity_summary(
    users: DataFrame,
    tickets: DataFrame,
    teams: DataFrame,
    events: DataFrame,
    cell_rows: int = DEFAULT_CELL_ROWS,
) -> DataFrame:
    """Q6: every user with each of their tickets times each of their events.

    ``users ⟕ tickets ⟕ teams ⟕ events`` yields max(T,1) * max(E,1) rows per
    user (SURVEY D5); the result is kept whole. Teams attach first: one row per
    user, no growth, and Catalyst broadcasts it when its estimated size is
    under the broadcast threshold (a sort-merge join otherwise). The
    ticket-by-event product then runs through the skew-safe grid of
    ``outer_product_by_key``.
    """
    parent = users.select(
        F.col("id").alias("user_id"), F.col("email").alias("user_email"), "team_id"
    ).join(
        teams.select(F.col("id").alias("team_id"), F.col("name").alias("team_name")),
        "team_id",
        "left",
    ).select("user_id", "user_email", "team_name")
    t = tickets.select(
        "user_id",
        F.col("id").alias("ticket_id"),
        F.col("status").alias("ticket_status"),
        F.col("created_at").alias("ticket_created"),
    )
    e = events.select(
        "user_id",
        F.col("id").alias("event_id"),
        F.col("time").alias("event_time"),
        F.col("name").alias("event_name"),
    )
    out = outer_product_by_key(parent, t, e, "user_id", "user_id", "user_id", cell_rows)
    return out.select(
        "user_id",
        "user_email",
        "ticket_id",
        "ticket_status",
        "ticket_created",
        "team_name",
        F.col("event_id").cast("string").alias("event_id"),
        "event_time",
        "event_name",
    )
