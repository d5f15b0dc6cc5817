"""Driver tables recast as the tables the derived SQL reads.

The reference reads a product database (users, tickets, teams, events, NPS
responses) and normalised comment tables. The driver ships TPC-H-like tables
instead; each function below maps them, column for column, to the
reference's shape. The mapping is part of the test fixture, and the same
mapping is written in SQL in ``tools.oracle`` so both engines read
identical inputs.

Every function selects only the columns it maps, so the Parquet scan prunes
the rest and pushes the ``event_type``/``role`` predicates into the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import table_path

# Fixed values of the stand-in mapping. They are test-fixture rules, chosen to
# put NULLs and half months into the data; the oracle SQL uses the same ones.
ISSUE_EVENT_TYPES = ("view", "signup", "purchase")
PULL_REQUEST_EVENT_TYPES = ("click", "error")
ISSUE_BODY_ROLES = ("user", "system")
PULL_REQUEST_BODY_ROLES = ("assistant",)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("email"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit(None))
        .otherwise(F.col("c_nationkey"))
        .alias("team_id"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderpriority").alias("team_name"),
        (key % 3600).alias("seconds_to_first_reply"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None))
        .otherwise((key * 37) % 864000)
        .alias("seconds_to_last_close"),
        F.when(key % 4 == 0, F.lit(None)).otherwise(1 + key % 5).alias("csat_rating"),
    )


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id"),
        F.col("ts").alias("time"),
        F.col("event_type").alias("name"),
    )


def nps_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        F.when(F.col("user_id") % 50 == 49, F.lit(None))
        .otherwise((F.col("user_id") % 36) * F.lit(0.5).cast("double"))
        .alias("months_subscribed"),
        F.when(F.col("event_id") % 12 == 11, F.lit(None))
        .otherwise(F.col("event_id") % 12)
        .alias("nps_response"),
    )


def _comment_login(user_id):
    return F.when(user_id % 30 == 0, F.lit(None)).otherwise(F.concat(F.lit("user"), user_id))


def _comments(spark: SparkSession, sf_dir: str, event_types) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.where(F.col("event_type").isin(*event_types)).select(
        F.col("event_id").alias("id"),
        _comment_login(F.col("user_id")).alias("author__login"),
        F.col("ts").alias("created_at"),
    )


def issue_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comments(spark, sf_dir, ISSUE_EVENT_TYPES)


def pull_request_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comments(spark, sf_dir, PULL_REQUEST_EVENT_TYPES)


def _bodies(spark: SparkSession, sf_dir: str, roles) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    return c.where(F.col("role").isin(*roles)).select(F.col("text").alias("body"))


def issue_comment_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bodies(spark, sf_dir, ISSUE_BODY_ROLES)


def pull_request_comment_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bodies(spark, sf_dir, PULL_REQUEST_BODY_ROLES)
