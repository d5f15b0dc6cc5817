"""Sinks: contracts, replace, statistics, replication over JDBC."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from quarry import schemas
from quarry.sinks.warehouse import ContractError, Warehouse, enforce_contract
from tools import standins as s
from quarry.sources.replicate import ReplicationSpec, jdbc_reader, replicate

SF = "/root/testdata/sf0.001"


def test_contract_casts_and_rejects(spark):
    df = spark.createDataFrame([("a", 3, "issue")], "username string, total_comments int, type string")
    out = enforce_contract(df, schemas.TOP_COMMENT_AUTHORS)
    assert dict(out.dtypes)["total_comments"] == "bigint"
    assert out.schema["username"].metadata["comment"].startswith("Login")
    with pytest.raises(ContractError):
        enforce_contract(df.drop("type"), schemas.TOP_COMMENT_AUTHORS)
    with pytest.raises(ContractError):
        enforce_contract(df.withColumn("x", F.lit(1)), schemas.TOP_COMMENT_AUTHORS)


def test_contract_overflow_fails_instead_of_null(spark):
    df = spark.createDataFrame([(2**40, 1.0)], "months_subscribed long, NPS double")
    with pytest.raises(Exception):
        enforce_contract(df, schemas.NPS_BY_SUBSCRIPTION_MONTH).collect()


def test_replace_table_may_read_itself(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir)
    db = f"db_{uuid.uuid4().hex[:8]}"
    wh.replace_table(spark.range(5).withColumnRenamed("id", "v"), db, "t")
    wh.replace_table(wh.table(db, "t").withColumn("v", F.col("v") * 10), db, "t")
    assert sorted(r.v for r in wh.table(db, "t").collect()) == [0, 10, 20, 30, 40]


def test_statistics_row(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir)
    db = f"db_{uuid.uuid4().hex[:8]}"
    wh.replace_table(spark.range(7).select(F.col("id"), F.lit("x").alias("s")), db, "t")
    (row,) = wh.statistics(db, "t").collect()
    assert (row.table_name, row.schema_name, row.num_rows, row.column_count) == ("t", db, 7, 2)
    assert row.estimated_size and row.estimated_size > 0


def test_replicate_from_jdbc_in_memory_database(spark, tmp_dir):
    url = f"jdbc:derby:memory:q{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    sources = {"APP.TICKETS": s.tickets(spark, SF), "APP.TEAMS": s.teams(spark, SF)}
    for name, df in sources.items():
        # unquoted identifiers are upper case in the database
        df.toDF(*[c.upper() for c in df.columns]).write.jdbc(url, name, properties=props)
    spec = ReplicationSpec({"APP.TICKETS": {"partition_column": "ID"}, "APP.TEAMS": {"partition_column": "ID"}})
    wh = Warehouse(spark, tmp_dir)
    summary = {r.table_name: (r.num_rows, r.column_count) for r in replicate(spec, jdbc_reader(spark, url, props, rows_per_query=400), wh).collect()}
    assert summary == {"APP_TICKETS": (1500, 8), "APP_TEAMS": (25, 2)}
    t = wh.table("main", "APP_TICKETS")
    assert t.select(F.sum("ID")).first()[0] == s.tickets(spark, SF).select(F.sum("id")).first()[0]
    assert t.rdd.getNumPartitions() >= 1


def test_jdbc_without_a_column_to_cut_at_is_refused(spark):
    with pytest.raises(ValueError, match="partition_column"):
        jdbc_reader(spark, "jdbc:derby:memory:none")("APP.T", {})


def test_two_roots_side_by_side(spark, tmp_dir):
    one, two = Warehouse(spark, f"{tmp_dir}/one"), Warehouse(spark, f"{tmp_dir}/two")
    one.replace_table(spark.range(3), "main", "t")
    two.replace_table(spark.range(5), "main", "t")
    assert (one.table("main", "t").count(), two.table("main", "t").count()) == (3, 5)


def test_partition_values_come_back_as_written(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir)
    rows = spark.createDataFrame([("1", "a"), (None, "b"), ("02", "c")], "type string, v string")
    wh.replace_table(rows, "main", "t", partition_by=["type"])
    back = wh.table("main", "t")
    assert back.schema["type"].dataType.simpleString() == "string"
    assert sorted(((r.type, r.v) for r in back.collect()), key=lambda x: x[1]) == [("1", "a"), (None, "b"), ("02", "c")]


def test_replace_keeps_the_previous_version_readable(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir, keep_versions=2)
    wh.replace_table(spark.range(1), "main", "t")
    before = wh.table("main", "t")
    wh.replace_table(spark.range(2), "main", "t")
    assert (before.count(), wh.table("main", "t").count()) == (1, 2)
    wh.replace_table(spark.range(3).withColumn("more", F.lit(1)), "main", "t")
    assert wh.table("main", "t").columns == ["id", "more"]
    assert len(wh._versions("main", "t")) == 2


def test_stored_means_are_not_rounded(spark, tmp_dir):
    from quarry.plans import marts

    wh = Warehouse(spark, tmp_dir)
    bodies = spark.createDataFrame([("a",), ("bb",), ("bb",)], "body string")
    wh.replace_table(marts.avg_comment_length(bodies, bodies), "main", "t", contract=schemas.AVG_COMMENT_LENGTH)
    assert wh.table("main", "t").first().avg_length == 5 / 3


def test_replicate_target_template():
    assert ReplicationSpec.target("{stream_schema}_{stream_table}", "public.tickets") == "public_tickets"
    spec = ReplicationSpec({"public.users": {"object": "raw_{stream_table}"}})
    assert spec.options("public.users")["object"] == "raw_{stream_table}"
    assert spec.options("public.users")["mode"] == "full-refresh"


def test_end_to_end_load_and_derive(spark, tmp_dir):
    """Land pages, load both resources, replicate product tables, derive all six."""
    from quarry.plans import loads
    from tools.catalog import REPLICATED_STREAMS
    from tools import fixture_pages as fx
    from quarry.sources import landing

    landing.land_json(
        fx.event_comment_pages(spark, SF).unionByName(fx.conversation_pages(spark, SF, resource="pull_requests")),
        f"{tmp_dir}/pages",
    )
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    written = loads.load_reactions(wh, landing.read_pages(spark, f"{tmp_dir}/pages"), None, dataset="gh_e2e",
                                   resources=("issues", "pull_requests"), max_items=250)
    assert "gh_e2e.pull_requests__comments__reactions" in written
    users_with_events = spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    assert wh.table("gh_e2e", "issues").count() == users_with_events  # fewer than 250: no page is cut
    spec = ReplicationSpec({name: None for name in REPLICATED_STREAMS})
    replicate(spec, lambda st, _o: REPLICATED_STREAMS[st](spark, SF), wh, database="main_e2e")
    stats = {r.table_name: r for r in loads.derive_analytics(wh, "gh_e2e", "main_e2e", "analytics_e2e").collect()}
    assert len(stats) == 6
    team = stats["team_performance_summary"]
    assert (team.num_rows, team.column_count, team.database_name) == (5, 5, "spark_catalog")
    assert wh.table("analytics_e2e", "user_core_activity_summary").count() == 10299
    assert dict(wh.table("analytics_e2e", "nps_by_subscription_month").dtypes)["NPS"] == "float"
    assert wh.table("gh_e2e", "top_comment_authors").count() > 0
