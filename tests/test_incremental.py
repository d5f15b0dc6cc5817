"""Incremental event loads: batch exactness, idempotence, late rows, stream."""

from __future__ import annotations

import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import incremental as inc
from quarry.streaming import events as stream_events

FEED = "id string, type string, created_at string, payload string"


def _feed(spark, rows):
    return inc.events_from_feed(spark.createDataFrame(rows, FEED))


def _ev(i, day, hour=0, etype="PushEvent"):
    return (str(i), etype, f"2024-01-{day:02d}T{hour:02d}:00:00Z", json.dumps({"n": i}))


def test_repeat_run_loads_nothing(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    batch = _feed(spark, [_ev(i, 1 + i % 5) for i in range(20)])
    t.load(batch)
    t.load(batch)
    assert t.target().count() == 20


def test_duplicates_in_batch_and_overlap(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    t.load(_feed(spark, [_ev(1, 1), _ev(1, 1), _ev(2, 2)]))
    t.load(_feed(spark, [_ev(2, 2), _ev(3, 3), _ev(3, 3)]))
    assert sorted(r.id for r in t.target().collect()) == ["1", "2", "3"]


def test_rows_older_than_cursor_are_late(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    t.load(_feed(spark, [_ev(1, 5)]))
    res = t.load(_feed(spark, [_ev(2, 4), _ev(3, 5), _ev(4, 6)]))
    assert sorted(r.id for r in t.target().collect()) == ["1", "3", "4"]  # equal to cursor is kept
    assert res["cursor_after"].day == 6


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(cuts=st.lists(st.integers(1, 39), min_size=1, max_size=3, unique=True))
def test_k_batches_in_cursor_order_equal_one_load(spark, cuts):
    import tempfile

    rows = [_ev(i, 1 + i // 4, i % 4) for i in range(40)]
    bounds = [0, *sorted(cuts), 40]
    one = inc.IncrementalTable(spark, tempfile.mkdtemp(prefix="quarry-inc-") + "/t")
    one.load(_feed(spark, rows))
    many = inc.IncrementalTable(spark, tempfile.mkdtemp(prefix="quarry-inc-") + "/t")
    for lo, hi in zip(bounds, bounds[1:]):
        many.load(_feed(spark, rows[max(0, lo - 2):hi]))  # overlapping batches
    a = one.target().select("id", "created_at")
    b = many.target().select("id", "created_at")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gap_audit_flags_full_pulls_without_overlap(spark):
    rows = spark.createDataFrame(
        [("r", 1, "2024-01-01T00:00:00Z"), ("r", 1, "2024-01-01T01:00:00Z"),
         ("r", 2, "2024-01-01T03:00:00Z"), ("r", 2, "2024-01-01T04:00:00Z"),
         ("r", 3, "2024-01-01T04:00:00Z"), ("r", 3, "2024-01-01T05:00:00Z")],
        "repo string, pull long, created_at string",
    ).withColumn("created_at", F.to_timestamp_ntz("created_at"))
    out = {r.pull: r.possible_gap for r in inc.pull_gaps(rows, ["repo"], "pull", cap=2).collect()}
    assert out == {1: False, 2: True, 3: False}


def test_stream_loads_each_event_once_across_runs(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    target, ckpt = os.path.join(tmp_dir, "target"), os.path.join(tmp_dir, "ckpt")

    def land(name, events):
        os.makedirs(os.path.join(landing, name))
        with open(os.path.join(landing, name, "page.json"), "w") as f:
            f.write(json.dumps([dict(zip(["id", "type", "created_at", "payload"], e)) for e in events]) + "\n")

    land("p0", [_ev(i, 1, i % 24) for i in range(100)])
    stream_events.run_available(spark, f"{landing}/*", target, ckpt, delay="2 days")
    land("p1", [_ev(i, 2, i % 24) for i in range(90, 150)])  # 60 rows, 10 repeats
    stream_events.run_available(spark, f"{landing}/*", target, ckpt, delay="2 days")
    stream_events.run_available(spark, f"{landing}/*", target, ckpt, delay="2 days")  # nothing new
    df = spark.read.parquet(target)
    assert df.count() == 150
    assert df.select("id").distinct().count() == 150


def test_type_views_prune_to_their_partition(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    t.load(_feed(spark, [_ev(1, 1, etype="PushEvent"), _ev(2, 1, etype="WatchEvent"), _ev(3, 2, etype="PushEvent")]))
    names = inc.register_type_views(t.target(), ["PushEvent", "WatchEvent"])
    assert names == ["repo_events_push_event", "repo_events_watch_event"]
    assert spark.table("repo_events_push_event").count() == 2
    plan = spark.table("repo_events_watch_event")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan


def test_late_rows_are_counted_and_kept_aside(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    assert t.load(_feed(spark, [_ev(1, 5)]))["late_rows"] == 0
    assert t.load(_feed(spark, [_ev(2, 4), _ev(3, 6)]))["late_rows"] == 1
    assert [r.id for r in spark.read.parquet(t.late_path).collect()] == ["2"]


def test_repeated_ids_keep_the_earliest_row(spark, tmp_dir):
    for k, rows in enumerate(([_ev(1, 2), _ev(1, 3)], [_ev(1, 3), _ev(1, 2)])):
        t = inc.IncrementalTable(spark, os.path.join(tmp_dir, f"t{k}"))
        t.load(_feed(spark, rows))
        assert [r.created_at.day for r in t.target().collect()] == [2]


def test_a_run_opens_only_recent_partitions(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    t.load(_feed(spark, [_ev(k, k) for k in range(1, 9)]))
    plan = t.new_rows(_feed(spark, [_ev(9, 9)]), t.cursor())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan


def test_events_without_a_type_are_kept(spark):
    events = _feed(spark, [_ev(1, 1), ("2", None, "2024-01-01T00:00:00Z", "{}")])
    parts = inc.split_by_type(events)
    assert {k: v.count() for k, v in parts.items()} == {"PushEvent": 1, None: 1}


def test_stream_late_rows_are_found(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    target, ckpt = os.path.join(tmp_dir, "target"), os.path.join(tmp_dir, "ckpt")

    def land(name, events):
        os.makedirs(os.path.join(landing, name))
        with open(os.path.join(landing, name, "page.json"), "w") as f:
            f.write(json.dumps([dict(zip(["id", "type", "created_at", "payload"], e)) for e in events]) + "\n")

    land("p0", [_ev(1, 20)])
    stream_events.run_available(spark, f"{landing}/*", target, ckpt, delay="1 day")
    land("p1", [_ev(2, 2), _ev(3, 21)])
    query = stream_events.run_available(spark, f"{landing}/*", target, ckpt, delay="1 day")
    assert stream_events.late_count(query) == 1
    late = stream_events.late_rows(spark, f"{landing}/*", target, os.path.join(tmp_dir, "late"))
    assert [r.id for r in late.collect()] == ["2"]
