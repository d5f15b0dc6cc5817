"""Event loads: nothing lost in silence, crashes, the id index, pulls, the stream."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import id_index
from quarry.operators import incremental as inc
from quarry.plans import loads
from quarry.sinks.ledger import Ledger
from quarry.sources import landing

FEED = "id string, type string, created_at string, payload string"


def _feed(spark, rows):
    return inc.events_from_feed(spark.createDataFrame(rows, FEED))


def _ev(i, day, hour=0, etype="PushEvent"):
    return (None if i is None else str(i), etype, f"2024-01-{day:02d}T{hour:02d}:00:00Z", json.dumps({"n": i}))


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


def _adds_up(counts):
    assert counts["read"] == sum(counts[c] for c in ("loaded", "late", "repeated", "rejected"))
    return tuple(counts[c] for c in ("read", "loaded", "late", "repeated", "rejected"))


def test_rows_without_id_or_time_are_rejected_with_their_reason(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    rows = [_ev(1, 1), _ev(None, 2), _ev(None, 2), ("3", "PushEvent", None, "{}"), ("4", "PushEvent", "soon", "{}"),
            ("5", "PushEvent", "2024-13-45T00:00:00Z", "{}"), _ev(1, 3)]
    assert _adds_up(t.load(_feed(spark, rows))) == (7, 1, 0, 1, 5)
    got = sorted((r.reason, r.id or "") for r in t.rejected().collect())
    assert got == [("no id", "")] * 2 + [("no readable time", k) for k in "345"]
    # The next run takes its cursor from what was loaded, and adds its own.
    assert _adds_up(t.load(_feed(spark, [_ev(None, 4), _ev(2, 4)]))) == (2, 1, 0, 0, 1)
    assert t.rejected().count() == 6 and _ids(t.target()) == ["1", "2"]


def test_lines_that_are_not_json_are_kept_with_their_text(spark, tmp_dir):
    pages = os.path.join(tmp_dir, "landing")
    os.makedirs(pages)
    with open(os.path.join(pages, "page.json"), "w") as f:
        f.write(json.dumps([dict(zip(("id", "type", "created_at", "payload"), _ev(k, 1, k))) for k in range(3)]) + "\n")
        f.write('{"id": "9", "type": \n')
        f.write("<html>502</html>\n")
        f.write(json.dumps({"id": None, "type": "PushEvent", "created_at": "2024-01-01T00:00:00Z", "payload": "{}"}) + "\n")
    target = os.path.join(tmp_dir, "t")
    counts = loads.load_repo_events(landing.read_events(spark, pages), target)
    assert _adds_up(counts) == (6, 3, 0, 0, 3)
    t = inc.IncrementalTable(spark, target)
    raws = {r.raw: r.reason for r in t.rejected().collect()}
    assert raws['{"id": "9", "type": '] == raws["<html>502</html>"] == "line is not JSON"
    assert any('"type":"PushEvent"' in r and why == "no id" for r, why in raws.items())
    (pull,) = t.pulls().collect()
    assert pull.pull.endswith("page.json") and pull.n_events == 6


def test_an_old_row_that_is_stored_is_a_repeat_and_not_late(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    t.load(_feed(spark, [_ev(k, 1 + k % 9) for k in range(50)]))
    assert _adds_up(t.load(_feed(spark, [_ev(k, 1 + k % 9) for k in range(50)] + [_ev(99, 12)]))) == (51, 1, 0, 50, 0)
    # Late for the first time, then known as such.
    assert _adds_up(t.load(_feed(spark, [_ev(200, 3), _ev(201, 3), _ev(7, 8)]))) == (3, 0, 2, 1, 0)
    assert _adds_up(t.load(_feed(spark, [_ev(200, 3), _ev(201, 3), _ev(202, 3)]))) == (3, 0, 1, 2, 0)
    assert _ids(t.late()) == ["200", "201", "202"]


def test_loads_equal_a_brute_anti_join(spark, tmp_dir):
    rng = random.Random(8)
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    loaded, late, cursor = {}, {}, ""
    made = [_ev(k, rng.randint(1, 28), rng.randint(0, 23)) for k in range(400)]
    for _ in range(4):
        batch = [rng.choice(made) for _ in range(150)]
        want = [0, 0, 0]
        seen, newest = set(), cursor
        for row in batch:
            if row[0] in seen or row[0] in loaded or row[0] in late:
                want[2] += 1
            elif row[2] < cursor:
                late[row[0]] = row
                want[1] += 1
            else:
                loaded[row[0]] = row
                want[0] += 1
            seen.add(row[0])
            newest = max(newest, row[2])
        cursor = newest
        counts = t.load(_feed(spark, batch))
        assert [counts["loaded"], counts["late"], counts["repeated"]] == want
    assert _ids(t.target()) == sorted(loaded) and _ids(t.late()) == sorted(late)


def test_old_folders_are_not_read_for_late_rows(spark, tmp_dir):
    """Late rows that no filter knows open no folder of the table at all; a known one
    opens its own day's."""
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    t.load(_feed(spark, [_ev(k, 1 + k % 20) for k in range(200)]))
    late = spark.createDataFrame([("x1", dt.date(2024, 1, 3)), ("x2", dt.date(2024, 1, 5))], "id string, created_date date")
    assert t._stored_late(late) is None
    known = spark.createDataFrame([("4", dt.date(2024, 1, 5)), ("x2", dt.date(2024, 1, 7))], "id string, created_date date")
    for folder, _, names in os.walk(t.path):  # opening any other day's file would fail
        for name in names:
            if name.endswith(".parquet") and "created_date=2024-01-05" not in folder:
                with open(os.path.join(folder, name), "wb") as f:
                    f.write(b"not parquet")
                crc = os.path.join(folder, f".{name}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
    assert t._stored_late(late) is None
    assert [r.id for r in t._stored_late(known).collect()] == ["4"]
    with pytest.raises(Exception):
        t.target().count()
        t.target().select("id").collect()


def test_filters_hold_all_their_ids_and_few_others(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit(dt.date(2024, 1, 1)).alias("day"))
    index = id_index.filters_of(ids, "id", "day").withColumn("run", F.lit(0))
    index.cache()
    assert id_index.perhaps_stored(ids, "id", "day", index).count() == 20_000
    others = spark.range(50_000, 70_000).select(F.col("id").cast("string").alias("id"), F.lit(dt.date(2024, 1, 1)).alias("day"))
    assert id_index.perhaps_stored(others, "id", "day", index).count() < 60
    other_day = ids.withColumn("day", F.lit(dt.date(2024, 1, 2)))
    assert id_index.perhaps_stored(other_day, "id", "day", index).count() == 0


@pytest.mark.parametrize("dies_at", ["late", "ids", "entry"])
def test_a_run_that_died_is_written_over(spark, tmp_dir, monkeypatch, dies_at):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    t.load(_feed(spark, [_ev(k, 5) for k in range(5)]))
    batch = [_ev(10, 6), _ev(11, 2), _ev(None, 6), _ev(3, 5)]

    def dies(*args, **kw):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        if dies_at == "entry":
            m.setattr(Ledger, "append", dies)
        else:
            write = inc.IncrementalTable._write
            m.setattr(
                inc.IncrementalTable, "_write",
                lambda self, rows, path, *a: dies() if path.endswith("__" + dies_at) else write(self, rows, path, *a),
            )
        with pytest.raises(RuntimeError):
            t.load(_feed(spark, batch))
    # Nothing of the died run is seen.
    assert _ids(t.target()) == list("01234") and t.late() is None and t.rejected() is None
    t.load(_feed(spark, batch[:1]))
    assert _ids(t.target()) == ["0", "1", "10", "2", "3", "4"] and t.late() is None
    assert _adds_up(t.load(_feed(spark, batch))) == (4, 0, 1, 2, 1)
    assert _ids(t.late()) == ["11"] and t.rejected().count() == 1


def test_a_committed_batch_is_skipped(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    first = t.load(_feed(spark, [_ev(1, 1), _ev(2, 2)]), token="q:0")
    assert t.load(_feed(spark, [_ev(3, 3)]), token="q:0") == first
    assert _ids(t.target()) == ["1", "2"]
    assert t.load(_feed(spark, [_ev(3, 3)]), token="q:1")["loaded"] == 1
    assert t.runs().select("number", "loaded").orderBy("number").collect() == [(0, 2), (1, 1)]


def _land(landing_dir, name, events, more=()):
    os.makedirs(os.path.join(landing_dir, name))
    with open(os.path.join(landing_dir, name, "page.json"), "w") as f:
        f.write(json.dumps([dict(zip(("id", "type", "created_at", "payload"), e)) for e in events]) + "\n")
        f.writelines(line + "\n" for line in more)


def _stream(spark, tmp_dir, **kw):
    from quarry.sinks.warehouse import Warehouse
    from quarry.streaming import events as stream_events

    table = inc.IncrementalTable(spark, os.path.join(tmp_dir, "target"))
    warehouse = Warehouse(spark, os.path.join(tmp_dir, "wh"))
    landed, ckpt = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ckpt")
    names = stream_events.run_into_tables(spark, f"{landed}/*", table, ckpt, warehouse, **kw)
    return table, warehouse, landed, names


def test_stream_makes_a_table_for_each_type(spark, tmp_dir):
    landed = os.path.join(tmp_dir, "landing")
    _land(landed, "p0", [_ev(1, 1), _ev(2, 1, etype="WatchEvent"), _ev(3, 2), _ev(4, 2, etype=None)], ["not json"])
    table, wh, _, names = _stream(spark, tmp_dir)
    assert sorted(names) == ["repo_events_push_event", "repo_events_untyped", "repo_events_watch_event"]
    # Repeats long after, a late row and a type that was not there before.
    _land(landed, "p1", [_ev(1, 1), _ev(9, 1), _ev(5, 20, etype="Fork Event"), _ev(6, 20)])
    _land(landed, "p2", [_ev(1, 1), _ev(6, 20), _ev(9, 1)])
    _, _, _, names = _stream(spark, tmp_dir)
    ids = {n: _ids(wh.table("repo_events", n)) for n in names}
    fork = next(n for n in names if "fork" in n)
    assert ids == {"repo_events_push_event": ["1", "3", "6"], "repo_events_watch_event": ["2"],
                   "repo_events_untyped": ["4"], fork: ["5"]}
    assert _ids(table.late()) == ["9"] and table.rejected().count() == 1
    assert sum(r.read for r in table.runs().collect()) == 12
    plan = wh.table("repo_events", "repo_events_push_event").where("created_date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(created_date" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("dies_at", ["files", "after the entry"])
def test_a_killed_stream_batch_comes_again_and_adds_nothing(spark, tmp_dir, monkeypatch, dies_at):
    from quarry.sinks import type_tables

    landed = os.path.join(tmp_dir, "landing")
    _land(landed, "p0", [_ev(1, 1), _ev(2, 2)])
    _stream(spark, tmp_dir)
    _land(landed, "p1", [_ev(3, 3), _ev(2, 2), _ev(4, 3, etype="WatchEvent"), _ev(5, 1)])

    def dies(*args, **kw):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        if dies_at == "files":
            m.setattr(Ledger, "append", dies)
        else:
            m.setattr(type_tables, "publish_types", dies)
        with pytest.raises(Exception):
            _stream(spark, tmp_dir)
    table, wh, _, names = _stream(spark, tmp_dir)
    assert _ids(wh.table("repo_events", "repo_events_push_event")) == ["1", "2", "3"]
    assert _ids(wh.table("repo_events", "repo_events_watch_event")) == ["4"]
    assert _ids(table.target()) == ["1", "2", "3", "4"] and _ids(table.late()) == ["5"]
    _, _, _, _ = _stream(spark, tmp_dir)  # nothing new
    assert table.target().count() == 4


def test_ledger_refuses_a_number_twice(spark, tmp_dir):
    ledger = Ledger(spark, os.path.join(tmp_dir, "l"))
    assert ledger.last() is None and ledger.last_number() == -1
    ledger.append(0, {"x": 1})
    ledger.append(1, {"x": 2})
    with pytest.raises(FileExistsError):
        ledger.append(1, {"x": 3})
    assert ledger.last() == {"number": 1, "x": 2}
    assert sorted(map(tuple, ledger.rows("number long, x long").collect())) == [(0, 1), (1, 2)]


def test_covered_time_is_merged_from_pulls(spark):
    def at(h):
        return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)

    rows = [(0, 5, 10), (3, 9, 20), (9, 12, 5), (20, 22, 7), (20, 21, 1), (21, 30, 2), (40, 40, 1)]
    pulls = spark.createDataFrame(
        [("r", at(a), at(b), n) for a, b, n in rows] + [("q", at(1), at(2), 3), ("q", None, None, 4)],
        "repo string, oldest timestamp_ntz, newest timestamp_ntz, n_events long",
    )
    got = {(r.repo, r.stretch): r[2:] for r in inc.covered_intervals(pulls, ["repo"]).collect()}
    assert got == {
        ("r", 1): (at(0), at(12), 3, 35, None),
        ("r", 2): (at(20), at(30), 3, 10, at(12)),
        ("r", 3): (at(40), at(40), 1, 1, at(30)),
        ("q", 1): (at(1), at(2), 1, 3, None),
    }


def test_an_empty_batch_and_a_first_run_of_late_rows_only(spark, tmp_dir):
    t = inc.IncrementalTable(spark, os.path.join(tmp_dir, "t"))
    assert _adds_up(t.load(_feed(spark, []))) == (0, 0, 0, 0, 0)
    assert t.target().count() == 0
    assert _adds_up(t.load(_feed(spark, [_ev(1, 5)]))) == (1, 1, 0, 0, 0)
    assert _adds_up(t.load(_feed(spark, [_ev(2, 4)]))) == (1, 0, 1, 0, 0)
    assert t.cursor() == dt.datetime(2024, 1, 5)


def test_an_id_asks_one_bucket_and_other_layouts_tell_nothing(spark, tmp_dir):
    ids = spark.range(5_000).select(F.col("id").cast("string").alias("id"), F.lit(dt.date(2024, 1, 1)).alias("day"))
    index = id_index.filters_of(ids, "id", "day").withColumn("run", F.lit(0))
    asked = spark.createDataFrame([("x", dt.date(2024, 1, 1)), ("y", dt.date(2024, 1, 2))], "id string, day date")
    index.write.parquet(f"{tmp_dir}/ids")
    index = spark.read.parquet(f"{tmp_dir}/ids")
    assert "Generate" not in id_index.perhaps_stored(asked, "id", "day", index)._jdf.queryExecution().optimizedPlan().toString()
    old = index.withColumn("layout", F.lit(None).cast("int"))
    assert [r.id for r in id_index.perhaps_stored(asked, "id", "day", old).collect()] == ["x"]
