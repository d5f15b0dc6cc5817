"""ARR-4: packed payloads to tables, levels, kinds, odd keys."""

from __future__ import annotations

import json

import pytest
from pyspark.sql.types import ArrayType, DataType, StructType

from quarry.operators import incremental as inc
from quarry.operators import nested
from quarry.plans import loads
from quarry.sinks.warehouse import Warehouse


def _events(spark, payloads, kind="PushEvent"):
    rows = [(str(k), kind, json.dumps(p) if not isinstance(p, str) else p) for k, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "id string, type string, payload string")


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


DEEP = {
    "pushId": 7,
    "comment": {"id": 1, "user": {"login": "a", "plan": {"name": "free"}}},
    "commits": [
        {"sha": "x", "author": {"email": "e"}, "parents": [{"sha": "p"}]},
        {"sha": "y", "author": {"email": "f"}, "parents": []},
    ],
    "tags": ["t1", "t2", None],
}


def test_two_levels_are_unpacked_and_the_third_stays_packed(spark):
    got = nested.unpacked(_events(spark, [DEEP]), ["id"], "push")
    assert set(got) == {"push", "push__payload__commits", "push__payload__tags"}
    (row,) = got["push"].collect()
    assert (row.payload__push_id, row.payload__comment__id) == (7, 1)
    assert json.loads(row.payload__comment__user) == DEEP["comment"]["user"]  # level 3
    commits = _rows(got["push__payload__commits"], "id", "list_idx", "sha", "author", "parents")
    assert [c[:3] for c in commits] == [("0", 0, "x"), ("0", 1, "y")]
    assert [json.loads(c[3]) for c in commits] == [{"email": "e"}, {"email": "f"}]
    assert [json.loads(c[4]) for c in commits] == [[{"sha": "p"}], []]
    assert _rows(got["push__payload__tags"], "list_idx", "value") == [(0, "t1"), (1, "t2"), (2, None)]


@pytest.mark.parametrize("level,tables", [
    (0, {"t"}),
    (1, {"t"}),
    (3, {"t", "t__payload__commits", "t__payload__tags", "t__payload__commits__parents"}),
    (9, {"t", "t__payload__commits", "t__payload__tags", "t__payload__commits__parents"}),
])
def test_other_levels(spark, level, tables):
    got = nested.unpacked(_events(spark, [DEEP]), ["id"], "t", max_level=level)
    assert set(got) == tables
    if level == 0:
        assert json.loads(got["t"].first().payload) == DEEP
    if level == 1:
        assert json.loads(got["t"].first().payload__commits) == DEEP["commits"]
    if level == 9:
        assert got["t"].first().payload__comment__user__plan__name == "free"
        assert _rows(got["t__payload__commits__parents"], "id", "list_idx", "list_idx_2", "sha") == [("0", 0, 0, "p")]


def test_kinds_of_values(spark):
    payloads = [
        {"n": 1, "x": 1, "b": True, "mixed": 1, "o": {}, "none": None, "big": 1 << 40},
        {"n": 2, "x": 2.5, "b": False, "mixed": "two", "o": {}, "none": None},
        {}, [], "3", None, "no json", {"n": None, "x": 1e300, "mixed": {"a": [1]}},
    ]
    (table,) = nested.unpacked(_events(spark, payloads[:3] + payloads[6:]), ["id"], "t").values()
    got = {r.id: r for r in table.collect()}
    assert dict(table.dtypes)["payload__n"] == "bigint" and dict(table.dtypes)["payload__x"] == "double"
    assert [got[str(k)].payload__x for k in range(5)] == [1.0, 2.5, None, None, 1e300]
    assert [got[str(k)].payload__mixed for k in (0, 1, 4)] == ["1", '"two"', '{"a":[1]}']
    assert got["0"].payload__big == 1 << 40 and got["0"].payload__b is True
    assert [got[str(k)].payload__unparsed for k in range(5)] == [None, None, None, "no json", None]
    assert not {"payload__none"} & set(table.columns)
    # Records that are no objects at all stay packed, with the others' keys unread.
    every = nested.unpacked(_events(spark, payloads), ["id"], "t")
    assert [r.payload for r in every["t"].orderBy("id").collect()][3:6] == ["[]", "3", "null"]


def test_odd_keys(spark):
    payload = {"a b": 1, "it's": 2, "x.y": {"OBJECT<": 3, "tick`": 4}, "camelCase": 5, "camel_case": 6}
    (table,) = nested.unpacked(_events(spark, [payload]), ["id"], "t").values()
    row = table.first().asDict()
    assert sorted(v for k, v in row.items() if isinstance(v, int)) == [1, 2, 3, 4, 5, 6]
    assert {"payload__camel_case", "payload__camel_case_"} <= set(table.columns)


def test_described_types_are_read(spark):
    t = nested.variant_types("OBJECT<a: BIGINT, `b: OBJECT<`: ARRAY<OBJECT<c: STRING>>>")
    assert isinstance(t, StructType) and t.names == ["a", "b: OBJECT<"]
    assert isinstance(t.fields[1].dataType, ArrayType)
    assert t.fields[1].dataType.elementType == DataType.fromDDL("struct<c: string>")


def test_no_rows_and_no_objects(spark):
    (empty,) = nested.unpacked(_events(spark, []), ["id"], "t").values()
    assert empty.count() == 0
    (text,) = nested.unpacked(_events(spark, ["x", "y"]), ["id"], "t").values()
    assert _rows(text, "id", "payload__unparsed") == [("0", "x"), ("1", "y")]


def test_child_rows_do_not_carry_their_record(spark):
    got = nested.unpacked(_events(spark, [DEEP]), ["id"], "push")["push__payload__commits"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    generate = [line for line in plan.splitlines() if "Generate posexplode" in line]
    assert len(generate) == 1 and "payload#" not in generate[0] and "_v#" not in generate[0].split("[")[1]


def test_each_type_is_loaded_with_its_own_columns(spark, tmp_dir):
    rows = [("1", "PushEvent", "2024-01-01T00:00:00Z", '{"commits":[{"sha":"a"}]}'),
            ("2", "WatchEvent", "2024-01-01T00:00:00Z", '{"action":"started"}'),
            ("3", None, "2024-01-01T00:00:00Z", '{"x":1}')]
    feed = spark.createDataFrame(rows, "id string, type string, created_at string, payload string")
    wh = Warehouse(spark, tmp_dir + "/wh")
    names = loads.load_event_payloads(wh, inc.events_from_feed(feed))
    assert sorted(names) == [
        "repo_events.events_push_event", "repo_events.events_push_event__payload__commits",
        "repo_events.events_untyped", "repo_events.events_watch_event",
    ]
    assert wh.table("repo_events", "events_watch_event").first().payload__action == "started"
    assert wh.table("repo_events", "events_push_event__payload__commits").first().sha == "a"
    assert wh.table("repo_events", "events_untyped").first().payload__x == 1
