"""Landed JSON pages to tables: readers, normalisation, page rules."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from quarry.functions.naming import snake, utc_timestamp
from quarry.operators import normalize as nz
from quarry.operators import pages as pg
from tools import fixture_pages as fx
from quarry.plans import loads
from quarry.sinks.warehouse import Warehouse
from quarry.sources import landing


def _comment(cid, login, created, groups=None, body="b"):
    return {
        "id": cid,
        "url": f"u/{cid}",
        "body": body,
        "author": None if login is None else {"login": login, "avatarUrl": "a", "url": "x"},
        "authorAssociation": "MEMBER",
        "createdAt": created,
        "reactionGroups": groups or [],
    }


def _item(number, comments, reactions=None, comments_total=None):
    return {
        "number": number,
        "url": f"i/{number}",
        "title": "t",
        "body": "b",
        "author": {"login": "owner", "avatarUrl": None, "url": None},
        "authorAssociation": "OWNER",
        "closed": False,
        "closedAt": None,
        "createdAt": "2024-01-01T00:00:00Z",
        "state": "OPEN",
        "updatedAt": "2024-01-02T00:00:00Z",
        "reactions": {"totalCount": len(reactions or []), "nodes": reactions or []},
        "comments": {"totalCount": comments_total if comments_total is not None else len(comments), "nodes": comments},
    }


def _page(page_no, items, conn="issues", errors=None, extra=None):
    data = {"repository": {conn: {"totalCount": 0, "pageInfo": {"endCursor": "e", "startCursor": "s"}, "nodes": items}}}
    if extra:
        data.update(extra)
    data["rateLimit"] = {"limit": 5000, "cost": 1, "remaining": 4000 - page_no, "resetAt": None}
    doc = {"owner": "o", "name": "n", "resource": "issues" if conn == "issues" else conn, "page_no": page_no,
           "landed_at": "2024-02-01T00:00:00Z", "data": data}
    if errors:
        doc["errors"] = errors
    return doc


def _land(tmp_dir, docs, name="pages"):
    path = os.path.join(tmp_dir, name)
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")
    return path


def test_snake_case():
    assert snake("createdAt") == "created_at"
    assert snake("avatarUrl") == "avatar_url"
    assert snake("authorAssociation") == "author_association"
    assert snake("login") == "login"


def test_utc_timestamp_ignores_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:07Z",), ("2024-01-01T05:03:07.123456+02:00",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(utc_timestamp(F.col("s"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 7), dt.datetime(2024, 1, 1, 3, 3, 7, 123456)]


def test_comments_child_table_from_json_pages(spark, tmp_dir):
    docs = [
        _page(0, [
            _item(1, [_comment("c1", "alice", "2024-01-01T01:00:00Z"), _comment("c2", None, "2024-01-01T02:00:00Z")]),
            _item(2, []),
        ]),
        _page(1, [_item(3, [_comment("c3", "bob", "2024-01-03T00:00:00Z")])]),
    ]
    pages = landing.read_pages(spark, _land(tmp_dir, docs))
    rows = nz.comments(pages, "issues").orderBy("id").collect()
    assert [(r.number, r.list_idx, r.id, r.author__login) for r in rows] == [
        (1, 0, "c1", "alice"), (1, 1, "c2", None), (3, 0, "c3", "bob")
    ]
    assert rows[0].created_at == dt.datetime(2024, 1, 1, 1, 0)
    assert rows[0].author__avatar_url == "a"
    items = nz.items(pages, "issues").orderBy("number").collect()
    assert [(r.number, r.comments_total_count, r.reactions_total_count) for r in items] == [(1, 2, 0), (2, 0, 0), (3, 1, 0)]


def test_empty_reaction_lists_keep_their_struct_type(spark, tmp_dir):
    pages = landing.read_pages(spark, _land(tmp_dir, [_page(0, [_item(1, [])])]))
    reactions_type = pages.schema["data"].dataType["repository"].dataType["issues"].dataType["nodes"].dataType.elementType
    assert reactions_type["reactions"].dataType["nodes"].dataType.elementType.simpleString().startswith("struct<user")
    assert nz.item_reactions(pages, "issues").count() == 0


def test_nest_then_explode_gives_table_back(spark):
    sf = "/root/testdata/sf0.001"
    flat = nz.comments(fx.conversation_pages(spark, sf), "issues").select(
        F.col("number").alias("conv_id"), F.col("list_idx").cast("long").alias("turn"),
        F.col("author__login").alias("role"), F.col("body").alias("text"),
    )
    src = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert flat.exceptAll(src).count() == 0 and src.exceptAll(flat).count() == 0


def _sized_pages(spark, tmp_dir, sizes):
    docs = [_page(i, [_item(i * 1000 + j, []) for j in range(n)]) for i, n in enumerate(sizes)]
    return landing.read_pages(spark, _land(tmp_dir, docs))


def test_page_cap_takes_whole_pages(spark, tmp_dir):
    pages = _sized_pages(spark, tmp_dir, [100, 100, 100, 100])
    kept = pg.cap_pages(pages, "issues", 250)
    assert sorted(r.page_no for r in kept.collect()) == [0, 1, 2]
    assert nz.items(pg.capped_pages(pages, "issues", 250), "issues").count() == 300


@pytest.mark.parametrize("cap", [0, None])
def test_falsy_cap_means_no_cap(spark, tmp_dir, cap):
    pages = _sized_pages(spark, tmp_dir, [100, 100, 100, 100])
    assert pg.cap_pages(pages, "issues", cap).count() == 4


def test_pages_after_an_empty_page_are_dropped(spark, tmp_dir):
    pages = _sized_pages(spark, tmp_dir, [3, 0, 5])
    assert [r.page_no for r in pg.cap_pages(pages, "issues", None).collect()] == [0]


def test_blocked_running_sum_matches_plain_window(spark, tmp_dir):
    from quarry.functions.running import exclusive_running_sum

    df = spark.range(0, 5000).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("v")
    )
    got = exclusive_running_sum(df, ["g"], "o", "v", "before", block=64)
    from pyspark.sql import Window

    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("before", F.coalesce(F.sum("v").over(w), F.lit(0)).cast("long"))
    assert got.exceptAll(exp).count() == 0 and got.count() == 5000


def test_error_and_shape_checks(spark, tmp_dir):
    docs = [
        _page(0, [_item(1, [])]),
        _page(1, [_item(2, [])], errors=[{"message": "rate limited"}]),
        _page(2, [_item(3, [])], extra={"organization": {"x": 1}}),
    ]
    pages = landing.read_pages(spark, _land(tmp_dir, docs))
    (row,) = pg.page_problems(pages, "issues").collect()
    assert (row.pages, row.error_pages, row.bad_shape_pages) == (3, 1, 1)
    with pytest.raises(ValueError, match="error_pages=1, bad_shape_pages=1"):
        pg.assert_landed_ok(pages, ["issues"])


@pytest.mark.parametrize("line", [
    '{"owner": "o", "name": "n", "resource": "issues", "page_no": 1, "data": {"repos',
    json.dumps(dict(_page(1, []), data=None)),
    json.dumps(dict(_page(1, []), data={"repository": None})),
    json.dumps(dict(_page(1, []), data={"repository": {"issues": None}})),
    json.dumps(_page(2, [])),  # page 1 is missing
], ids=["cut line", "no data", "no repository", "no connection", "missing page"])
def test_load_fails_on_a_broken_page(spark, tmp_dir, line):
    path = _land(tmp_dir, [_page(0, [_item(1, [])])])
    with open(os.path.join(path, "part-1.json"), "w") as f:
        f.write(line + "\n")
    wh = Warehouse(spark, os.path.join(tmp_dir, "wh"))
    with pytest.raises(ValueError, match="landed pages failed checks"):
        loads.load_reactions(wh, landing.read_pages(spark, path), None, resources=("issues",))


def test_load_fails_on_a_failed_bundle(spark, tmp_dir):
    pages = landing.read_pages(spark, _land(tmp_dir, [_page(0, [_item(1, [])])]))
    failed = {"owner": "o", "name": "n", "request_no": 0, "data": None, "errors": ["timeout"]}
    bundles = landing.read_bundles(spark, _land(tmp_dir, [failed], "bundles"))
    with pytest.raises(ValueError, match="error_pages=1, bad_shape_pages=1, first at bundles"):
        loads.load_reactions(Warehouse(spark, os.path.join(tmp_dir, "wh")), pages, bundles, resources=("issues",))


def test_load_fails_on_a_failed_stargazer_page(spark, tmp_dir):
    doc = {"owner": "o", "name": "n", "resource": "stargazers", "page_no": 0, "landed_at": None,
           "data": {"repository": {"stargazers": {"edges": []}}}, "errors": ["RATE_LIMITED"]}
    pages = landing.read_pages(spark, _land(tmp_dir, [doc]))
    with pytest.raises(ValueError, match="error_pages=1"):
        loads.load_stargazers(Warehouse(spark, os.path.join(tmp_dir, "wh")), pages)


def test_a_page_that_landed_twice_loads_once(spark, tmp_dir):
    first = _page(0, [_item(1, [_comment("c1", "a", "2024-01-01T00:00:00Z")])])
    again = dict(_page(0, [_item(1, [_comment("c1", "b", "2024-01-01T00:00:00Z")])]), landed_at="2024-03-01T00:00:00Z")
    path = _land(tmp_dir, [again, first])
    wh = Warehouse(spark, os.path.join(tmp_dir, "wh"))
    loads.load_reactions(wh, landing.read_pages(spark, path), None, resources=("issues",))
    assert [r.author__login for r in wh.table("gh_data", "issues__comments").collect()] == ["b"]


def test_a_list_of_250_keeps_250(spark, tmp_dir):
    reaction = {"user": {"login": "z", "avatarUrl": None, "url": None}, "content": "HEART",
                "createdAt": "2024-01-01T00:00:00Z"}
    groups = [{"content": "HEART", "createdAt": "2024-01-01T00:00:00Z"}]
    own = [_comment(f"c{k}", "a", "2024-01-01T00:00:00Z", groups) for k in range(250)]
    whole = [_page(0, [_item(1, own, [reaction] * 250)])]
    # the same item, its lists going on in two further lines of the page
    parts = [
        dict(_page(0, [_item(1, own[k : k + 100], [reaction] * len(own[k : k + 100]), 250)]), list_offset=k)
        for k in (0, 100, 200)
    ]
    node = {"id": "c7", "reactions": {"totalCount": 130, "nodes": [reaction] * 130}}
    bundles = landing.read_bundles(
        spark, _land(tmp_dir, [{"owner": "o", "name": "n", "request_no": 0, "data": {"node_0": node}}], "bundles")
    )
    for name, docs in (("whole", whole), ("parts", parts)):
        wh = Warehouse(spark, os.path.join(tmp_dir, "wh_" + name))
        loads.load_reactions(wh, landing.read_pages(spark, _land(tmp_dir, docs, name)), bundles, resources=("issues",))
        comments = wh.table("gh_data", "issues__comments").orderBy("list_idx").collect()
        assert [(r.list_idx, r.id) for r in comments] == [(k, f"c{k}") for k in range(250)]
        assert wh.table("gh_data", "issues__reactions").count() == 250
        assert wh.table("gh_data", "issues__comments__reactions").count() == 130
        (item,) = wh.table("gh_data", "issues").collect()
        assert (item.comments_listed, item.reactions_listed) == (250, 250)


def test_repository_folders_become_columns_and_prune(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pages")
    for name in ("r1", "r2"):
        doc = {k: v for k, v in _page(0, [_item(1, [])]).items() if k not in ("owner", "name")}
        _land(path, [doc], f"owner=o/name={name}")
    pages = landing.read_pages(spark, path)
    items = nz.items(pages, "issues")
    assert sorted((r.owner, r.name) for r in items.collect()) == [("o", "r1"), ("o", "r2")]
    one = nz.items(pages.where(F.col("name") == "r1"), "issues")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(name" in plan
    assert one.count() == 1


def test_event_folders_prune_by_landing_date(spark, tmp_dir):
    path = os.path.join(tmp_dir, "events")
    for day in ("2024-01-02", "2024-01-03"):
        _land(path, [{"id": day, "type": "T", "created_at": f"{day}T00:00:00Z", "payload": {}}], f"landed_date={day}")
    events = landing.read_events(spark, path, landed_since="2024-01-03")
    assert [r.id for r in events.collect()] == ["2024-01-03"]
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed_date" in plan


def test_latest_copy_of_a_page_wins(spark, tmp_dir):
    a = _page(0, [_item(1, [])])
    b = dict(_page(0, [_item(1, []), _item(2, [])]), landed_at="2024-03-01T00:00:00Z")
    landed = landing.read_pages(spark, _land(tmp_dir, [a, b]))
    pages = pg.latest_pages(landed.withColumn("line", F.monotonically_increasing_id()), "line")
    assert nz.items(pages, "issues").count() == 2


def test_reacted_comments_and_attach(spark, tmp_dir):
    groups_yes = [{"content": "THUMBS_UP", "createdAt": "2024-01-01T00:00:00Z"}, {"content": "HEART", "createdAt": None}]
    groups_no = [{"content": "THUMBS_UP", "createdAt": None}]
    docs = [_page(0, [_item(1, [_comment("c1", "a", "2024-01-01T00:00:00Z", groups_yes),
                                 _comment("c2", "b", "2024-01-01T00:00:00Z", groups_no)])])]
    pages = landing.read_pages(spark, _land(tmp_dir, docs))
    comments = nz.comments(pages, "issues")
    reacted = nz.reacted_comments(comments)
    assert [r.id for r in reacted.collect()] == ["c1"]
    assert "reaction_groups" not in reacted.columns

    reaction = {"user": {"login": "z", "avatarUrl": None, "url": None}, "content": "THUMBS_UP",
                "createdAt": "2024-01-01T00:00:00Z"}
    bundle_docs = [
        {"owner": "o", "name": "n", "request_no": 0, "data": {
            "node_0": {"id": "c1", "reactions": {"totalCount": 2, "nodes": [reaction, reaction]}},
            "node_1": {"reactions": None},
            "rateLimit": {"limit": 5000, "cost": 1, "remaining": 10, "resetAt": None}}},
        {"owner": "o", "name": "n", "request_no": 1, "data": {
            "node_2": {"id": "c1", "reactions": {"totalCount": 2, "nodes": [reaction, reaction]}}}},
    ]
    bundles = landing.read_bundles(spark, _land(tmp_dir, bundle_docs, "bundles"))
    nodes = nz.bundle_nodes(bundles)
    assert nodes.count() == 1
    attached = nz.attach_reactions(comments, nodes)
    got = {r.id: (r.reactions_total_count, None if r.reactions is None else len(r.reactions)) for r in attached.collect()}
    assert got == {"c1": (2, 2), "c2": (None, None)}  # no reactions fetched: NULL, not 0
    grand = nz.comment_reactions(attached).collect()
    assert [(r.comment_id, r.list_idx, r.user__login) for r in grand] == [("c1", 0, "z"), ("c1", 1, "z")]


def test_stargazer_edges(spark, tmp_dir):
    doc = {"owner": "o", "name": "n", "resource": "stargazers", "page_no": 0, "landed_at": None,
           "data": {"repository": {"stargazers": {"pageInfo": None, "edges": [
               {"starredAt": "2024-01-05T00:00:00Z", "node": {"login": "s1", "avatarUrl": None, "url": "u"}}]}}}}
    pages = landing.read_pages(spark, _land(tmp_dir, [doc]))
    (row,) = nz.stargazers(pages).collect()
    assert (row.user__login, row.starred_at) == ("s1", dt.datetime(2024, 1, 5))
    assert landing.page_list(pages, "stargazers").endswith("edges")


def test_event_pages_read_arrays_per_line(spark, tmp_dir):
    path = os.path.join(tmp_dir, "events")
    os.makedirs(path)
    with open(os.path.join(path, "p0.json"), "w") as f:
        f.write(json.dumps([{"id": "1", "type": "PushEvent", "created_at": "2024-01-01T00:00:00Z",
                             "actor": {"id": 7, "login": "octo", "display_login": "octo", "url": "u", "avatar_url": "a"},
                             "repo": {"id": 9, "name": "o/r", "url": "u"}, "public": True,
                             "payload": {"size": 1, "commits": [{"sha": "x"}]}},
                            {"id": "2", "type": "WatchEvent", "created_at": "2024-01-01T00:00:01Z", "payload": {}}]) + "\n")
        f.write("[]\n")
    ev = landing.read_events(spark, path)
    rows = ev.orderBy("id").collect()
    assert [r.id for r in rows] == ["1", "2"]
    assert json.loads(rows[0].payload)["commits"][0]["sha"] == "x"  # deeper levels stay packed
    unpacked = nz.unpack_payload(ev, {"size": "bigint"}).orderBy("id").collect()
    assert unpacked[0].payload__size == 1
    from quarry.operators.incremental import events_from_feed

    typed = events_from_feed(ev).orderBy("id").collect()
    assert (typed[0].actor__login, typed[0].repo__name, typed[0].public) == ("octo", "o/r", True)
    assert typed[1].actor__login is None and typed[1].created_at == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_blocked_running_max_matches_plain_window(spark):
    from pyspark.sql import Window

    from quarry.functions.running import exclusive_running

    df = spark.range(0, 3000).select(
        (F.col("id") % 2).alias("g"), F.col("id").alias("o"), ((F.col("id") * 7919) % 1000).alias("v")
    )
    got = exclusive_running(df, ["g"], "o", "v", "prev", how="max", block=50)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("prev", F.max("v").over(w))
    assert got.exceptAll(exp).count() == 0 and got.count() == 3000


def test_long_lists_of_pages_keep_order_and_totals(spark, tmp_dir, monkeypatch):
    """Lists over several blocks and parts, users without an order or an event, null keys."""
    from tools import fixture_pages as fx

    monkeypatch.setattr(fx, "BLOCK_KEYS", 4)
    monkeypatch.setattr(fx, "LIST_PART", 3)
    day = dt.datetime(2024, 1, 1)
    events = [(k, day, 1 if k < 11 else 2, "p") for k in range(13)] + [(None, day, 3, "p"), (20, day, None, "p")]
    orders = [(k, 2, day, "HIGH") for k in range(7)] + [(8, 3, day, "LOW"), (None, 2, day, "LOW")]
    tables = {
        "events": (events, "event_id long, ts timestamp_ntz, user_id long, props string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            [(0, n, 5 * n, day, "AR"[n % 2]) for n in range(10, 0, -1)] + [(99, 1, 1, day, "A")],
            "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz, l_returnflag string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    pages = fx.event_comment_pages(spark, tmp_dir)
    found = {r.number: r for r in nz.items(pages, "issues").collect()}
    assert {n: (r.comments_total_count, r.comments_listed, r.reactions_total_count, r.reactions_listed) for n, r in found.items()} == {
        1: (11, 11, 0, 0), 2: (2, 2, 8, 7), 3: (1, 0, 1, 1)
    }
    comments = nz.comments(pages, "issues").where("number = 1").orderBy("list_idx").collect()
    assert [(r.list_idx, r.id) for r in comments] == [(k, f"e{k}") for k in range(11)]
    nodes = nz.bundle_nodes(fx.comment_bundles(spark, tmp_dir)).orderBy("reactions_offset").collect()
    assert [(r.id, r.reactions_offset, r.reactions.totalCount) for r in nodes] == [("e0", k, 10) for k in (0, 3, 6, 9)]
    assert [x.user.login for r in nodes for x in r.reactions.nodes] == [f"supp{5 * n}" for n in range(1, 11)]


def test_keys_of_data_are_those_of_the_text(spark, tmp_dir):
    lines = ['{"data": {"a": 1, "b": {"c": [1]}}}', '{"data": null}', '{"owner": "o"}', '{"data": [1]}', "broken",
             '{"data": {"repository": {"issues": null}, "rateLimit": null}}', '{"data": {}}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/l")
    keys = [r.data_keys for r in landing.read_pages(spark, f"{tmp_dir}/l").collect()]
    assert keys == [["a", "b"], None, None, None, None, ["repository", "rateLimit"], []]


def test_bundles_are_read_once_for_all_resources(spark, tmp_dir):
    from quarry.plans import loads
    from quarry.sinks.warehouse import Warehouse
    from tools import fixture_pages as fx

    landing.land_json(fx.conversation_pages(spark, "/root/testdata/sf0.001"), f"{tmp_dir}/pages")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    bundles = fx.comment_bundles(spark, "/root/testdata/sf0.001")
    n = bundles.count()
    loads.load_reactions(
        Warehouse(spark, f"{tmp_dir}/wh"), landing.read_pages(spark, f"{tmp_dir}/pages"),
        bundles.mapInArrow(counted, bundles.schema),
    )
    assert read.value == n > 0


def test_staged_pages_are_cut_into_small_row_groups(spark):
    """A reader holds the rows of a row group: pages of thousands of comments are staged a
    few to a group, however many a file has; other copies keep the writer's groups."""
    import pyarrow.parquet as pq

    from quarry.sinks import staging

    body = F.concat_ws("-", F.col("id"), F.col("x"), F.md5(F.concat_ws("-", "id", F.col("x"))))
    lists = spark.range(0, 60, 1, 1).select(
        "id", F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("x")
    ).groupBy("id").agg(F.collect_list(F.struct("x", body.alias("body"))).alias("nodes")).coalesce(1)

    def groups(df, **options):
        staged = staging.stage_parquet(df, "row_groups", **options)
        files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in staged.inputFiles()]
        return staged, [m.row_group(k) for m in files for k in range(m.num_row_groups)]

    staged, nested = groups(lists.select(F.struct("nodes").alias("data")), wide_rows=True)
    assert staged.select(F.explode("data.nodes")).count() == 120_000
    assert len(nested) > 1 and max(g.num_rows for g in nested) < 60
    assert max(g.total_byte_size for g in nested) < 4 * 1024 * 1024
    _, flat = groups(lists.select(F.explode("nodes").alias("node")).select("node.*").coalesce(1))
    assert len(flat) == 1


def test_pages_are_not_shuffled_to_drop_stale_copies(spark, tmp_dir):
    from quarry.sinks.staging import stage_parquet

    docs = [_page(k, [_item(k, [])]) for k in range(5)]
    again = dict(_page(3, [_item(3, []), _item(9, [])]), landed_at="2024-03-01T00:00:00Z")
    landed = landing.read_pages(spark, _land(tmp_dir, [*docs, again]))
    staged = stage_parquet(landed.withColumn("line", F.monotonically_increasing_id()), "pages")
    latest = pg.latest_pages(staged, "line")
    assert sorted(r.page_no for r in latest.collect()) == [0, 1, 2, 3, 4]
    assert nz.items(latest, "issues").where("number = 9").count() == 1
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_a_task_builds_a_bounded_number_of_responses(spark, tmp_dir, monkeypatch):
    """Responses are dealt by the number of rows, not by the session's partitions, and are
    the same however they are dealt."""
    ids = spark.range(4000)
    tables = {
        "events": ids.select(
            F.col("id").alias("event_id"), (F.col("id") % 2500).alias("user_id"),
            F.timestamp_seconds("id").alias("ts"), F.lit("{}").alias("props"),
        ),
        "orders": ids.select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 3000).alias("o_custkey"),
            F.timestamp_seconds("id").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
        ),
        "lineitem": ids.select(
            F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.timestamp_seconds("id").alias("l_shipdate"),
            F.lit(7).cast("long").alias("l_suppkey"), F.lit("A").alias("l_returnflag"),
        ),
        "conversations": ids.select(
            (F.col("id") / 2).cast("long").alias("conv_id"), (F.col("id") % 2).alias("turn"),
            F.lit("user").alias("role"), F.md5(F.col("id").cast("string")).alias("text"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    for build in (fx.event_comment_pages, fx.conversation_pages):
        found = []
        for rows in (100_000, 400):
            monkeypatch.setattr(fx, "ROWS_PER_TASK", rows, raising=False)
            built = build(spark, tmp_dir).select(F.spark_partition_id().alias("task"), F.to_json("data").alias("line")).collect()
            found.append(({r.task for r in built}, sorted(r.line for r in built)))
        (few, lines), (many, same) = found
        assert len(few) == 1 and len(many) > 4
        assert lines == same and len(lines) >= 20
