"""Dataset commits, statistics without a scan, widening contracts, stored order,
ranges of any key, reconciliation."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators import normalize as nz
from quarry.plans import loads
from quarry.sinks import warehouse as wm
from quarry.sinks.ledger import Ledger
from quarry.sinks.warehouse import ContractError, Warehouse
from quarry.sources.replicate import ReplicationSpec, content_hash, jdbc_reader, range_predicates, replicate, sql_literal

SF = "/root/testdata/sf0.001"


def _n(spark, n):
    return spark.range(n).withColumnRenamed("id", "v")


def _counts(snapshot):
    return {t: snapshot.table(t).count() for t in sorted(snapshot.versions)}


@pytest.mark.parametrize("dies_at", ["second table", "manifest"])
def test_a_load_that_dies_leaves_the_old_set(spark, tmp_dir, monkeypatch, dies_at):
    wh = Warehouse(spark, tmp_dir)
    with wh.commit("main") as c:
        c.replace_table(_n(spark, 1), "a")
        c.replace_table(_n(spark, 2), "b")
    before = wh.snapshot("main")

    def dies(*args, **kw):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        if dies_at == "manifest":
            m.setattr(Ledger, "append", dies)
        with pytest.raises(RuntimeError):
            with wh.commit("main") as c:
                c.replace_table(_n(spark, 10), "a")
                if dies_at == "second table":
                    dies()
                c.replace_table(_n(spark, 20), "b")
    assert _counts(wh.snapshot("main")) == {"a": 1, "b": 2}
    assert (wh.table("main", "a").count(), spark.table(wh.name("main", "a")).count()) == (1, 1)
    with wh.commit("main") as c:
        c.replace_table(_n(spark, 100), "a")
        c.replace_table(_n(spark, 200), "b")
        c.replace_table(_n(spark, 300), "c")
    # A reader of the old set keeps it whole; the dead load's version is gone.
    assert _counts(before) == {"a": 1, "b": 2}
    assert _counts(wh.snapshot("main")) == {"a": 100, "b": 200, "c": 300}
    assert _counts(wh.snapshot("main", 0)) == {"a": 1, "b": 2}
    assert len(wh._versions("main", "a")) == 2


def test_names_follow_a_commit_that_died_behind_its_manifest(spark, tmp_dir, monkeypatch):
    wh = Warehouse(spark, tmp_dir)
    wh.replace_table(_n(spark, 1), "main", "a")
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "point_views", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            wh.replace_table(_n(spark, 2), "main", "a")
    assert wh.table("main", "a").count() == 2  # the manifest decides
    wh.point_views("main")
    assert spark.table(wh.name("main", "a")).count() == 2


def test_statistics_scan_nothing(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir)
    wh.replace_table(spark.range(1_000).withColumn("p", F.col("id") % 3), "main", "t", partition_by=["p"])
    stats = wh.statistics("main", "t")
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Exchange" not in plan
    row = stats.first()
    assert (row.num_rows, row.column_count) == (1_000, 2) and row.estimated_size > 0
    wh.replace_table(spark.range(0), "main", "empty")
    assert wh.statistics("main", "empty").first().num_rows == 0


def test_written_rows_are_counted_once_under_skew(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir)
    df = spark.range(0, 50_000, 1, 16).select(F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).alias("k"))
    wh.replace_table(df.groupBy("k").count().join(df, "k").repartition(8, "k"), "main", "t")
    assert wh.statistics("main", "t").first().num_rows == 50_000


def test_contracts_widen_and_are_kept_per_version(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir, keep_versions=3)
    wh.replace_table(spark.createDataFrame([(1, "a")], "id int, s string"), "main", "t", evolve=True)
    wide = spark.createDataFrame([(2**40, 1.5)], "id long, x float")
    wh.replace_table(wide, "main", "t", evolve=True)
    assert wh.table("main", "t").dtypes == [("id", "bigint"), ("s", "string"), ("x", "float")]
    assert [tuple(r) for r in wh.table("main", "t").collect()] == [(2**40, None, 1.5)]
    new, old = wh.contracts("main", "t").values()
    assert wm.contract_changes(old, new) == ["new column x float", "id widened from int to bigint"]


@pytest.mark.parametrize("kind", ["int", "string", "double", "date"])
def test_narrowing_is_refused_and_nothing_is_written(spark, tmp_dir, kind):
    wh = Warehouse(spark, tmp_dir)
    wh.replace_table(spark.createDataFrame([(1,)], "id long"), "main", "t", evolve=True)
    with pytest.raises(ContractError, match="id: bigint does not widen to " + kind):
        wh.replace_table(spark.createDataFrame([], f"id {kind}"), "main", "t", evolve=True)
    assert wh.table("main", "t").dtypes == [("id", "bigint")] and len(wh._versions("main", "t")) == 1


def test_nested_contracts_widen(spark):
    old = StructType.fromDDL("a struct<x: int>, l array<int>, d decimal(5,2), m map<string,int>, t date")
    new = StructType.fromDDL("a struct<x: bigint, y: string>, l array<bigint>, d decimal(7,3), m map<string,bigint>, t timestamp_ntz")
    got = wm.widened_schema(old, new)
    assert got.simpleString() == (
        "struct<a:struct<x:bigint,y:string>,l:array<bigint>,d:decimal(7,3),m:map<string,bigint>,t:timestamp_ntz>"
    )
    with pytest.raises(ContractError, match="a.x"):
        wm.widened_schema(new, old)


def test_stored_order_is_read_back(spark, tmp_dir):
    wh = Warehouse(spark, tmp_dir)
    rows = [(k % 7, f"n{k}") for k in range(40)] + [(None, "last")]
    random.Random(1).shuffle(rows)
    wh.replace_table(spark.createDataFrame(rows, "x int, n string").repartition(6), "main", "t", order_by=["x desc", "n"])
    want = sorted(rows[:], key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r) for r in wh.ordered_table("main", "t").collect()] == want
    wh.replace_table(spark.range(3), "main", "u")
    assert wh.ordered_table("main", "u").count() == 3


# ---------------------------------------------------------------------------
# Ranges of any key

#: This database numbers rows in the order of a subquery only.
DERBY_NUMBERED = (
    "SELECT {columns}, ROW_NUMBER() OVER () AS rn FROM "
    "(SELECT {columns} FROM {table} WHERE {present} ORDER BY {columns}) o"
)


def _derby(spark, rows, schema):
    url = f"jdbc:derby:memory:r{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame(rows, schema)
    texts = ", ".join(f"{c} VARCHAR(36)" for c, kind in df.dtypes if kind == "string")
    writer = df.write.option("createTableColumnTypes", texts) if texts else df.write
    writer.jdbc(url, "APP.T", properties=props)
    return df, lambda split, n: jdbc_reader(spark, url, props, rows_per_query=n, numbered=DERBY_NUMBERED)("APP.T", {"split_by": split})


def _sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_uuid_text_time_and_hot_keys_are_cut_evenly(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (str(uuid.UUID(int=rng.getrandbits(128))), 7 if k % 10 else k, f"it's {rng.randint(0, 400)}",
         start + dt.timedelta(seconds=rng.randint(0, 10**6)))
        for k in range(4_000)
    ]
    df, read = _derby(spark, rows, "ID string, HOT long, NAME string, STAMP timestamp")
    for split in ("ID", ["HOT", "ID"], "NAME", ["STAMP", "ID"]):
        got = read(split, 400)
        assert got.rdd.getNumPartitions() == 10 + 1
        assert got.exceptAll(df).count() == 0 and got.count() == 4_000
        assert max(_sizes(got)) <= 2 * 4_000 / 10, split
    # 90% of one value: alone it cannot be cut, with the key it is.
    assert max(_sizes(read("HOT", 400))) > 3_000


def test_rows_without_a_value_are_read_once(spark):
    rows = [(k if k % 3 else None, k % 5 if k % 4 else None) for k in range(300)]
    df, read = _derby(spark, rows, "ID long, N long")
    for split in ("ID", "N", ["N", "ID"], ["ID", "N"]):
        got = read(split, 20)
        assert got.count() == 300 and got.exceptAll(df).count() == 0
    empty, read = _derby(spark, [], "ID long, N long")
    assert read(["N", "ID"], 20).count() == 0


def test_every_row_is_in_one_range():
    import sqlite3

    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE t (a, b)")
    values = [None, 1, 2, 3, 4]
    con.executemany("INSERT INTO t VALUES (?, ?)", [(a, b) for a in values for b in values])
    for bounds in ([], [(2, 2)], [(1, 1), (2, 3), (2, 4), (4, 1)]):
        counts = con.execute("SELECT " + ", ".join(f"sum(CASE WHEN {p} THEN 1 ELSE 0 END)" for p in range_predicates(["a", "b"], bounds)) + " FROM t").fetchone()
        assert sum(counts) == 25
    assert sql_literal("o'x") == "'o''x'" and sql_literal(3) == "3"
    assert sql_literal(dt.datetime(2024, 1, 2, 3, 4, 5, 6)) == "{ts '2024-01-02 03:04:05.000006'}"


def test_replicated_tables_are_told_by_their_content(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x", 1.5, None), (2, "y", None, True)], "a int, b string, c double, d boolean")
    assert content_hash(a).first() == content_hash(a.orderBy(F.desc("a")).select("d", "c", "b", "a")).first()
    assert content_hash(a).first() != content_hash(a.withColumn("a", F.lit(1))).first()
    assert content_hash(a.where("false")).first().content_hash == "0"
    wh = Warehouse(spark, tmp_dir)
    out = replicate(ReplicationSpec({"s.one": None, "s.two": None}), lambda st, _o: a if st == "s.one" else a.limit(1), wh)
    got = {r.table_name: r for r in out.collect()}
    assert got["s_one"].num_rows == 2 and got["s_one"].content_hash == content_hash(a).first().content_hash
    assert wh.snapshot("main").number == 0  # both in one commit


def test_comments_are_matched_with_their_answers(spark):
    groups = "array<struct<content:string,createdAt:string>>"
    comments = spark.createDataFrame(
        [("a", [("X", "2024")]), ("b", [("X", "2024")]), ("c", [("X", None)]), ("d", None), (None, [("X", "2024")])],
        f"id string, reaction_groups {groups}",
    )
    node = "map<string,struct<id:string,x:int>>"
    bundles = spark.createDataFrame(
        [({"node_0": ("a", 1), "rateLimit": (None, 1)},), ({"node_0": ("a", 1), "node_1": ("c", 1), "node_2": (None, 1)},)],
        f"data {node}",
    )
    got = {r.id: (r.status, r.n_answers) for r in nz.reconciled(comments, bundles).collect()}
    assert got == {"a": ("answered", 2), "b": ("unanswered", 0), "c": ("unasked", 1), None: ("unanswered", 0)}


def test_a_dataset_load_that_dies_between_tables_keeps_the_old_dataset(spark, tmp_dir, monkeypatch):
    from tools import fixture_pages as fx
    from quarry.sources import landing

    landing.land_json(fx.conversation_pages(spark, SF), f"{tmp_dir}/pages")
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    pages = landing.read_pages(spark, f"{tmp_dir}/pages")
    loads.load_reactions(wh, pages, None, resources=("issues",))
    before = _counts(wh.snapshot("gh_data"))
    write, calls = Warehouse.write_version, []

    def dies_at_the_third(self, *a, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost the driver")
        return write(self, *a, **kw)

    monkeypatch.setattr(Warehouse, "write_version", dies_at_the_third)
    with pytest.raises(RuntimeError):
        loads.load_reactions(wh, pages.where("page_no = 0"), None, resources=("issues",), check=False)
    assert _counts(wh.snapshot("gh_data")) == before and len(before) == 4
