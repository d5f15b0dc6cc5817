"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame.

Every entry reads the driver tables under ``sf_dir`` (or data Spark derives
from them) in full; nothing is sampled, capped or filtered by id to make a
check cheaper.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators import incremental as inc
from quarry.operators import normalize as nz
from quarry.operators import pages as pg
from quarry.plans import loads, marts
from quarry.session import scratch_path
from quarry.sinks.staging import stage_parquet
from quarry.sinks.warehouse import Warehouse
from quarry.sources import landing
from quarry.sources.replicate import ReplicationSpec, replicate
from quarry.streaming import events as stream_events
from tools import fixture_pages as fx
from tools import oracle
from tools import standins as s

Query = Callable[[SparkSession, str], DataFrame]


def q_top_comment_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_comment_authors(
        s.issue_comments(spark, sf_dir), s.pull_request_comments(spark, sf_dir)
    )


def q_comment_volume_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.comment_volume_by_day(
        s.issue_comments(spark, sf_dir), s.pull_request_comments(spark, sf_dir)
    )


def q_avg_comment_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = marts.avg_comment_length(
        s.issue_comment_bodies(spark, sf_dir), s.pull_request_comment_bodies(spark, sf_dir)
    )
    return _rounded(table, "avg_length")


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Means to six places, for comparison; stored tables keep them whole."""
    return df.select(*(F.round(c, 6).alias(c) if c in cols else c for c in df.columns))


TEAM_MEANS = ("avg_first_reply_secs", "avg_resolution_secs", "avg_csat")


def q_team_performance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(marts.team_performance_summary(s.tickets(spark, sf_dir)), *TEAM_MEANS)


def q_nps_by_subscription_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.nps_by_subscription_month(s.nps_responses(spark, sf_dir))


def q_user_core_activity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_core_activity_summary(
        s.users(spark, sf_dir),
        s.tickets(spark, sf_dir),
        s.teams(spark, sf_dir),
        s.app_events(spark, sf_dir),
    )


def _size_or_null(c):
    """List length that stays NULL for a missing list (no reactions fetched)."""
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(F.size(c))


def q_normalize_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = nz.comments(fx.conversation_pages(spark, sf_dir), "issues")
    return c.select("owner", "name", "number", "list_idx", "id", "body", "author__login", "created_at")


def _item_totals(spark: SparkSession, sf_dir: str, list_cap: int | None) -> DataFrame:
    it = nz.items(fx.event_comment_pages(spark, sf_dir), "issues", list_cap=list_cap)
    return it.select(
        "number",
        "reactions_total_count",
        "comments_total_count",
        "comments_listed",
        "reactions_listed",
        "comments_truncated",
    )


def q_normalize_item_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole lists."""
    return _item_totals(spark, sf_dir, None)


def q_normalize_item_totals_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-5: at most 50 elements of each list counted, cut lists flagged."""
    return _item_totals(spark, sf_dir, 50)


def q_reacted_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = nz.reacted_comments(nz.comments(fx.event_comment_pages(spark, sf_dir), "issues"))
    return c.select("number", "list_idx", "id", "author__login", "created_at")


def _attached(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    comments = nz.comments(pages if pages is not None else fx.event_comment_pages(spark, sf_dir), "issues")
    return nz.attach_reactions(comments, nz.bundle_nodes(fx.comment_bundles(spark, sf_dir)))


def q_attach_comment_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per comment; a continued reaction list adds its length.
    a = _attached(spark, sf_dir).groupBy("number", "id").agg(
        F.max("reactions_total_count").alias("reactions_total_count"),
        F.sum(_size_or_null(F.col("reactions"))).cast("int").alias("n_reactions"),
    )
    return a.select("number", "id", "reactions_total_count", "n_reactions")


def q_comment_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-4: comments asked for and answered, matched: requests 3, 13, 23, ... were lost,
    and so were the pages of every seventh item."""
    comments = nz.comments(fx.event_comment_pages(spark, sf_dir), "issues").where("number % 7 != 3")
    bundles = fx.comment_bundles(spark, sf_dir).where("request_no % 10 != 3")
    return nz.reconciled(comments, bundles)


def q_item_and_comment_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["number", "list_idx", "user__login", "content", "created_at"]
    pages = stage_parquet(fx.event_comment_pages(spark, sf_dir), "event_comment_pages", wide_rows=True)
    on_comments = nz.comment_reactions(_attached(spark, sf_dir, pages)).select(
        F.lit("comment").alias("level"), "comment_id", *cols
    )
    on_items = nz.item_reactions(pages, "issues").select(
        F.lit("item").alias("level"), F.lit(None).cast("string").alias("comment_id"), *cols
    )
    return on_comments.unionByName(on_items)


def q_stargazers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3 from landed JSON: checked, each page once, loaded into a table."""
    path = landing.land_json(fx.stargazer_pages(spark, sf_dir), scratch_path(spark, "landing"))
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    loads.load_stargazers(wh, landing.read_pages(spark, path))
    st = wh.table("gh_data", "stargazers")
    return st.select("owner", "name", "starred_at", "user__login", "user__url")


def _taken_items(landed: DataFrame, max_items: int | None) -> DataFrame:
    pages = pg.capped_pages(landed, "issues", max_items)
    return nz.items(pages, "issues").select("name", "page_no", "number", "created_at")


def q_page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-3: the scheduled load's cap of 250 items a repository, at page grain."""
    return _taken_items(stage_parquet(fx.event_item_pages(spark, sf_dir), "event_item_pages"), 250)


def q_page_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load without a cap: every page."""
    return _taken_items(stage_parquet(fx.event_item_pages(spark, sf_dir), "event_item_pages"), None)


def q_page_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-4: every page up to the empty one; the stale pages behind it stay out."""
    return _taken_items(stage_parquet(fx.closed_item_pages(spark, sf_dir), "closed_item_pages"), None)


def q_pages_by_repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10: several repositories, a landing folder each, read at once; owner and
    name come from the folders."""
    pages = fx.event_item_pages(spark, sf_dir)
    path = landing.land_json(pages, scratch_path(spark, "landing"), folders=("owner", "name"))
    items = nz.items(landing.read_pages(spark, path), "issues")
    return items.select("owner", "name", "page_no", "item_idx", "number", "title")


def q_bundle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landing.land_json(fx.comment_bundles(spark, sf_dir), scratch_path(spark, "landing"))
    return pg.bundle_audit(landing.read_bundles(spark, path))


def q_landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4: landed REST pages (JSON arrays in folders by landing date), all days."""
    path = scratch_path(spark, "landing")
    fx.event_array_lines(spark, sf_dir).write.partitionBy("landed_date").text(path)
    events = inc.events_from_feed(landing.read_events(spark, path))
    return events.select("id", "type", "created_at", "payload")


def q_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.load_audit(fx.event_item_pages(spark, sf_dir), "issues")


def q_page_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_problems(fx.event_item_pages(spark, sf_dir), "issues")


# Three overlapping loads of the event feed, the last one run twice. Purchase
# events of Jan 8-10 reach the feed late (only with the second load) and are
# older than the cursor by then, so they are dropped as late.
LOAD_WINDOWS = (
    (None, "2024-01-11", ("purchase", "2024-01-08")),
    ("2024-01-08", "2024-01-21", None),
    ("2024-01-19", None, None),
    ("2024-01-19", None, None),
)


def _window(feed: DataFrame, start: str | None, end: str | None, delayed) -> DataFrame:
    ts = F.col("created_at")
    kind = feed.schema["created_at"].dataType

    def at(day: str):
        return F.lit(day).cast(kind)

    cond = F.lit(True)
    if start:
        cond = cond & (ts >= at(start))
    if end:
        cond = cond & (ts < at(end))
    if delayed:
        etype, since = delayed
        cond = cond & ~((F.col("type") == etype) & (ts >= at(since)))
    return feed.where(cond)


def q_incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = inc.events_from_feed(fx.event_feed(spark, sf_dir))
    table = inc.IncrementalTable(spark, scratch_path(spark, "incremental_events"))
    for start, end, delayed in LOAD_WINDOWS:
        table.load(_window(feed, start, end, delayed))
    return table.target().select("id", "type", "created_at", "payload")


def q_incremental_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping landings, each followed by an available-now run."""
    base = scratch_path(spark, "event_stream")
    landing, target, ckpt = f"{base}/landing", f"{base}/target", f"{base}/checkpoint"
    feed = fx.event_feed(spark, sf_dir)
    for i, (start, end, _) in enumerate(LOAD_WINDOWS[:3]):
        # ISO text sorts as time, so the feed is cut as it landed.
        _window(feed, start, end, None).write.json(f"{landing}/load={i}")
        stream_events.run_available(spark, f"{landing}/*", target, ckpt, delay="3 days", max_files_per_trigger=4)
    return spark.read.parquet(target).select("id", "type", "created_at", "payload")


def q_events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 + ARR-4: the feed stored partitioned by type and read back once; events
    whose id is a multiple of 97 have no type and get a folder like any other."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    feed = nz.unpack_payload(inc.events_from_feed(fx.event_feed(spark, sf_dir)), {"k": "bigint"})
    feed = feed.withColumn("type", F.when(F.col("id").cast("long") % 97 != 0, F.col("type")))
    wh.replace_table(feed.drop("created_date"), "repo_events", "events", partition_by=["type"])
    return wh.table("repo_events", "events").select("id", "type", "created_at", "payload__k", "payload")


def _pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of pulls that a load of the landed feed writes: a pull a landing day."""
    path, target = scratch_path(spark, "landing"), scratch_path(spark, "repo_events")
    fx.event_array_lines(spark, sf_dir).write.partitionBy("landed_date").text(path)
    loads.load_repo_events(landing.read_events(spark, path), target, pull_col="landed_date")
    pulls = inc.IncrementalTable(spark, target).pulls()
    return pulls.select(F.lit("driver/events").alias("repo"), F.date_sub("pull", 1).alias("pull_day"), "n_events", "oldest", "newest")


def q_event_gap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-5 on the pulls of a load, each holding all events of its day."""
    return inc.gaps_between(_pulls(spark, sf_dir), ["repo"], "pull_day")


def q_event_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-5: the stretches of time that the pulls of a load cover."""
    return inc.covered_intervals(_pulls(spark, sf_dir), ["repo"])


def _landed_windows(spark: SparkSession, sf_dir: str, planted: bool) -> list[str]:
    """The feed landed in the overlapping windows, a folder each, as JSON lines; if
    ``planted``, with broken lines and events without an id or a time."""
    base = scratch_path(spark, "landing")
    lines = fx.broken_event_lines(spark, sf_dir, planted)
    paths = []
    for i, (start, end, delayed) in enumerate(LOAD_WINDOWS):
        _window(lines, start, end, delayed).select("value").write.text(f"{base}/load={i}")
        paths.append(f"{base}/load={i}")
    return paths


def q_event_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-1, INC-2, SRC-4: what became of every row read by four overlapping loads."""
    target = scratch_path(spark, "repo_events")
    for path in _landed_windows(spark, sf_dir, planted=True):
        loads.load_repo_events(landing.read_events(spark, path), target)
    return inc.IncrementalTable(spark, target).runs().drop("cursor")


def q_event_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4, INC-2: the rejected rows of one load, with reason and broken line."""
    path, target = scratch_path(spark, "landing"), scratch_path(spark, "repo_events")
    fx.broken_event_lines(spark, sf_dir, True).select("value").write.text(path)
    loads.load_repo_events(landing.read_events(spark, path), target)
    rejected = inc.IncrementalTable(spark, target).rejected()
    line = F.when(F.col("reason") == "line is not JSON", F.col("raw"))
    return rejected.select("reason", "id", "type", "created_at", "payload", line.alias("line"))


def q_event_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-3: late rows, told from repeats by the id index, with the cursor they missed."""
    target = scratch_path(spark, "repo_events")
    for path in _landed_windows(spark, sf_dir, planted=False):
        loads.load_repo_events(landing.read_events(spark, path), target)
    return inc.IncrementalTable(spark, target).late().select("id", "type", "created_at", "payload", "missed_cursor")


def q_event_type_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 in the stream: each landing a micro-batch, each event type a table; all
    type tables read back."""
    base = scratch_path(spark, "event_stream")
    table = inc.IncrementalTable(spark, f"{base}/target")
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    names: list[str] = []
    lines = fx.broken_event_lines(spark, sf_dir, False)
    for i, (start, end, delayed) in enumerate(LOAD_WINDOWS):
        _window(lines, start, end, delayed).select("value").write.text(f"{base}/landing/load={i}")
        names = stream_events.run_into_tables(spark, f"{base}/landing/*", table, f"{base}/checkpoint", wh)
    return reduce(
        DataFrame.unionByName,
        [
            wh.table("repo_events", n).select(F.lit(n).alias("table_name"), "id", "created_at", "payload")
            for n in names
        ],
    )


def _payload_tables(spark: SparkSession, sf_dir: str) -> Warehouse:
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    loads.load_event_payloads(wh, inc.events_from_feed(fx.nested_event_feed(spark, sf_dir)))
    return wh


def q_event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARR-4: push and comment events with their payloads as columns; a comment's user is
    level 3 and stays packed."""
    wh = _payload_tables(spark, sf_dir)
    cols = ["id", "created_at", "payload__push_id", "payload__ref", "payload__action", "payload__comment__id",
            "payload__comment__body", "payload__comment__user", "payload__amount", "payload__unparsed"]
    tables = [wh.table("repo_events", f"events_{kind}") for kind in ("click", "view", "signup", "purchase", "error")]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return every.select("type", *cols)


def q_event_payload_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARR-4: the child tables of the lists in payloads: commits, whose author and
    parents stay packed, and labels."""
    wh = _payload_tables(spark, sf_dir)
    commits = wh.table("repo_events", "events_click__payload__commits")
    labels = wh.table("repo_events", "events_purchase__payload__labels")
    return commits.select(
        F.lit("commits").alias("list"), "id", "list_idx", "sha", "distinct", "author", "parents", F.lit(None).cast("string").alias("value")
    ).unionByName(labels.select(F.lit("labels").alias("list"), "id", "list_idx", "value"), allowMissingColumns=True)


REPLICATED_STREAMS = {
    "public.tickets": s.tickets,
    "public.events": s.app_events,
    "public.teams": s.teams,
    "public.users": s.users,
    "public.nps_responses": s.nps_responses,
}


def q_replicate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReplicationSpec({name: None for name in REPLICATED_STREAMS})
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    return replicate(spec, lambda stream, _opts: REPLICATED_STREAMS[stream](spark, sf_dir), wh)


def q_contract_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8: three loads of a table whose columns grow and widen; all versions, each
    under its own contract."""
    ev = s.read(spark, sf_dir, "events")
    loads_ = [
        ev.select((F.col("event_id") % 1000).cast("int").alias("id"), F.col("event_type").alias("name")),
        ev.select(F.col("event_id").alias("id"), F.col("event_type").alias("name"), F.col("user_id").cast("int").alias("user_id")),
        ev.select(F.col("event_id").alias("id"), F.col("user_id").alias("user_id"), F.col("ts")),
    ]
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), keep_versions=3)
    for df in loads_:
        wh.replace_table(df, "main", "events", evolve=True)
    versions = [
        wh.snapshot("main", k).table("events").select(F.lit(k).alias("version"), "*") for k in range(len(loads_))
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), versions)


def q_table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    summary = marts.team_performance_summary(s.tickets(spark, sf_dir))
    wh.replace_table(summary, "analytics", "team_performance_summary", contract=schemas.TEAM_PERFORMANCE_SUMMARY)
    return wh.statistics("analytics", "team_performance_summary").drop("estimated_size")


def _loaded_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Land both resources (events as issue comments, conversations as pull
    request comments), load them end to end into ``gh_data``."""
    base = scratch_path(spark, "landing")
    landing.land_json(
        fx.event_comment_pages(spark, sf_dir).unionByName(
            fx.conversation_pages(spark, sf_dir, resource="pull_requests")
        ),
        f"{base}/pages",
    )
    landing.land_json(fx.comment_bundles(spark, sf_dir), f"{base}/bundles")
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    loads.load_reactions(
        wh,
        landing.read_pages(spark, f"{base}/pages"),
        landing.read_bundles(spark, f"{base}/bundles"),
        dataset="gh_data",
    )
    return wh


def q_pipeline_comment_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _loaded_warehouse(spark, sf_dir)
    return marts.top_comment_authors(wh.table("gh_data", "issues__comments"), wh.table("gh_data", "pull_requests__comments"))


def q_pipeline_avg_comment_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _loaded_warehouse(spark, sf_dir)
    table = marts.avg_comment_length(wh.table("gh_data", "issues__comments"), wh.table("gh_data", "pull_requests__comments"))
    return _rounded(table, "avg_length")


def q_load_and_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: landed JSON and the product tables loaded, the six derived tables
    written under their contracts; their statistics rows."""
    wh = _loaded_warehouse(spark, sf_dir)
    spec = ReplicationSpec({name: None for name in REPLICATED_STREAMS})
    replicate(spec, lambda stream, _opts: REPLICATED_STREAMS[stream](spark, sf_dir), wh)
    return loads.derive_analytics(wh).drop("estimated_size")


QUERIES: dict[str, Query] = {
    "top_comment_authors": q_top_comment_authors,
    "comment_volume_by_day": q_comment_volume_by_day,
    "avg_comment_length": q_avg_comment_length,
    "team_performance_summary": q_team_performance_summary,
    "nps_by_subscription_month": q_nps_by_subscription_month,
    "user_core_activity_summary": q_user_core_activity_summary,
    "normalize_comments": q_normalize_comments,
    "normalize_item_totals": q_normalize_item_totals,
    "normalize_item_totals_capped": q_normalize_item_totals_capped,
    "reacted_comments": q_reacted_comments,
    "attach_comment_reactions": q_attach_comment_reactions,
    "comment_reconciliation": q_comment_reconciliation,
    "item_and_comment_reactions": q_item_and_comment_reactions,
    "stargazers": q_stargazers,
    "page_cap": q_page_cap,
    "page_uncapped": q_page_uncapped,
    "page_stop": q_page_stop,
    "pages_by_repository": q_pages_by_repository,
    "bundle_audit": q_bundle_audit,
    "landed_events": q_landed_events,
    "load_audit": q_load_audit,
    "page_errors": q_page_errors,
    "incremental_events": q_incremental_events,
    "incremental_events_stream": q_incremental_events_stream,
    "events_by_type": q_events_by_type,
    "event_gap_audit": q_event_gap_audit,
    "event_payloads": q_event_payloads,
    "event_payload_lists": q_event_payload_lists,
    "event_coverage": q_event_coverage,
    "event_load_counts": q_event_load_counts,
    "event_dead_letters": q_event_dead_letters,
    "event_late_rows": q_event_late_rows,
    "event_type_tables": q_event_type_tables,
    "replicate_tables": q_replicate_tables,
    "contract_versions": q_contract_versions,
    "table_statistics": q_table_statistics,
    "pipeline_comment_authors": q_pipeline_comment_authors,
    "pipeline_avg_comment_length": q_pipeline_avg_comment_length,
    "load_and_derive": q_load_and_derive,
}

ORACLE_SQL: dict[str, str] = {name: getattr(oracle, name.upper()) for name in QUERIES}
