"""End-to-end loads: landed pages -> normalised tables -> derived tables.

These functions wire the operators the way the reference's scheduled assets
do, as plain Spark jobs (no scheduler: run them from whatever runs jobs).

* ``load_reactions``: issues / pull requests with comments and reactions
  (SRC-1, SRC-2, SRC-5, SRC-9, FLT-1..7, JN-4, ARR-1..3, SNK-1, SNK-9);
* ``load_stargazers``: SRC-3, SNK-1;
* ``load_repo_events``: incremental, table per event type (INC-1..4, SNK-2, SNK-3);
* ``derive_analytics``: the six derived tables with enforced contracts and a
  statistics row for each (SNK-4, SNK-5, SNK-7, SNK-8).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas
from quarry.operators import incremental as inc
from quarry.operators import nested
from quarry.operators import normalize as nz
from quarry.operators import pages as pg
from quarry.plans import marts
from quarry.sinks import type_tables
from quarry.sinks.staging import stage_parquet
from quarry.sinks.warehouse import Warehouse

REACTION_RESOURCES = ("issues", "pull_requests")
LINE_ID = "_line"
RESOURCE = "_resource"


def normalised_tables(
    pages: DataFrame,
    bundles: DataFrame | None,
    resources: tuple[str, ...],
    max_items: int | None = None,
) -> dict[str, DataFrame]:
    """The tables the resources load into, keyed by table name.

    ``pages`` should be a staged (Parquet) copy: it is read by the cap and by
    every table. The comments with their reactions feed two tables a resource, so they
    are staged once as well instead of being re-joined per table; later reads
    prune to the nested columns each table needs. The comments of all resources meet the
    reactions in one join: those are read and shuffled once. Only comments with any
    reaction are looked up (FLT-1); the rest keep NULL.
    """
    kept = {resource: pg.capped_pages(pages, resource, max_items) for resource in resources}
    comments = reduce(
        DataFrame.unionByName,
        [nz.comments(kept[r], r).withColumn(RESOURCE, F.lit(r)) for r in resources],
    )
    if bundles is not None:
        nodes = nz.bundle_nodes(bundles)
    else:
        nodes = comments.sparkSession.createDataFrame(
            [], "id string, reactions_offset long, reactions " + schemas.REACTION_CONNECTION.simpleString()
        )
    attached = stage_parquet(nz.attach_reactions(comments, nodes, only_reacted=True), "comments", wide_rows=True)
    tables = {}
    for resource in resources:
        own = attached.where(F.col(RESOURCE) == resource).drop(RESOURCE)
        tables |= {
            resource: nz.items(kept[resource], resource),
            f"{resource}__comments": nz.commented(own),
            f"{resource}__reactions": nz.item_reactions(kept[resource], resource),
            f"{resource}__comments__reactions": nz.comment_reactions(own),
        }
    return tables


def landed_once(pages: DataFrame, bundles: DataFrame | None, resources: tuple[str, ...], check: bool) -> DataFrame:
    """The chosen resources' landed lines, parsed once, checked, each page once.

    All lines are staged and checked before anything is filtered away: a broken
    line has no resource to choose it by.
    """
    mine = F.col("resource").isin(*resources)
    if "corrupt" in pages.columns:
        mine = mine | F.col("corrupt")
    staged = stage_parquet(pages.where(mine).withColumn(LINE_ID, F.monotonically_increasing_id()), "pages", wide_rows=True)
    if check:
        pg.assert_landed_ok(staged, resources, bundles)
    return pg.latest_pages(staged.where(F.col("resource").isin(*resources)), LINE_ID).drop(LINE_ID)


def load_reactions(
    warehouse: Warehouse,
    pages: DataFrame,
    bundles: DataFrame | None = None,
    dataset: str = "gh_data",
    resources: tuple[str, ...] = REACTION_RESOURCES,
    max_items: int | None = None,
    check: bool = True,
) -> list[str]:
    """Replace the tables of the chosen resources in ``dataset``.

    ``resources`` picks a subset (SRC-9): resources not asked for are never
    scanned. ``check`` fails the load on any broken line, error response, wrong
    shape or missing page, of the pages or the bundles, before anything is
    written (FLT-6, FLT-7). A page that landed twice loads once.
    """
    if bundles is not None:
        # Parsed once, for the check and the join.
        bundles = stage_parquet(pg.shaped(bundles), "bundles", wide_rows=True)
    pages = landed_once(pages, bundles, resources, check)
    # All tables of the dataset are swapped by one commit.
    with warehouse.commit(dataset) as writing:
        return [
            writing.replace_table(df, table)
            for table, df in normalised_tables(pages, bundles, resources, max_items).items()
        ]


def load_stargazers(
    warehouse: Warehouse, pages: DataFrame, dataset: str = "gh_data", max_items: int | None = None, check: bool = True
) -> str:
    kept = pg.capped_pages(landed_once(pages, None, ("stargazers",), check), "stargazers", max_items)
    warehouse.replace_table(nz.stargazers(kept), dataset, "stargazers")
    return f"{dataset}.stargazers"


def load_repo_events(feed: DataFrame, target_path: str, pull_col: str | None = None) -> dict:
    """One incremental run of the event feed into a table partitioned by type.

    Returns the run's counts: loaded, late, repeated and rejected rows are the rows
    read. The pull of each row (its landed file, unless ``pull_col`` names another
    column) is kept in the table's ledger of pulls.
    """
    pull_col = pull_col or ("page_path" if "page_path" in feed.columns else None)
    table = inc.IncrementalTable(feed.sparkSession, target_path)
    return table.load(inc.events_from_feed(feed, pull_col))


def load_event_payloads(
    warehouse: Warehouse, events: DataFrame, dataset: str = "repo_events", max_level: int = 2
) -> list[str]:
    """ARR-4, SNK-3: a table for each event type with its payload unpacked to
    ``max_level``, and a child table for each list in it.

    One aggregate finds the types of all payloads; each type is one pruned scan.
    """
    staged = stage_parquet(events, "events")
    written = []
    with warehouse.commit(dataset) as writing:
        for kind, types in nested.found_types(staged, "payload", "type").items():
            rows = staged.where(F.col("type").eqNullSafe(F.lit(kind)))
            name = type_tables.table_name(kind, "events")
            for table, df in nested.unpacked(rows, ["id"], name, max_level=max_level, types=types).items():
                written.append(writing.replace_table(df, table))
    return written


def derive_analytics(
    warehouse: Warehouse,
    gh_dataset: str = "gh_data",
    product_dataset: str = "main",
    analytics_dataset: str = "analytics",
) -> DataFrame:
    """Build the six derived tables from loaded tables; return a statistics row of each."""
    t = warehouse.table
    issues_c, prs_c = t(gh_dataset, "issues__comments"), t(gh_dataset, "pull_requests__comments")
    derived = {
        (gh_dataset, "top_comment_authors"): marts.top_comment_authors(issues_c, prs_c),
        (gh_dataset, "comment_volume_by_day"): marts.comment_volume_by_day(issues_c, prs_c),
        (gh_dataset, "avg_comment_length"): marts.avg_comment_length(issues_c, prs_c),
        (analytics_dataset, "team_performance_summary"): marts.team_performance_summary(
            t(product_dataset, "public_tickets")
        ),
        (analytics_dataset, "nps_by_subscription_month"): marts.nps_by_subscription_month(
            t(product_dataset, "public_nps_responses")
        ),
        (analytics_dataset, "user_core_activity_summary"): marts.user_core_activity_summary(
            t(product_dataset, "public_users"),
            t(product_dataset, "public_tickets"),
            t(product_dataset, "public_teams"),
            t(product_dataset, "public_events"),
        ),
    }
    for dataset in dict.fromkeys(db for db, _ in derived):
        with warehouse.commit(dataset) as writing:
            for (db, name), df in derived.items():
                if db == dataset:
                    writing.replace_table(df, name, contract=schemas.CONTRACTS[name], order_by=marts.STORED_ORDER.get(name))
    return reduce(DataFrame.unionByName, [warehouse.statistics(db, name) for db, name in derived])
