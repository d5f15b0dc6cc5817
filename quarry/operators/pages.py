"""Page-level rules of the loader: item cap, stop at an empty page, load audit,
response checks.

All of them work on one small row per page (a count, a cost), never on the
items, and the page rows are joined back or filtered before items are
exploded. The order-dependent cap uses the blocked running sum, so a
repository with millions of pages is still spread over many tasks.

A line that continues the child lists of a page (``list_offset`` above 0) is part
of that page: it is checked like any line, but is not counted as a page.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions.running import exclusive_running_sum
from quarry.operators.normalize import list_size
from quarry.sinks.staging import stage_parquet
from quarry.sources.landing import list_offset, page_list

PAGE_KEY = ["owner", "name", "resource"]
CHECKS = ("corrupt_pages", "error_pages", "bad_shape_pages")


def latest_pages(pages: DataFrame, row_id: str) -> DataFrame:
    """One row per page and list offset: the copy landed last.

    ``row_id`` is a stored unique column. The winners are found on narrow rows, once;
    the page rows only meet the ids of the losing copies. Those are staged, so that
    Catalyst knows their bytes before it plans the join: they are few, and sent to the
    page rows, which are not shuffled.
    """
    keys = [*PAGE_KEY, "page_no", "_offset"]
    copies = pages.select(
        *PAGE_KEY, "page_no", list_offset(pages).alias("_offset"), F.struct("landed_at", row_id).alias("copy")
    )
    several = copies.groupBy(*keys).agg(F.max("copy").alias("winner"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    losers = (
        copies.alias("c")
        .join(several.alias("s"), same)
        .where(F.col(f"copy.{row_id}") != F.col(f"winner.{row_id}"))
        .select(F.col(f"copy.{row_id}").alias(row_id))
    )
    return pages.join(stage_parquet(losers, "stale_pages"), row_id, "left_anti")


def page_sizes(pages: DataFrame, resource: str) -> DataFrame:
    """Per landed line: item count, request cost, remaining credits, response checks.

    PRJ-9: a missing ``rateLimit`` counts as cost 0, remaining 0. FLT-4: only a
    list that is there and has no element makes an empty page; a missing
    connection is a failed response (FLT-7).
    """
    conn = F.col(f"data.repository.{schemas.CONNECTIONS[resource]}")
    listed = F.col(page_list(pages, resource))
    keys = F.col("data_keys") if "data_keys" in pages.columns else F.array(F.lit("repository"))
    keys = F.filter(F.coalesce(keys, F.array().cast("array<string>")), lambda k: k != "rateLimit")
    corrupt = F.coalesce(F.col("corrupt"), F.lit(False)) if "corrupt" in pages.columns else F.lit(False)
    return pages.where(F.col("resource").eqNullSafe(resource)).select(
        *PAGE_KEY,
        "page_no",
        list_offset(pages).alias("list_offset"),
        list_size(listed).alias("n_items"),
        (listed.isNotNull() & (list_size(listed) == 0)).alias("is_empty"),
        F.coalesce(F.col("data.rateLimit.cost"), F.lit(0)).alias("cost"),
        F.coalesce(F.col("data.rateLimit.remaining"), F.lit(0)).alias("remaining"),
        (list_size(F.col("errors")) > 0).alias("has_errors"),
        ((F.size(keys) != 1) | conn.isNull()).alias("bad_shape"),
        corrupt.alias("is_corrupt"),
    )


def cap_pages(pages: DataFrame, resource: str, max_items: int | None) -> DataFrame:
    """FLT-3 + FLT-4 + WIN-1: the pages the loader would have yielded.

    Pages are taken in ``page_no`` order until the first empty page, and, when
    ``max_items`` is set (0 and None mean no cap), while the items taken
    *before* a page number fewer than ``max_items``: whole pages, so 250 with
    pages of 100 takes 300.
    """
    sizes = page_sizes(pages, resource).where(F.col("list_offset") == 0)
    first_empty = sizes.where("is_empty").groupBy(*PAGE_KEY).agg(F.min("page_no").alias("first_empty"))
    kept = sizes.join(first_empty, PAGE_KEY, "left").where(
        F.col("first_empty").isNull() | (F.col("page_no") < F.col("first_empty"))
    )
    if max_items:
        kept = exclusive_running_sum(kept, PAGE_KEY, "page_no", "n_items", "items_before").where(
            F.col("items_before") < max_items
        )
    else:
        kept = kept.withColumn("items_before", F.lit(None).cast("long"))
    return kept.select(*PAGE_KEY, "page_no", "n_items", "cost", "remaining", "items_before")


def page_bounds(pages: DataFrame, resource: str, max_items: int | None) -> DataFrame:
    """Per repository and resource, the last page the loader takes.

    Both rules keep a prefix of the pages in ``page_no`` order (the running
    count only grows, and everything before the first empty page is taken),
    so one bound per repository describes the kept set.
    """
    return cap_pages(pages, resource, max_items).groupBy(*PAGE_KEY).agg(F.max("page_no").alias("_last_page"))


def capped_pages(pages: DataFrame, resource: str, max_items: int | None) -> DataFrame:
    """The landed page rows that survive ``cap_pages`` (ready to normalise).

    The page rows (the bulk of the landed data) meet one bound per repository,
    staged first so that Catalyst knows its bytes and picks the join by them.
    """
    bounds = stage_parquet(page_bounds(pages, resource, max_items), "page_bounds")
    own = pages.where(F.col("resource") == resource)
    return own.join(bounds, PAGE_KEY).where(F.col("page_no") <= F.col("_last_page")).drop("_last_page")


def load_audit(pages: DataFrame, resource: str, max_items: int | None = None) -> DataFrame:
    """AG-8: per repository and resource, what one load fetched and cost."""
    return (
        cap_pages(pages, resource, max_items)
        .groupBy(*PAGE_KEY)
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum("n_items").alias("items"),
            F.sum("cost").alias("total_cost"),
            F.min("remaining").alias("min_remaining"),
        )
    )


def bundle_audit(bundles: DataFrame) -> DataFrame:
    """AG-8 for the comment-reaction requests: per repository, requests, comments
    asked for, their cost and the credits left."""
    rate = F.col("data")["rateLimit"]
    asked = F.filter(F.map_values("data"), lambda node: node["id"].isNotNull())
    return bundles.groupBy("owner", "name").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.size(asked)).alias("comments"),
        F.sum(F.coalesce(rate["cost"], F.lit(0))).alias("total_cost"),
        F.min(F.coalesce(rate["remaining"], F.lit(0))).alias("min_remaining"),
    )


def page_problems(pages: DataFrame, resource: str) -> DataFrame:
    """FLT-6 + FLT-7 per repository: responses with errors or a wrong shape, lines
    that are not JSON, page numbers that are missing or came again.

    A copy of a page is harmless (``latest_pages`` loads it once) and only counted.
    """
    lines = page_sizes(pages, resource)
    first = F.col("list_offset") == 0
    return (
        lines.groupBy(*PAGE_KEY)
        .agg(
            F.count_if(first).alias("pages"),
            F.count_if("has_errors").alias("error_pages"),
            F.count_if("bad_shape").alias("bad_shape_pages"),
            F.count_if("is_corrupt").alias("corrupt_pages"),
            F.countDistinct(F.when(first, F.col("page_no"))).alias("_numbers"),
            (F.max("page_no") - F.min("page_no") + 1).alias("_span"),
        )
        .select(
            *PAGE_KEY,
            "pages",
            "error_pages",
            "bad_shape_pages",
            "corrupt_pages",
            (F.coalesce("_span", F.lit(0)) - F.col("_numbers")).alias("missing_pages"),
            (F.col("pages") - F.col("_numbers")).alias("repeated_pages"),
        )
    )


def shaped(bundles: DataFrame) -> DataFrame:
    """Bundles with the mark of a missing ``data``: a check of a staged copy then leaves
    the lists unread."""
    return bundles.withColumn("no_data", F.col("data").isNull())


def bundle_problems(bundles: DataFrame) -> DataFrame:
    """FLT-6 for the comment-reaction responses: one row of counts."""
    corrupt = F.coalesce(F.col("corrupt"), F.lit(False)) if "corrupt" in bundles.columns else F.lit(False)
    no_data = F.col("no_data") if "no_data" in bundles.columns else F.col("data").isNull()
    return bundles.agg(
        F.count_if(list_size(F.col("errors")) > 0).alias("error_pages"),
        F.count_if(no_data & ~corrupt).alias("bad_shape_pages"),
        F.count_if(corrupt).alias("corrupt_pages"),
    )


def assert_landed_ok(pages: DataFrame, resources, bundles: DataFrame | None = None) -> None:
    """Fail the load if any landed line is broken: not JSON, with errors, without its
    one connection, of no known resource, or if a page number is missing.

    All chosen resources and the bundles are checked in one job, which returns
    one row of counts and the first repository concerned.
    """
    wrong = ("error_pages", "bad_shape_pages", "corrupt_pages", "missing_pages")
    where = F.concat_ws("/", "owner", "name", "resource")
    found = [page_problems(pages, r).select(where.alias("at"), *wrong) for r in resources]
    if "corrupt" in pages.columns:
        # A broken line has no resource to be counted under.
        lost = pages.where(F.col("corrupt") & F.col("resource").isNull()).agg(F.count(F.lit(1)).alias("n"))
        found.append(lost.select(F.lit("unreadable").alias("at"), *_counts(wrong, corrupt_pages="n")))
    if bundles is not None:
        found.append(
            bundle_problems(bundles).select(
                F.lit("bundles").alias("at"), *_counts(wrong, **{c: c for c in CHECKS})
            )
        )
    merged = reduce(DataFrame.unionByName, found)
    bad = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in wrong])
    row = merged.where(bad).agg(F.min("at").alias("at"), *(F.sum(c).alias(c) for c in wrong)).first()
    if row.at is not None:
        detail = ", ".join(f"{c}={row[c]}" for c in wrong if row[c])
        raise ValueError(f"landed pages failed checks: {detail}, first at {row.at}")


def _counts(names: tuple[str, ...], **given: str) -> list:
    return [(F.col(given[c]) if c in given else F.lit(0)).cast("long").alias(c) for c in names]
