"""Landed-page DataFrames that Spark derives from the driver tables.

The reference reads nested API responses; the driver ships flat tables. These
builders nest the flat tables into exactly the landed-page schema
(``quarry.schemas.PAGE`` and friends) so the normalisation path runs on data
that grows with the driver tables. A response holds at most 100 items per page
and ``LIST_PART`` (100) comments or reactions per list, with ``totalCount`` holding the full
count; a longer list goes on in further lines of its page (``list_offset`` 100, 200,
...), so no row is left out. Those bounds also keep every ``collect_list``
group small: a child's position in its list is a window over a block of its
parent's children plus a running sum over the blocks' counts, so a hot parent
is never gathered anywhere. Rows are shuffled flat, to be numbered and then to their
page; the nested responses are built behind the last shuffle. A task holds the lists of all
its responses (up to 128 of them) while it builds them, so that shuffle deals
``ROWS_PER_TASK`` rows to a task on average, whatever the session's partitions.

Pages group items by ``id div 100`` (ids are unique), so no global numbering
window is needed.

Fixed fixture rules (shared with the oracle SQL):
  * conversations: item ``number`` = conv_id, comment id ``c<conv_id>_<turn>``,
    author login = role, comment time = 2024-01-01 + (conv_id*60 + turn) minutes;
  * events as comments: item ``number`` = user_id, comment id ``e<event_id>``,
    login ``user<user_id>`` (NULL author when user_id % 30 = 0);
  * lineitem rows are the reactions of comment ``e<l_orderkey>``: login
    ``supp<l_suppkey>``, content = l_returnflag, time = l_shipdate, in the order of
    l_linenumber, l_shipdate, l_suppkey, l_returnflag;
  * orders rows are the reactions of item ``number`` = o_custkey: login
    ``cust<o_custkey>``, content = o_orderpriority, time = o_orderdate, in the
    order of o_orderkey;
  * customers are stargazers: login c_name, url ``u/<c_name>``,
    starred 2020-01-01 + c_custkey minutes;
  * events as items of repository ``driver/<event_type>``; page
    ``event_id div 100``; page errors when page_no % 17 = 5; an extra top-level
    key when page_no % 23 = 7; request cost 1 + items div 50,
    remaining 5000 - page_no.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from quarry import schemas
from quarry.functions.naming import iso_text
from tools.standins import read

OWNER = "driver"
ITEMS_PER_PAGE = 100
LIST_PART = 100
BLOCK_KEYS = 65_536
BUNDLE_REQUEST_SIZE = 50
ROWS_PER_TASK = 25_000
REACTION_FLAGS = ("A", "N", "R")


def _null(t: DataType) -> Column:
    return F.lit(None).cast(t)


def _in_parts(df: DataFrame, key: str, block: Column, order: list[str], counted: DataFrame | None = None) -> DataFrame:
    """Number each key's rows by (``block``, ``order``) and cut them into list parts.

    Adds ``idx`` (position in the whole list), ``list_offset`` (of its part) and ``total``
    (rows of the key; null if they are one list part of one block). Rows are numbered
    inside a block; a block starts after the counts of the key's earlier blocks, so no
    window holds all rows of a key. Only keys of several blocks or parts meet their
    counts. ``counted``: rows with the same keys and blocks that are cheaper to count
    (other keys in it do no harm).
    """
    blocked = df.withColumn("_block", block)
    inside = F.row_number().over(Window.partitionBy(key, "_block").orderBy(*order)) - 1
    whole = Window.partitionBy(key)
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        (df if counted is None else counted)
        .groupBy(key, block.alias("_block"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_block", "_n", F.sum("_n").over(earlier).alias("_start"), F.sum("_n").over(whole).alias("total"))
        .where((F.col("total") > F.col("_n")) | (F.col("_n") > LIST_PART))
        .drop("_n")
    )
    idx = F.coalesce("_start", F.lit(0)) + F.col("_inside")
    return (
        blocked.where(F.col(key).isNotNull() & F.col("_block").isNotNull())
        .withColumn("_inside", inside)
        .join(starts, [key, "_block"], "left")
        .withColumn("idx", idx)
        .withColumn("list_offset", idx - idx % LIST_PART)
        .drop("_block", "_inside", "_start")
    )


def _dealt(flat: DataFrame, keys: list[str], *rows: DataFrame) -> DataFrame:
    """``flat`` shuffled by ``keys`` to a task for every ``ROWS_PER_TASK`` of ``rows``.

    A number of partitions that is named is not coalesced by adaptive execution.
    """
    n = sum(df.count() for df in rows)
    return flat.repartition(max(1, -(-n // ROWS_PER_TASK)), *keys)


def _listed_rows(*cols: Column | str) -> Column:
    """Flat rows of a list part, in its order."""
    return F.sort_array(F.collect_list(F.struct("idx", *cols)))


def _sorted_list(sort_key: Column, value: Column) -> Column:
    """``value``s of a group as a list ordered by ``sort_key``.

    The comparator reads only the key: ordering whole (deeply nested) values
    would generate comparison code for every nested field.
    """
    pairs = F.array_sort(
        F.collect_list(F.struct(sort_key.alias("k"), value.alias("v"))),
        lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0),
    )
    return F.transform(pairs, lambda x: x["v"])


def _actor(login: Column, url: Column | None = None) -> Column:
    return F.struct(login.alias("login"), _null("string").alias("avatarUrl"),
                    (url if url is not None else _null("string")).alias("url"))


def _comment(id_: Column, body: Column, login: Column, created: Column, groups: Column) -> Column:
    return F.struct(
        id_.alias("id"),
        _null("string").alias("url"),
        body.alias("body"),
        F.when(login.isNull(), _null(schemas.ACTOR)).otherwise(_actor(login)).alias("author"),
        F.lit("NONE").alias("authorAssociation"),
        created.alias("createdAt"),
        groups.alias("reactionGroups"),
    )


def _reaction(login: Column, content: Column, created: Column) -> Column:
    return F.struct(_actor(login).alias("user"), content.alias("content"), created.alias("createdAt"))


def _item(number: Column, title: Column, body: Column, created: Column, reactions: Column, comments: Column) -> Column:
    return F.struct(
        number.alias("number"),
        _null("string").alias("url"),
        title.alias("title"),
        body.alias("body"),
        _null(schemas.ACTOR).alias("author"),
        F.lit("NONE").alias("authorAssociation"),
        F.lit(False).alias("closed"),
        _null("string").alias("closedAt"),
        created.alias("createdAt"),
        F.lit("OPEN").alias("state"),
        created.alias("updatedAt"),
        reactions.alias("reactions"),
        comments.alias("comments"),
    )


def _page(
    df: DataFrame,
    name: Column,
    resource: str,
    list_col: str,
    *,
    cost: Column | None = None,
    errors: Column | None = None,
    extra_key: Column | None = None,
) -> DataFrame:
    """Wrap one list per (name, page_no) row into the landing envelope."""
    conn = schemas.CONNECTIONS[resource]
    conn_type = schemas.REPOSITORY[conn].dataType
    if conn == "stargazers":
        connection = F.struct(_null(schemas.PAGE_INFO).alias("pageInfo"), F.col(list_col).alias("edges"))
    else:
        connection = F.struct(
            _null("long").alias("totalCount"), _null(schemas.PAGE_INFO).alias("pageInfo"),
            F.col(list_col).alias("nodes"),
        )
    repo_fields = [
        (connection if c == conn else _null(schemas.REPOSITORY[c].dataType)).alias(c)
        for c in ("issues", "pullRequests", "stargazers")
    ]
    rate = F.struct(
        F.lit(5000).cast("long").alias("limit"),
        (cost if cost is not None else F.lit(1)).cast("long").alias("cost"),
        (F.lit(5000) - F.col("page_no")).cast("long").alias("remaining"),
        _null("string").alias("resetAt"),
    )
    keys = F.array(F.lit("repository"), F.lit("rateLimit"))
    if extra_key is not None:
        keys = F.when(extra_key, F.array_insert(keys, 2, F.lit("organization"))).otherwise(keys)
    return df.select(
        F.lit(OWNER).alias("owner"),
        name.alias("name"),
        F.lit(resource).alias("resource"),
        F.col("page_no").cast("long").alias("page_no"),
        F.lit("2024-02-01T00:00:00Z").alias("landed_at"),
        (F.col("list_offset") if "list_offset" in df.columns else F.lit(0)).cast("long").alias("list_offset"),
        F.struct(F.struct(*repo_fields).alias("repository"), rate.alias("rateLimit")).alias("data"),
        (errors if errors is not None else _null("array<string>")).alias("errors"),
        keys.alias("data_keys"),
    )


# ---------------------------------------------------------------------------
# conversations -> issue pages with comments

def _no_groups() -> Column:
    return F.array().cast(ArrayType(schemas.REACTION_GROUP))


def _no_reactions() -> Column:
    return F.struct(F.lit(0).cast("long").alias("totalCount"), F.array().cast(ArrayType(schemas.REACTION)).alias("nodes"))


def _minutes_after(base: str, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, F.lit(base).cast("timestamp_ntz"))


def conversation_pages(spark: SparkSession, sf_dir: str, resource: str = "issues") -> DataFrame:
    conv = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    flat = _in_parts(conv, "conv_id", F.floor(F.col("turn") / BLOCK_KEYS), ["turn"], conv.select("conv_id", "turn")).withColumn(
        "page_no", F.floor(F.col("conv_id") / ITEMS_PER_PAGE)
    )
    listed = (
        _dealt(flat, ["page_no", "list_offset"], conv)
        .groupBy("page_no", "list_offset", "conv_id")
        .agg(
            _listed_rows("turn", "role", "text").alias("rows"),
            F.coalesce(F.max("total"), F.count(F.lit(1))).alias("n_comments"),
        )
    )

    def comment(row: Column) -> Column:
        return _comment(
            F.concat(F.lit("c"), F.col("conv_id"), F.lit("_"), row["turn"]),
            row["text"],
            row["role"],
            iso_text(_minutes_after("2024-01-01 00:00:00", F.col("conv_id") * 60 + row["turn"])),
            _no_groups(),
        )

    item = _item(
        F.col("conv_id"),
        _null("string"),
        _null("string"),
        iso_text(_minutes_after("2024-01-01 00:00:00", F.col("conv_id") * 60)),
        _no_reactions(),
        F.struct(F.col("n_comments").alias("totalCount"), F.transform("rows", comment).alias("nodes")),
    )
    paged = listed.groupBy("page_no", "list_offset").agg(_sorted_list(F.col("conv_id"), item).alias("items"))
    return _page(paged, F.lit("conversations"), resource, "items")


# ---------------------------------------------------------------------------
# events as comments of per-user items; lineitem / orders as reactions


def _comment_login(user_id: Column) -> Column:
    return F.when(user_id % 30 == 0, F.lit(None)).otherwise(F.concat(F.lit("user"), user_id))


def _lineitem_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("event_id"), "l_linenumber", "l_shipdate", "l_suppkey", "l_returnflag"
    )


def _first_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event id, the time of the first reaction of each flag (NULL if none)."""
    li = _lineitem_reactions(spark, sf_dir)
    firsts = [
        F.min(F.when(F.col("l_returnflag") == flag, F.col("l_shipdate"))).alias(f"first_{flag}")
        for flag in REACTION_FLAGS
    ]
    return li.groupBy("event_id").agg(*firsts)


def _groups(row: Column) -> Column:
    """One group per flag with the first reaction time."""
    return F.array(
        *[
            F.struct(F.lit(flag).alias("content"), iso_text(row[f"first_{flag}"]).alias("createdAt"))
            for flag in REACTION_FLAGS
        ]
    )


def event_comment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items are users; their events are the comments; orders react to items.

    Comments, reactions and each user's totals (a row per list part) go to their page in
    one shuffle; orders of customers who are no users end there.
    """
    ev = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "props")
    ev_id = ev.select("event_id", "user_id")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"), "o_orderkey", "o_orderdate", "o_orderpriority"
    )
    comments = _in_parts(
        ev.join(_first_reactions(spark, sf_dir), "event_id", "left"),
        "user_id", F.floor(F.col("event_id") / BLOCK_KEYS), ["event_id"], ev_id,
    )
    reactions = _in_parts(
        orders, "user_id", F.floor(F.col("o_orderkey") / BLOCK_KEYS), ["o_orderkey"], orders.select("user_id", "o_orderkey")
    )
    totals = (
        ev_id.select("user_id", F.lit(1).alias("c"), F.lit(0).alias("r"))
        .unionByName(orders.select("user_id", F.lit(0).alias("c"), F.lit(1).alias("r")))
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.sum("c").alias("n_comments"), F.sum("r").alias("n_reactions"))
        .where("n_comments > 0")
    )
    last = F.greatest("n_comments", "n_reactions") - 1
    flat = (
        comments.select(
            "user_id", "list_offset", F.struct("idx", "event_id", "ts", "props", *(f"first_{f}" for f in REACTION_FLAGS)).alias("c")
        )
        .unionByName(
            reactions.select("user_id", "list_offset", F.struct("idx", "o_orderdate", "o_orderpriority").alias("r")),
            allowMissingColumns=True,
        )
        .unionByName(
            totals.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(LIST_PART).cast("long"))).alias("list_offset")),
            allowMissingColumns=True,
        )
    )
    per_user = (
        _dealt(flat.withColumn("page_no", F.floor(F.col("user_id") / ITEMS_PER_PAGE)), ["page_no", "list_offset"], ev, orders)
        .groupBy("page_no", "list_offset", "user_id")
        .agg(
            F.sort_array(F.collect_list("c")).alias("comment_rows"),
            F.sort_array(F.collect_list("r")).alias("reaction_rows"),
            F.max("n_comments").alias("n_comments"),
            F.max("n_reactions").alias("n_reactions"),
        )
        .where(F.col("n_comments").isNotNull() & ((F.size("comment_rows") > 0) | (F.size("reaction_rows") > 0)))
    )

    def comment(row: Column) -> Column:
        return _comment(
            F.concat(F.lit("e"), row["event_id"]),
            row["props"],
            _comment_login(F.col("user_id")),
            iso_text(row["ts"]),
            _groups(row),
        )

    def reaction(row: Column) -> Column:
        return _reaction(
            F.concat(F.lit("cust"), F.col("user_id")), row["o_orderpriority"], iso_text(row["o_orderdate"])
        )

    item = _item(
        F.col("user_id"),
        F.concat(F.lit("user "), F.col("user_id")),
        _null("string"),
        _null("string"),
        F.struct(F.col("n_reactions").alias("totalCount"), F.transform("reaction_rows", reaction).alias("nodes")),
        F.struct(F.col("n_comments").alias("totalCount"), F.transform("comment_rows", comment).alias("nodes")),
    )
    paged = per_user.groupBy("page_no", "list_offset").agg(_sorted_list(F.col("user_id"), item).alias("items"))
    return _page(paged, F.lit("events"), "issues", "items")


def _rate_limit(comments: Column) -> Column:
    """The ``rateLimit`` entry of a request for so many comments: cost 1 per 10 begun."""
    return F.struct(
        _null("string").alias("id"),
        _null(schemas.REACTION_CONNECTION).alias("reactions"),
        F.ceil(comments / 10).cast("long").alias("cost"),
        (F.lit(5000) - F.col("request_no") % 5000).cast("long").alias("remaining"),
    ).cast(schemas.BUNDLE_NODE)


def comment_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment-reaction responses for every event that has reactions.

    One response per ``event_id div 50`` (the reference asks for 50 comments
    per request); each holds ``node_<event_id>`` entries and a ``rateLimit``
    entry, which parses as a node without an id.
    """
    li = _lineitem_reactions(spark, sf_dir)
    ev = read(spark, sf_dir, "events").select("event_id")
    block = F.floor(F.col("l_linenumber") / BLOCK_KEYS)
    lists = (
        _in_parts(
            li.join(ev, "event_id", "left_semi"),
            "event_id", block, ["l_linenumber", "l_shipdate", "l_suppkey", "l_returnflag"], li.select("event_id", "l_linenumber"),
        )
        .withColumn("request_no", F.floor(F.col("event_id") / BUNDLE_REQUEST_SIZE))
        .repartition("request_no", "list_offset")
        .groupBy("request_no", "list_offset", "event_id")
        .agg(
            _listed_rows("l_suppkey", "l_returnflag", "l_shipdate").alias("rows"),
            F.coalesce(F.max("total"), F.count(F.lit(1))).alias("n"),
        )
    )

    def reaction(row: Column) -> Column:
        return _reaction(F.concat(F.lit("supp"), row["l_suppkey"]), row["l_returnflag"], iso_text(row["l_shipdate"]))

    node = F.struct(
        F.concat(F.lit("e"), F.col("event_id")).alias("id"),
        F.struct(F.col("n").alias("totalCount"), F.transform("rows", reaction).alias("nodes")).alias("reactions"),
        _null("long").alias("cost"),
        _null("long").alias("remaining"),
    )
    requests = lists.groupBy("request_no", "list_offset").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("node_"), F.col("event_id")), node))).alias("m")
    )
    rate_entry = F.create_map(F.lit("rateLimit"), _rate_limit(F.size("m")))
    return requests.select(
        F.lit(OWNER).alias("owner"),
        F.lit("events").alias("name"),
        F.col("request_no").cast("long").alias("request_no"),
        "list_offset",
        F.map_concat("m", rate_entry).alias("data"),
        _null("array<string>").alias("errors"),
    )


# ---------------------------------------------------------------------------
# customers -> stargazer pages


def stargazer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    starred = _minutes_after("2020-01-01 00:00:00", F.col("c_custkey"))
    edge = F.struct(
        iso_text(starred).alias("starredAt"),
        _actor(F.col("c_name"), F.concat(F.lit("u/"), F.col("c_name"))).alias("node"),
    )
    paged = (
        c.withColumn("page_no", F.floor(F.col("c_custkey") / ITEMS_PER_PAGE))
        .groupBy("page_no")
        .agg(_sorted_list(-F.col("c_custkey"), edge).alias("edges"))
    )
    return _page(paged, F.lit("customers"), "stargazers", "edges")


# ---------------------------------------------------------------------------
# events -> item pages of several repositories (page cap, audit, checks)


def event_item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "event_type", "props")
    item = _item(
        F.col("event_id"),
        F.col("event_type"),
        F.col("props"),
        iso_text(F.col("ts")),
        _no_reactions(),
        F.struct(F.lit(0).cast("long").alias("totalCount"), F.array().cast(ArrayType(schemas.COMMENT)).alias("nodes")),
    )
    paged = (
        ev.withColumn("page_no", F.floor(F.col("event_id") / ITEMS_PER_PAGE))
        .groupBy("event_type", "page_no")
        .agg(_sorted_list(-F.col("event_id"), item).alias("items"))
    )
    n = F.size("items")
    return _page(
        paged,
        F.col("event_type"),
        "issues",
        "items",
        cost=1 + F.floor(n / 50),
        errors=F.when(F.col("page_no") % 17 == 5, F.array(F.lit("RATE_LIMITED"))),
        extra_key=F.col("page_no") % 23 == 7,
    )


# ---------------------------------------------------------------------------
# events -> REST event feed


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed as landed: id and time as text, the rest packed JSON."""
    ev = read(spark, sf_dir, "events").select("event_id", "event_type", "ts", "props")
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        iso_text(F.col("ts")).alias("created_at"),
        F.col("props").alias("payload"),
    )


def closed_item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_item_pages`` without failed responses, each repository closed by an
    empty page, and a stale copy of its items landed behind that page."""
    pages = event_item_pages(spark, sf_dir).withColumn("errors", _null("array<string>")).withColumn(
        "data_keys", F.array(F.lit("repository"), F.lit("rateLimit"))
    )
    last = pages.groupBy("name").agg(F.max("page_no").alias("last"))
    empty = F.array().cast(ArrayType(schemas.ITEM))
    no_items = F.col("data").withField("repository.issues.nodes", empty)
    closing = last.join(pages, "name").where(F.col("page_no") == F.col("last"))
    stale = pages.join(last, "name").withColumn("page_no", F.col("page_no") + F.col("last") + 2)
    return (
        pages.unionByName(closing.withColumn("page_no", F.col("last") + 1).withColumn("data", no_items).select(pages.columns))
        .unionByName(stale.select(pages.columns))
    )


EVENTS_PER_PULL = 100


def event_array_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as landed REST pages: one JSON array per line, by day of landing
    (the day after the events), ``EVENTS_PER_PULL`` events a page."""
    feed = event_feed(spark, sf_dir)
    day = F.to_date(F.substring("created_at", 1, 10))
    page = F.floor(F.col("id").cast("long") / EVENTS_PER_PULL)
    return (
        feed.groupBy(F.date_add(day, 1).alias("landed_date"), page.alias("page"))
        .agg(F.to_json(F.collect_list(F.struct("id", "type", "created_at", "payload"))).alias("value"))
        .select("landed_date", "value")
    )


def broken_event_lines(spark: SparkSession, sf_dir: str, planted: bool) -> DataFrame:
    """The feed as landed JSON lines (``value``), with each event's type and time for
    choosing among them. If ``planted``, lines of ids divisible by 107 are not JSON, those
    divisible by 101 lack their id, by 103 their time."""
    feed = event_feed(spark, sf_dir)
    number = F.col("id").cast("long")

    def left_out(divisor: int, column: str) -> Column:
        return F.when((number % divisor != 0) if planted else F.lit(True), F.col(column)).alias(column)

    line = F.to_json(F.struct(left_out(101, "id"), "type", left_out(103, "created_at"), "payload"))
    if planted:
        line = F.when(number % 107 == 0, F.concat(F.lit("broken "), "id")).otherwise(line)
    return feed.select("type", "created_at", line.alias("value"))


def nested_event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with payloads that nest objects and lists: a push (click) has commits,
    each with an author and parents; a comment (view, signup) has its user; a purchase
    has labels and numbers of both kinds; an error is text that is no JSON."""
    ev = read(spark, sf_dir, "events").select("event_id", "event_type", "ts", "user_id")
    number, user = F.col("event_id"), F.concat(F.lit("user"), "user_id")
    author = F.struct(user.alias("name"), F.struct((number % 2 == 0).alias("signed")).alias("check"))
    commits = F.transform(
        F.sequence(F.lit(1), (number % 4 + 1).cast("int")),
        lambda i: F.struct(
            F.concat_ws("-", number, i).alias("sha"),
            (i % 2 == 0).alias("distinct"),
            author.alias("author"),
            F.array_repeat(number, (i - 1).cast("int")).alias("parents"),
        ),
    )
    push = F.struct(number.alias("pushId"), F.lit("refs/heads/main").alias("ref"), F.when(number % 5 != 0, commits).alias("commits"))
    commenter = F.struct(user.alias("login"), (F.col("user_id") % 2 == 0).alias("siteAdmin"))
    comment = F.struct(
        F.lit("created").alias("action"),
        F.struct(number.alias("id"), F.concat(F.lit("it\"s "), "event_type").alias("body"), commenter.alias("user")).alias("comment"),
    )
    amount = F.when(number % 2 == 0, (number / 4).cast("string")).otherwise((number % 1000).cast("string"))
    labels = F.when(number % 3 == 0, F.array(F.lit("new"), F.col("event_type"))).otherwise(F.array().cast("array<string>"))
    bought = F.concat(F.lit('{"amount":'), amount, F.lit(',"labels":'), F.to_json(labels), F.lit(',"note":null}'))
    payload = (
        F.when(F.col("event_type") == "click", F.to_json(push))
        .when(F.col("event_type").isin("view", "signup"), F.to_json(comment))
        .when(F.col("event_type") == "purchase", bought)
        .otherwise(F.concat(F.lit("error "), number))
    )
    return ev.select(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type"),
        iso_text(F.col("ts")).alias("created_at"), payload.alias("payload"),
    )
