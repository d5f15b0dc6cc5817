"""Nested pages to relational tables: items, comments, reactions, stargazers.

All steps are narrow (``posexplode`` / ``select``) except the attach of
comment reactions, which is one left join on the comment id against
de-duplicated bundle nodes. Child tables carry their parent key (``owner``,
``name``, ``number``) and their list position, so nest-then-explode gives the
input back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions.naming import flat_columns, utc_timestamp
from quarry.sources.landing import list_offset, page_items

PARENT_KEY = ["owner", "name", "number"]


def list_size(arr: Column) -> Column:
    """Length of a list, 0 for a missing list (whatever ``sizeOfNull`` says)."""
    return F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr))


def listed(length: Column, n: int | None) -> Column:
    """FLT-5: elements kept of a list of ``length`` when at most ``n`` are (all if ``n`` is falsy)."""
    return F.least(length, F.lit(n)) if n else length


def items(pages: DataFrame, resource: str, list_cap: int | None = None) -> DataFrame:
    """Item table (``issues`` / ``pull_requests``): PRJ-3, PRJ-5.

    ``reactions_total_count`` and ``comments_total_count`` come from the
    connection's ``totalCount``, 0 when absent. ``list_cap`` re-applies a
    per-item list cap and flags items whose lists were cut; by default lists
    are whole. An item whose lists go on in further lines of its page is one row:
    the lines' list lengths are added up (a join that adaptive execution drops
    when there are no such lines).
    """
    sized = page_items(pages, resource).select(
        "owner",
        "name",
        "page_no",
        "item_idx",
        "list_offset",
        F.col("item.number").alias("number"),
        F.col("item.url").alias("url"),
        F.col("item.title").alias("title"),
        F.col("item.body").alias("body"),
        *flat_columns("item.author", schemas.ACTOR, "author"),
        F.col("item.authorAssociation").alias("author_association"),
        F.col("item.closed").alias("closed"),
        utc_timestamp(F.col("item.closedAt")).alias("closed_at"),
        utc_timestamp(F.col("item.createdAt")).alias("created_at"),
        F.col("item.state").alias("state"),
        utc_timestamp(F.col("item.updatedAt")).alias("updated_at"),
        F.coalesce(F.col("item.reactions.totalCount"), F.lit(0)).alias("reactions_total_count"),
        F.coalesce(F.col("item.comments.totalCount"), F.lit(0)).alias("comments_total_count"),
        list_size(F.col("item.comments.nodes")).alias("_comments"),
        list_size(F.col("item.reactions.nodes")).alias("_reactions"),
    )
    more = (
        sized.where(F.col("list_offset") > 0)
        .groupBy("owner", "name", "number")
        .agg(F.sum("_comments").alias("_more_comments"), F.sum("_reactions").alias("_more_reactions"))
    )
    it = sized.where(F.col("list_offset") == 0).join(more, ["owner", "name", "number"], "left")
    n_comments = listed(F.col("_comments") + F.coalesce("_more_comments", F.lit(0)), list_cap).cast("int")
    n_reactions = listed(F.col("_reactions") + F.coalesce("_more_reactions", F.lit(0)), list_cap).cast("int")
    kept = [c for c in sized.columns if c not in ("list_offset", "_comments", "_reactions")]
    return it.select(
        *kept,
        n_comments.alias("comments_listed"),
        n_reactions.alias("reactions_listed"),
        (F.col("comments_total_count") > n_comments).alias("comments_truncated"),
    )


def comments(pages: DataFrame, resource: str, list_cap: int | None = None, keep_groups: bool = True) -> DataFrame:
    """Child table ``<resource>__comments`` (ARR-1, ARR-5, PRJ-3, PRJ-6).

    ``reaction_groups`` stays on the row for the reaction filter (FLT-1) unless
    ``keep_groups`` is off (PRJ-8).
    """
    exploded = _explode_child(page_items(pages, resource), "item.comments.nodes", list_cap, "c")
    cols = [
        *PARENT_KEY,
        "list_idx",
        F.col("c.id").alias("id"),
        F.col("c.url").alias("url"),
        F.col("c.body").alias("body"),
        *flat_columns("c.author", schemas.ACTOR, "author"),
        F.col("c.authorAssociation").alias("author_association"),
        utc_timestamp(F.col("c.createdAt")).alias("created_at"),
    ]
    if keep_groups:
        cols.append(F.col("c.reactionGroups").alias("reaction_groups"))
    return exploded.select(*cols)


def item_reactions(pages: DataFrame, resource: str, list_cap: int | None = None) -> DataFrame:
    """Child table ``<resource>__reactions`` (ARR-2)."""
    exploded = _explode_child(page_items(pages, resource), "item.reactions.nodes", list_cap, "r")
    return exploded.select(*PARENT_KEY, "list_idx", *_reaction_columns("r"))


def _reaction_columns(r: str) -> list[Column]:
    return [
        *flat_columns(f"{r}.user", schemas.ACTOR, "user"),
        F.col(f"{r}.content").alias("content"),
        utc_timestamp(F.col(f"{r}.createdAt")).alias("created_at"),
    ]


def _explode_child(items_df: DataFrame, list_path: str, list_cap: int | None, alias: str) -> DataFrame:
    """One row per element of an item's list, with the item's key.

    The parent key and the list are lifted to top-level columns first, so the
    generator does not keep the item (and with it the whole list) on every
    output row: exploding k elements then costs O(k), not O(k^2), bytes.
    """
    lifted = items_df.select(
        "owner", "name", F.col("item.number").alias("number"), "list_offset", F.col(list_path).alias("_list")
    )
    exploded = lifted.select(*PARENT_KEY, "list_offset", F.posexplode("_list").alias("_pos", alias))
    return _positioned(exploded, list_cap, alias)


def _positioned(exploded: DataFrame, list_cap: int | None, *keep: str) -> DataFrame:
    """Position in the whole list from the line's offset; the list cap, if any."""
    others = [c for c in exploded.columns if c not in ("list_offset", "_pos", *keep)]
    rows = exploded.select(*others, (F.col("list_offset") + F.col("_pos")).cast("int").alias("list_idx"), *keep)
    return rows.where(F.col("list_idx") < list_cap) if list_cap else rows


def has_any_reaction(groups: Column) -> Column:
    """FLT-1 predicate: some reaction group has a set ``createdAt``."""
    return F.coalesce(
        F.exists(groups, lambda g: g["createdAt"].isNotNull() & (g["createdAt"] != "")),
        F.lit(False),
    )


def reacted_comments(comment_rows: DataFrame) -> DataFrame:
    """FLT-1 + PRJ-8: comments with any reaction, groups dropped."""
    return comment_rows.where(has_any_reaction(F.col("reaction_groups"))).drop("reaction_groups")


def bundle_nodes(bundles: DataFrame) -> DataFrame:
    """SRC-5 + MAP-1: every node of every bundle response, one row per comment id
    and list offset (0 unless a long reaction list goes on in another response).

    The ``rateLimit`` entry and nodes without an id (not a comment) are left
    out; of a comment asked for twice the later request is kept.
    """
    request = F.col("request_no") if "request_no" in bundles.columns else F.lit(0)
    nodes = bundles.select(
        request.alias("_request"), list_offset(bundles).alias("reactions_offset"), F.explode("data").alias("alias", "node")
    ).where((F.col("alias") != "rateLimit") & F.col("node.id").isNotNull())
    latest = Window.partitionBy("id", "reactions_offset").orderBy(F.desc("_request"), F.desc("alias"))
    # Dealt by the id alone, which serves the join of ``attach_reactions`` as well: the
    # lists are shuffled once.
    return (
        nodes.select(
            "_request", "alias", "reactions_offset", F.col("node.id").alias("id"), F.col("node.reactions").alias("reactions")
        )
        .repartition("id")
        .withColumn("_rn", F.row_number().over(latest))
        .where(F.col("_rn") == 1)
        .select("id", "reactions_offset", "reactions")
    )


def attach_reactions(comment_rows: DataFrame, nodes: DataFrame, only_reacted: bool = False) -> DataFrame:
    """JN-4 + PRJ-7: comments keep their rows; reacted ones gain their reactions.

    ``reactions_total_count`` is NULL for a comment that had no reaction node
    (the field is set only when reactions were fetched) and 0 for a node without
    a total. A comment whose reactions came in several responses has a row for
    each, by ``reactions_offset``; the first (0) is the comment's own. With
    ``only_reacted`` a node is attached only to a comment with any reaction
    (FLT-1); the others get a key that no node has, spread like any other.
    """
    key = F.col("id")
    if only_reacted:
        key = F.when(has_any_reaction(F.col("reaction_groups")), key).otherwise(F.concat(F.lit("\u0000"), key))
    found = nodes.select(F.col("id").alias("_id"), "reactions_offset", "reactions")
    joined = comment_rows.withColumn("_key", key).join(found, F.col("_key") == F.col("_id"), "left")
    total = F.when(F.col("reactions").isNotNull(), F.coalesce(F.col("reactions.totalCount"), F.lit(0)))
    return joined.select(
        *[c for c in comment_rows.columns if c != "reaction_groups"],
        total.alias("reactions_total_count"),
        F.col("reactions.nodes").alias("reactions"),
        F.coalesce("reactions_offset", F.lit(0)).alias("reactions_offset"),
    )


def reconciled(comment_rows: DataFrame, bundles: DataFrame) -> DataFrame:
    """JN-4's check: one row per comment id that was asked for or answered, with ``status``
    ``answered``, ``unanswered`` or ``unasked``, and ``n_answers`` (nodes of that id).

    A comment is asked for if it has any reaction (FLT-1). Nodes without an id are no
    answers. A full outer join of two aggregates; a null id meets nothing.
    """
    asked = comment_rows.where(has_any_reaction(F.col("reaction_groups"))).groupBy("id").agg(F.count(F.lit(1)).alias("n_asked"))
    nodes = bundles.select(F.explode("data").alias("alias", "node")).where(
        (F.col("alias") != "rateLimit") & F.col("node.id").isNotNull()
    )
    answers = nodes.groupBy(F.col("node.id").alias("id")).agg(F.count(F.lit(1)).alias("n_answers"))
    status = (
        F.when(F.col("n_answers").isNull(), "unanswered").when(F.col("n_asked").isNull(), "unasked").otherwise("answered")
    )
    return asked.join(answers, "id", "full").select(
        "id", status.alias("status"), F.coalesce("n_answers", F.lit(0)).cast("long").alias("n_answers")
    )


def commented(attached: DataFrame) -> DataFrame:
    """The comment table of attached rows: one row per comment, without the lists."""
    return attached.where(F.col("reactions_offset") == 0).drop("reactions", "reactions_offset")


def comment_reactions(attached: DataFrame, list_cap: int | None = None) -> DataFrame:
    """Grandchild table ``<resource>__comments__reactions`` (ARR-3)."""
    exploded = attached.select(
        *PARENT_KEY,
        F.col("id").alias("comment_id"),
        F.col("reactions_offset").alias("list_offset"),
        F.posexplode("reactions").alias("_pos", "r"),
    )
    return _positioned(exploded, list_cap, "r").select(*PARENT_KEY, "comment_id", "list_idx", *_reaction_columns("r"))


def stargazers(pages: DataFrame) -> DataFrame:
    """SRC-3 + PRJ-4: one row per stargazer edge, ``{starredAt, user: node}``."""
    edges = pages.select(
        "owner", "name", "page_no", F.posexplode("data.repository.stargazers.edges").alias("edge_idx", "e")
    )
    return edges.select(
        "owner",
        "name",
        "page_no",
        "edge_idx",
        utc_timestamp(F.col("e.starredAt")).alias("starred_at"),
        *flat_columns("e.node", schemas.ACTOR, "user"),
    )


def unpack_payload(events: DataFrame, fields: dict[str, str], column: str = "payload") -> DataFrame:
    """ARR-4: lift the named top-level payload keys to ``payload__<key>``
    columns; everything else stays packed as JSON text in ``payload``."""
    schema = ", ".join(f"`{k}` {t}" for k, t in fields.items())
    parsed = F.from_json(F.col(column), schema)
    return events.select("*", *[parsed[k].alias(f"{column}__{k}") for k in fields])
