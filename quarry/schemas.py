"""Declared schemas: landed API pages (input) and table contracts (output).

Input schemas are explicit on purpose: inference over landed pages types an
always-empty list (say, reactions no one has made yet) as ``array<string>``
and the child table built from it breaks. Timestamps stay text on landing and
are parsed during normalisation.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _s(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


ACTOR = _s(("login", StringType()), ("avatarUrl", StringType()), ("url", StringType()))

REACTION = _s(("user", ACTOR), ("content", StringType()), ("createdAt", StringType()))

REACTION_GROUP = _s(("content", StringType()), ("createdAt", StringType()))

REACTION_CONNECTION = _s(("totalCount", LongType()), ("nodes", ArrayType(REACTION)))

COMMENT = _s(
    ("id", StringType()),
    ("url", StringType()),
    ("body", StringType()),
    ("author", ACTOR),
    ("authorAssociation", StringType()),
    ("createdAt", StringType()),
    ("reactionGroups", ArrayType(REACTION_GROUP)),
)

COMMENT_CONNECTION = _s(("totalCount", LongType()), ("nodes", ArrayType(COMMENT)))

ITEM = _s(
    ("number", LongType()),
    ("url", StringType()),
    ("title", StringType()),
    ("body", StringType()),
    ("author", ACTOR),
    ("authorAssociation", StringType()),
    ("closed", BooleanType()),
    ("closedAt", StringType()),
    ("createdAt", StringType()),
    ("state", StringType()),
    ("updatedAt", StringType()),
    ("reactions", REACTION_CONNECTION),
    ("comments", COMMENT_CONNECTION),
)

PAGE_INFO = _s(("endCursor", StringType()), ("startCursor", StringType()))

STAR_EDGE = _s(("starredAt", StringType()), ("node", ACTOR))

ITEM_CONNECTION = _s(
    ("totalCount", LongType()), ("pageInfo", PAGE_INFO), ("nodes", ArrayType(ITEM))
)

STAR_CONNECTION = _s(("pageInfo", PAGE_INFO), ("edges", ArrayType(STAR_EDGE)))

RATE_LIMIT = _s(
    ("limit", LongType()), ("cost", LongType()), ("remaining", LongType()), ("resetAt", StringType())
)

REPOSITORY = _s(
    ("issues", ITEM_CONNECTION),
    ("pullRequests", ITEM_CONNECTION),
    ("stargazers", STAR_CONNECTION),
)

# Landing envelope: the fetcher writes one JSON line per API response and adds
# where it came from. ``data_keys`` is filled by the reader (top-level keys of
# ``data``) so the one-connection shape check needs no second parse later.
# ``list_offset``: a child list too long for one response goes on in further lines
# of the same page; it is the position of the first child they hold (NULL = 0).
PAGE = _s(
    ("owner", StringType()),
    ("name", StringType()),
    ("resource", StringType()),
    ("page_no", LongType()),
    ("landed_at", StringType()),
    ("list_offset", LongType()),
    ("data", _s(("repository", REPOSITORY), ("rateLimit", RATE_LIMIT))),
    ("errors", ArrayType(StringType())),
)

# One entry of a comment-reaction bundle: ``{"node_0": {...}, "rateLimit": {...}}``;
# ``cost`` and ``remaining`` are set in the ``rateLimit`` entry only.
BUNDLE_NODE = _s(
    ("id", StringType()), ("reactions", REACTION_CONNECTION), ("cost", LongType()), ("remaining", LongType())
)
BUNDLE_PAGE = _s(
    ("owner", StringType()),
    ("name", StringType()),
    ("request_no", LongType()),
    ("list_offset", LongType()),
    ("data", MapType(StringType(), BUNDLE_NODE)),
    ("errors", ArrayType(StringType())),
)

# Repository event: a fixed envelope; the open-ended rest stays packed JSON.
EVENT_ACTOR = _s(
    ("id", LongType()),
    ("login", StringType()),
    ("display_login", StringType()),
    ("url", StringType()),
    ("avatar_url", StringType()),
)
EVENT_REPO = _s(("id", LongType()), ("name", StringType()), ("url", StringType()))
EVENT_ORG = _s(("id", LongType()), ("login", StringType()), ("url", StringType()), ("avatar_url", StringType()))

EVENT = _s(
    ("id", StringType()),
    ("type", StringType()),
    ("actor", EVENT_ACTOR),
    ("repo", EVENT_REPO),
    ("org", EVENT_ORG),
    ("public", BooleanType()),
    ("created_at", StringType()),
    ("payload", StringType()),
)

# Connection names in the landed pages, by resource name.
CONNECTIONS = {"issues": "issues", "pull_requests": "pullRequests", "stargazers": "stargazers"}


# ---------------------------------------------------------------------------
# Output contracts (column name, type, description). ``int`` ids of the
# reference are widened to bigint so ids past 2**31 load; ``uuid`` is text.

def contract(*cols: tuple[str, DataType, str]) -> StructType:
    return StructType(
        [StructField(n, t, True, metadata={"comment": d}) for n, t, d in cols]
    )


TOP_COMMENT_AUTHORS = contract(
    ("username", StringType(), "Login that wrote the comments, NULL where it is unknown"),
    ("total_comments", LongType(), "How many comments that login wrote"),
    ("type", StringType(), "issue or pull_request"),
)

COMMENT_VOLUME_BY_DAY = contract(
    ("day", DateType(), "Calendar day in UTC"),
    ("num_comments", LongType(), "How many comments were written that day"),
    ("type", StringType(), "issue or pull_request"),
)

AVG_COMMENT_LENGTH = contract(
    ("type", StringType(), "issue or pull_request"),
    ("avg_length", DoubleType(), "Characters in a comment body, on average"),
)

TEAM_PERFORMANCE_SUMMARY = contract(
    ("team_name", StringType(), "Team the tickets went to"),
    ("total_tickets", LongType(), "How many tickets went to the team"),
    ("avg_first_reply_secs", DoubleType(), "Seconds until a ticket got its first reply, on average"),
    ("avg_resolution_secs", DoubleType(), "Seconds until a closed ticket was closed for good, on average"),
    ("avg_csat", DoubleType(), "Customers' rating of 1 to 5, on average over rated tickets"),
)

NPS_BY_SUBSCRIPTION_MONTH = contract(
    ("months_subscribed", IntegerType(), "Months of subscription, rounded to whole ones"),
    ("NPS", FloatType(), "Promoters less detractors, in percent of all answers of that month"),
)

USER_CORE_ACTIVITY_SUMMARY = contract(
    ("user_id", LongType(), "Key of the user"),
    ("user_email", StringType(), "Address the user signed up with"),
    ("ticket_id", LongType(), "Key of one of the user's tickets, NULL without any"),
    ("ticket_status", StringType(), "State the ticket is in"),
    ("ticket_created", TimestampNTZType(), "When the ticket was opened"),
    ("team_name", StringType(), "Name of the user's team, NULL without one"),
    ("event_id", StringType(), "Key of one of the user's events, NULL without any"),
    ("event_time", TimestampNTZType(), "When the event happened"),
    ("event_name", StringType(), "What the user did"),
)

CONTRACTS = {
    "top_comment_authors": TOP_COMMENT_AUTHORS,
    "comment_volume_by_day": COMMENT_VOLUME_BY_DAY,
    "avg_comment_length": AVG_COMMENT_LENGTH,
    "team_performance_summary": TEAM_PERFORMANCE_SUMMARY,
    "nps_by_subscription_month": NPS_BY_SUBSCRIPTION_MONTH,
    "user_core_activity_summary": USER_CORE_ACTIVITY_SUMMARY,
}
