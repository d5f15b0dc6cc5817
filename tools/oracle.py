"""What every registered query must return, as DuckDB SQL on the driver tables.

Each statement works from the raw columns of the driver tables and the rules in
FIXTURES.md (part B) and ``tools.fixture_pages``; there is no layer of
stand-in tables in between. Where a result can be reached another way than the
Spark plan reaches it, it is: counts side by side and unpivoted instead of a
tagged union, integer rounding instead of casts, lists unnested instead of joins.
Means are rounded to six places on both sides.
"""

from __future__ import annotations

# A user's login: every thirtieth user has no author record.
LOGIN = "CASE WHEN user_id % 30 <> 0 THEN concat('user', user_id) END"

TOP_COMMENT_AUTHORS = f"""
WITH per_user AS (
    SELECT {LOGIN} AS username,
           count(*) FILTER (event_type NOT IN ('click', 'error')) AS issue,
           count(*) FILTER (event_type IN ('click', 'error')) AS pull_request
    FROM events GROUP BY 1)
SELECT username, total_comments, type
FROM (UNPIVOT per_user ON issue, pull_request INTO NAME type VALUE total_comments)
WHERE total_comments > 0"""

COMMENT_VOLUME_BY_DAY = """
WITH per_day AS (
    SELECT ts::DATE AS day,
           count_if(event_type NOT IN ('click', 'error')) AS issue,
           count_if(event_type IN ('click', 'error')) AS pull_request
    FROM events GROUP BY ts::DATE)
SELECT day, num_comments::BIGINT AS num_comments, type
FROM (UNPIVOT per_day ON issue, pull_request INTO NAME type VALUE num_comments)
WHERE num_comments > 0"""

AVG_COMMENT_LENGTH = """
SELECT kind.type,
       (SELECT round(avg(length(text)), 6) FROM conversations WHERE list_contains(kind.roles, role)) AS avg_length
FROM (VALUES ('issue', ['user', 'system']), ('pull_request', ['assistant'])) AS kind(type, roles)"""

TEAM_PERFORMANCE_SUMMARY = """
SELECT o_orderpriority AS team_name, count(*) AS total_tickets,
       round(avg(o_orderkey % 3600), 6) AS avg_first_reply_secs,
       round(avg(o_orderkey * 37 % 864000) FILTER (o_orderstatus <> 'O'), 6) AS avg_resolution_secs,
       round(avg(1 + o_orderkey % 5) FILTER (o_orderkey % 4 <> 0), 6) AS avg_csat
FROM orders GROUP BY ALL"""

# Months are halves of user_id % 36; a half month goes to the even neighbour.
# Scores are event_id % 12 (11: none); shares are 32-bit floats.
NPS_BY_SUBSCRIPTION_MONTH = """
WITH answers AS (
    SELECT CASE WHEN user_id % 50 <> 49 THEN (user_id % 36 + (user_id % 36 % 4 = 3)::INT) // 2 END AS month,
           event_id % 12 AS score
    FROM events),
shares AS (
    SELECT month::INTEGER AS months_subscribed,
           count_if(score IN (9, 10))::FLOAT / count(*)::FLOAT AS up,
           count_if(score < 7)::FLOAT / count(*)::FLOAT AS down
    FROM answers GROUP BY month
    ORDER BY month NULLS LAST LIMIT 12)
SELECT months_subscribed, ((up - down) * 100::FLOAT)::FLOAT AS NPS FROM shares"""

USER_CORE_ACTIVITY_SUMMARY = """
WITH bought AS (
    SELECT o_custkey, list({'id': o_orderkey, 'status': o_orderstatus, 'made': o_orderdate}) AS tickets
    FROM orders GROUP BY o_custkey),
did AS (
    SELECT user_id, list({'id': event_id::VARCHAR, 'at': ts, 'what': event_type}) AS acts
    FROM events GROUP BY user_id),
beside AS (
    SELECT c_custkey, c_name,
           (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey AND c_custkey % 10 <> 0) AS team_name,
           unnest(coalesce(tickets, [NULL])) AS ticket, acts
    FROM customer
    LEFT JOIN bought ON o_custkey = c_custkey
    LEFT JOIN did ON user_id = c_custkey),
pairs AS (SELECT * EXCLUDE (acts), unnest(coalesce(acts, [NULL])) AS act FROM beside)
SELECT c_custkey AS user_id, c_name AS user_email,
       ticket.id AS ticket_id, ticket.status AS ticket_status, ticket.made AS ticket_created, team_name,
       act.id AS event_id, act.at AS event_time, act.what AS event_name
FROM pairs"""


# ---------------------------------------------------------------------------
# Landed pages (the fixture rules are listed in tools.fixture_pages)

NORMALIZE_COMMENTS = """
SELECT 'driver' AS owner, 'conversations' AS name, conv_id AS number,
       (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS list_idx,
       concat('c', conv_id, '_', turn) AS id, text AS body, role AS author__login,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(conv_id * 60 + turn) AS created_at
FROM conversations"""


def _item_totals(kept: str) -> str:
    return f"""
SELECT user_id AS number, coalesce(n_orders, 0) AS reactions_total_count, n_events AS comments_total_count,
       ({kept.format('n_events')})::INTEGER AS comments_listed,
       ({kept.format('coalesce(n_orders, 0)')})::INTEGER AS reactions_listed,
       n_events > {kept.format('n_events')} AS comments_truncated
FROM (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id)
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) ON o_custkey = user_id"""


NORMALIZE_ITEM_TOTALS = _item_totals("{}")
NORMALIZE_ITEM_TOTALS_CAPPED = _item_totals("least({}, 50)")

REACTED_COMMENTS = f"""
WITH placed AS (
    SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)::INTEGER AS list_idx FROM events)
SELECT user_id AS number, list_idx, concat('e', event_id) AS id, {LOGIN} AS author__login, ts AS created_at
FROM placed
WHERE event_id IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate IS NOT NULL)"""

ATTACH_COMMENT_REACTIONS = """
SELECT user_id AS number, concat('e', event_id) AS id,
       nullif(count(l_orderkey), 0) AS reactions_total_count,
       nullif(count(l_orderkey), 0)::INTEGER AS n_reactions
FROM events LEFT JOIN lineitem ON l_orderkey = event_id
GROUP BY event_id, user_id"""

COMMENT_RECONCILIATION = """
WITH asked AS (
    SELECT event_id FROM events
    WHERE user_id % 7 <> 3 AND event_id IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate IS NOT NULL)),
answers AS (
    SELECT event_id, ceil(count(*) / 100)::BIGINT AS n FROM events JOIN lineitem ON l_orderkey = event_id
    WHERE event_id // 50 % 10 <> 3 GROUP BY event_id)
SELECT concat('e', coalesce(a.event_id, b.event_id)) AS id,
       CASE WHEN b.event_id IS NULL THEN 'unanswered' WHEN a.event_id IS NULL THEN 'unasked' ELSE 'answered' END AS status,
       coalesce(n, 0) AS n_answers
FROM asked a FULL JOIN answers b ON a.event_id = b.event_id"""

ITEM_AND_COMMENT_REACTIONS = """
SELECT 'comment' AS level, user_id AS number, concat('e', event_id) AS comment_id,
       (row_number() OVER (PARTITION BY event_id
                           ORDER BY l_linenumber, l_shipdate, l_suppkey, l_returnflag) - 1)::INTEGER AS list_idx,
       concat('supp', l_suppkey) AS user__login, l_returnflag AS content, l_shipdate AS created_at
FROM events JOIN lineitem ON l_orderkey = event_id
UNION ALL
SELECT 'item', o_custkey, NULL,
       (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INTEGER,
       concat('cust', o_custkey), o_orderpriority, o_orderdate
FROM orders WHERE o_custkey IN (SELECT user_id FROM events)"""

STARGAZERS = """
SELECT 'driver' AS owner, 'customers' AS name,
       TIMESTAMP '2020-01-01 00:00:00' + to_minutes(c_custkey) AS starred_at,
       c_name AS user__login, concat('u/', c_name) AS user__url
FROM customer"""

PAGE_UNCAPPED = """
SELECT event_type AS name, event_id // 100 AS page_no, event_id AS number, ts AS created_at FROM events"""

# The empty page stands behind the last one, so all pages are taken.
PAGE_STOP = PAGE_UNCAPPED

PAGE_CAP = """
SELECT event_type AS name, event_id // 100 AS page_no, event_id AS number, ts AS created_at
FROM events AS e
WHERE (SELECT count(*) FROM events AS earlier
       WHERE earlier.event_type = e.event_type AND earlier.event_id // 100 < e.event_id // 100) < 250"""

PAGES_BY_REPOSITORY = """
SELECT 'driver' AS owner, event_type AS name, event_id // 100 AS page_no,
       (row_number() OVER (PARTITION BY event_type, event_id // 100 ORDER BY event_id DESC) - 1)::INTEGER AS item_idx,
       event_id AS number, event_type AS title
FROM events"""

EVENT_PAGES = "(SELECT event_type AS name, event_id // 100 AS page_no, count(*) AS n FROM events GROUP BY ALL)"

LOAD_AUDIT = f"""
SELECT 'driver' AS owner, name, 'issues' AS resource,
       count(*) AS pages, sum(n)::BIGINT AS items,
       sum(1 + n // 50)::BIGINT AS total_cost, min(5000 - page_no) AS min_remaining
FROM {EVENT_PAGES} GROUP BY name"""

PAGE_ERRORS = f"""
SELECT 'driver' AS owner, name, 'issues' AS resource, count(*) AS pages,
       count(*) FILTER (page_no % 17 = 5) AS error_pages,
       count(*) FILTER (page_no % 23 = 7) AS bad_shape_pages,
       0::BIGINT AS corrupt_pages,
       max(page_no) - min(page_no) + 1 - count(*) AS missing_pages,
       0::BIGINT AS repeated_pages
FROM {EVENT_PAGES} GROUP BY name"""

BUNDLE_AUDIT = """
WITH lists AS (
    SELECT event_id // 50 AS request_no, unnest(range(0, count(*), 100)) AS list_offset
    FROM events JOIN lineitem ON l_orderkey = event_id GROUP BY event_id),
requests AS (SELECT request_no, list_offset, count(*) AS n FROM lists GROUP BY ALL)
SELECT 'driver' AS owner, 'events' AS name, count(*) AS requests, sum(n)::BIGINT AS comments,
       sum(ceil(n / 10))::BIGINT AS total_cost, min(5000 - request_no % 5000) AS min_remaining
FROM requests"""


# ---------------------------------------------------------------------------
# Event feed, replication, statistics

# Which of the three loads (days 1-10 without purchases of 8-10, 8-20, 19 on)
# brings an event first, and whether that is before the cursor has passed it.
INCREMENTAL_EVENTS = """
WITH first_try AS (
    SELECT *, CASE WHEN ts < '2024-01-11' AND (event_type <> 'purchase' OR ts < '2024-01-08') THEN 1
                   WHEN ts < '2024-01-21' THEN 2 ELSE 3 END AS load
    FROM events),
cursors AS (
    SELECT max(ts) FILTER (load = 1) AS after_1, max(ts) FILTER (load <= 2) AS after_2 FROM first_try)
SELECT event_id::VARCHAR AS id, event_type AS type, ts AS created_at, props AS payload
FROM first_try, cursors
WHERE load = 1 OR (load = 2 AND ts >= after_1) OR (load = 3 AND ts >= after_2)"""

# Overlapping landings with a watermark wider than the overlap: every event once.
INCREMENTAL_EVENTS_STREAM = """
SELECT event_id::VARCHAR AS id, event_type AS type, ts AS created_at, props AS payload FROM events"""

LANDED_EVENTS = INCREMENTAL_EVENTS_STREAM

EVENTS_BY_TYPE = """
SELECT event_id::VARCHAR AS id, CASE WHEN event_id % 97 <> 0 THEN event_type END AS type, ts AS created_at,
       json_extract(props, '$.k')::BIGINT AS payload__k, props AS payload
FROM events"""

EVENT_GAP_AUDIT = """
WITH days AS (SELECT ts::DATE AS day, count(*) AS n_events, min(ts) AS oldest, max(ts) AS newest FROM events GROUP BY ts::DATE),
before AS (SELECT *, (SELECT max(ts) FROM events WHERE ts < day) AS prev_cursor FROM days)
SELECT 'driver/events' AS repo, day AS pull_day, n_events, oldest, newest, prev_cursor,
       coalesce(n_events >= 300 AND oldest > prev_cursor, false) AS possible_gap
FROM before"""

# The payloads' values from the columns they were made of.
EVENT_PAYLOADS = """
SELECT event_type AS type, event_id::VARCHAR AS id, ts AS created_at,
       CASE WHEN event_type = 'click' THEN event_id END AS payload__push_id,
       CASE WHEN event_type = 'click' THEN 'refs/heads/main' END AS payload__ref,
       CASE WHEN event_type IN ('view', 'signup') THEN 'created' END AS payload__action,
       CASE WHEN event_type IN ('view', 'signup') THEN event_id END AS payload__comment__id,
       CASE WHEN event_type IN ('view', 'signup') THEN 'it"s ' || event_type END AS payload__comment__body,
       CASE WHEN event_type IN ('view', 'signup')
            THEN '{"login":"user' || user_id || '","siteAdmin":' || (user_id % 2 = 0)::VARCHAR || '}' END AS payload__comment__user,
       CASE WHEN event_type = 'purchase'
            THEN CASE WHEN event_id % 2 = 0 THEN event_id / 4 ELSE (event_id % 1000)::DOUBLE END END AS payload__amount,
       CASE WHEN event_type = 'error' THEN 'error ' || event_id END AS payload__unparsed
FROM events"""

EVENT_PAYLOAD_LISTS = """
WITH commits AS (
    SELECT *, unnest(range(1, event_id % 4 + 2)) AS i FROM events WHERE event_type = 'click' AND event_id % 5 <> 0)
SELECT 'commits' AS list, event_id::VARCHAR AS id, (i - 1)::INTEGER AS list_idx, event_id || '-' || i AS sha,
       i % 2 = 0 AS "distinct",
       '{"check":{"signed":' || (event_id % 2 = 0)::VARCHAR || '},"name":"user' || user_id || '"}' AS author,
       '[' || array_to_string(list_transform(range(1, i), lambda x: event_id::VARCHAR), ',') || ']' AS parents,
       NULL::VARCHAR AS value
FROM commits
UNION ALL
SELECT 'labels', event_id::VARCHAR, place::INTEGER, NULL, NULL, NULL, NULL, CASE place WHEN 0 THEN 'new' ELSE event_type END
FROM (SELECT *, unnest([0, 1]) AS place FROM events WHERE event_type = 'purchase' AND event_id % 3 = 0)"""

EVENT_COVERAGE = """
WITH days AS (
    SELECT ts::DATE AS day, count(*) AS n_events, min(ts) AS oldest, max(ts) AS newest FROM events GROUP BY ts::DATE)
SELECT 'driver/events' AS repo, row_number() OVER (ORDER BY day) AS stretch, oldest, newest, 1::BIGINT AS n_pulls,
       n_events, lag(newest) OVER (ORDER BY day) AS gap_from
FROM days"""

# Rows of the four loads; broken ones never count for a cursor.
_LOADS = """
WITH marked AS (
    SELECT *, event_id % 107 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0 AS bad FROM events),
windows AS (
    SELECT * FROM (VALUES (0, TIMESTAMP '1970-01-01', TIMESTAMP '2024-01-11'), (1, TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-21'),
                          (2, TIMESTAMP '2024-01-19', TIMESTAMP '9999-01-01'), (3, TIMESTAMP '2024-01-19', TIMESTAMP '9999-01-01'))
    AS t(run, low, high)),
landed AS (
    SELECT run, e.* FROM marked e JOIN windows ON ts >= low AND ts < high
    WHERE NOT (run = 0 AND event_type = 'purchase' AND ts >= '2024-01-08')),
cursors AS (
    SELECT w.run, max(l.ts) AS cursor FROM windows w LEFT JOIN landed l ON l.run < w.run AND NOT l.bad GROUP BY w.run),
first_seen AS (SELECT event_id, min(run) AS first FROM landed WHERE NOT bad GROUP BY event_id),
told AS (
    SELECT l.*, cursor, CASE WHEN bad THEN 'rejected' WHEN l.run > first THEN 'repeated'
                             WHEN ts < cursor THEN 'late' ELSE 'loaded' END AS fate
    FROM landed l JOIN cursors USING (run) LEFT JOIN first_seen USING (event_id))"""

EVENT_LOAD_COUNTS = f"""{_LOADS}
SELECT run::BIGINT AS number, count(*) AS read, count(*) FILTER (fate = 'loaded') AS loaded,
       count(*) FILTER (fate = 'late') AS late, count(*) FILTER (fate = 'repeated') AS repeated,
       count(*) FILTER (fate = 'rejected') AS rejected
FROM told GROUP BY run"""

EVENT_DEAD_LETTERS = """
SELECT 'line is not JSON' AS reason, NULL::VARCHAR AS id, NULL::VARCHAR AS type, NULL::TIMESTAMP AS created_at,
       NULL::VARCHAR AS payload, 'broken ' || event_id AS line
FROM events WHERE event_id % 107 = 0
UNION ALL
SELECT CASE WHEN event_id % 101 = 0 THEN 'no id' ELSE 'no readable time' END,
       CASE WHEN event_id % 101 <> 0 THEN event_id::VARCHAR END, event_type,
       CASE WHEN event_id % 103 <> 0 THEN ts END, props, NULL
FROM events WHERE event_id % 107 <> 0 AND (event_id % 101 = 0 OR event_id % 103 = 0)"""

EVENT_LATE_ROWS = f"""{_LOADS.replace("event_id % 107 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0", "false")}
SELECT event_id::VARCHAR AS id, event_type AS type, ts AS created_at, props AS payload, cursor AS missed_cursor
FROM told WHERE fate = 'late'"""

EVENT_TYPE_TABLES = f"""{_LOADS.replace("event_id % 107 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0", "false")}
SELECT 'repo_events_' || event_type AS table_name, event_id::VARCHAR AS id, ts AS created_at, props AS payload
FROM told WHERE fate = 'loaded'"""

def _stream(target: str, source: str, **columns: str) -> str:
    """A copied table's row of counts and the sum of its rows' digests."""
    texts = ", ".join(f"coalesce(({columns[c]})::VARCHAR, '~')" for c in sorted(columns))
    digest = f"('0x' || substr(md5(concat_ws('|', {texts})), 1, 15))::BIGINT"
    return (
        f"SELECT '{target}' AS table_name, count(*) AS num_rows, {len(columns)} AS column_count, "
        f"coalesce(sum({digest}), 0)::VARCHAR AS content_hash FROM {source}"
    )


_MICROS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

REPLICATE_TABLES = " UNION ALL ".join(
    [
        _stream(
            "public_tickets", "orders", id="o_orderkey", user_id="o_custkey", status="o_orderstatus",
            created_at=_MICROS.format("o_orderdate"), team_name="o_orderpriority",
            seconds_to_first_reply="o_orderkey % 3600",
            seconds_to_last_close="CASE WHEN o_orderstatus <> 'O' THEN o_orderkey * 37 % 864000 END",
            csat_rating="CASE WHEN o_orderkey % 4 <> 0 THEN 1 + o_orderkey % 5 END",
        ),
        _stream(
            "public_events", "events", id="event_id", user_id="user_id", time=_MICROS.format("ts"), name="event_type"
        ),
        _stream("public_teams", "nation", id="n_nationkey", name="n_name"),
        _stream("public_users", "customer", id="c_custkey", email="c_name", team_id="CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END"),
        _stream(
            "public_nps_responses", "events",
            months_subscribed="CASE WHEN user_id % 50 <> 49 THEN (user_id % 36 * 0.5)::DECIMAL(38,6) END",
            nps_response="CASE WHEN event_id % 12 <> 11 THEN event_id % 12 END",
        ),
    ]
)

CONTRACT_VERSIONS = """
SELECT 0 AS version, event_id % 1000 AS id, event_type AS name, NULL::BIGINT AS user_id, NULL::TIMESTAMP AS ts FROM events
UNION ALL SELECT 1, event_id, event_type, user_id, NULL FROM events
UNION ALL SELECT 2, event_id, NULL, user_id, ts FROM events"""

TABLE_STATISTICS = """
SELECT 'spark_catalog' AS database_name, 'analytics' AS schema_name, 'team_performance_summary' AS table_name,
       count(DISTINCT o_orderpriority) AS num_rows, 5 AS column_count
FROM orders"""


# ---------------------------------------------------------------------------
# End to end: events are loaded as issue comments, conversations as pull request
# comments, then the derived tables are made from the loaded ones.

PIPELINE_COMMENT_AUTHORS = f"""
SELECT DISTINCT {LOGIN} AS username, count(*) OVER (PARTITION BY {LOGIN}) AS total_comments, 'issue' AS type
FROM events
UNION ALL
SELECT DISTINCT role, count(*) OVER (PARTITION BY role), 'pull_request' FROM conversations"""

PIPELINE_AVG_COMMENT_LENGTH = """
SELECT unnest(['issue', 'pull_request']) AS type,
       unnest([(SELECT round(sum(length(props))::DOUBLE / count(props), 6) FROM events),
               (SELECT round(sum(length(text))::DOUBLE / count(text), 6) FROM conversations)]) AS avg_length"""

LOAD_AND_DERIVE = f"""
WITH counted(schema_name, table_name, num_rows, column_count) AS (
    SELECT 'gh_data', 'top_comment_authors',
           (SELECT count(DISTINCT coalesce({LOGIN}, '')) FROM events)
           + (SELECT count(DISTINCT role) FROM conversations), 3
    UNION ALL SELECT 'gh_data', 'comment_volume_by_day',
           (SELECT count(DISTINCT ts::DATE) FROM events)
           + (SELECT count(DISTINCT (conv_id * 60 + turn) // 1440) FROM conversations), 3
    UNION ALL SELECT 'gh_data', 'avg_comment_length', 2, 2
    UNION ALL SELECT 'analytics', 'team_performance_summary', (SELECT count(DISTINCT o_orderpriority) FROM orders), 5
    UNION ALL SELECT 'analytics', 'nps_by_subscription_month',
           least(12, (SELECT count(DISTINCT CASE WHEN user_id % 50 = 49 THEN -1
                                                 ELSE (user_id % 36 + (user_id % 36 % 4 = 3)::INT) // 2 END)
                      FROM events)), 2
    UNION ALL SELECT 'analytics', 'user_core_activity_summary',
           (SELECT sum(greatest(1, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey))
                       * greatest(1, (SELECT count(*) FROM events WHERE user_id = c_custkey))) FROM customer), 9)
SELECT 'spark_catalog' AS database_name, schema_name, table_name, num_rows::BIGINT AS num_rows, column_count
FROM counted"""
