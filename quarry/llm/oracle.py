"""DuckDB SQL for the results that SQL can express, on the driver tables alone."""

from __future__ import annotations

OP4_DECONTAM_FM = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
),
phrases AS (
    SELECT DISTINCT item_id, array_to_string(w[k:k + 9], ' ') AS phrase, least(len(w), 10) AS size
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(k)
    WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM phrases),
places AS (
    SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS phrase
    FROM words, sizes, unnest(range(1, len(w) - size + 2)) AS t(k)
),
hits AS (SELECT doc_id, item_id, k, size FROM places JOIN phrases USING (phrase, size)),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(k, k + size)) AS t(p) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hits GROUP BY doc_id
)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP5_MIX_WATERFILL = r"""
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5(concat_ws('|', '20240601', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 15))::BIGINT AS h
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM sized GROUP BY source
),
ranked AS (  -- fullest first: the order in which sources reach their cap
    SELECT *, 3 * source_size AS cap,
           coalesce(sum(3 * source_size) OVER earlier, 0)::BIGINT AS cap_before,
           (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::BIGINT AS weight_left,
           (sum(source_size) OVER ())::BIGINT AS total
    FROM sources
    WINDOW earlier AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
    -- Capping one more source raises the level until no further one is above its cap.
    SELECT max((total - cap_before)::DOUBLE / weight_left) AS height FROM ranked
),
targets AS (
    SELECT source, source_size, least(cap::DOUBLE, height * weight) AS target
    FROM ranked, level
),
placed AS (
    SELECT d.*, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN target - whole * source_size > 0
                             AND upto - size / 2 <= target - whole * source_size THEN 1 ELSE 0 END)::BIGINT AS taken
FROM placed
"""

OP7_MINHASH_BBIT = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[k:k + 2], ' ') AS s
    FROM words, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(k)
    WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
-- Equal sets are one class; only their smallest documents are paired.
classes AS (
    SELECT doc_id, min(doc_id) OVER (PARTITION BY digest) AS rep
    FROM (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS digest FROM shingles GROUP BY doc_id)
),
held AS (SELECT shingles.* FROM shingles SEMI JOIN classes ON classes.rep = shingles.doc_id),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_both
    FROM held AS a JOIN held AS b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT u, v FROM shared JOIN sizes AS x ON x.doc_id = u JOIN sizes AS y ON y.doc_id = v
    WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
),
steps AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM held GROUP BY doc_id
    UNION
    SELECT reached.doc_id, steps.v FROM reached JOIN steps ON steps.u = reached.other
),
lowest AS (SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, w.doc_id) AS component_id,
       coalesce(component, w.doc_id) = w.doc_id AS kept
FROM words AS w LEFT JOIN sizes ON sizes.doc_id = w.doc_id
LEFT JOIN classes ON classes.doc_id = w.doc_id LEFT JOIN lowest ON lowest.doc_id = classes.rep
"""

OP8_URL_RULES = r"""
WITH rules(rule_host, rule_path, action) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
split AS (
    SELECT page_id,
           coalesce(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END, '') AS rest
    FROM pages
),
located AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM split
),
fitting AS (
    SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(action, length(rule_host || rule_path)) AS action
    FROM located JOIN rules
      ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM located LEFT JOIN fitting USING (page_id)
"""

OP11_EMBED_RABITQ = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v,
           sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v
    FROM vectors a JOIN vectors b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
),
reach AS (
    SELECT vec_id AS u, vec_id AS v FROM embeddings
    UNION
    SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
)
SELECT r.u AS vec_id, (SELECT count(*) FROM links l WHERE l.u = r.u) AS n_links, min(r.v) AS component_id,
       min(r.v) = r.u AS kept
FROM reach r GROUP BY r.u
"""

# crc32 bit by bit; the repair as shortest paths through the four states of a finite
# automaton (nothing yet, after s, after u, after a), one step of the recursion a row.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _step(state: str, cost: str, letter: str, line: str | None = None, when: str = "true") -> str:
    """A state's path with one more edit, or null."""
    lines = f"list_append({state}.lines, {line})" if line else f"{state}.lines"
    return (
        f"CASE WHEN {state} IS NOT NULL AND ({when}) THEN "
        f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'lines': {lines}}} END"
    )


def _least(*paths: str) -> str:
    return f"list_min(list_filter([{', '.join(paths)}], lambda x: x IS NOT NULL))"


def _moves(name: str, initial: str, sources: tuple[str, ...]) -> list[str]:
    """Ways to speak as ``name``: keep a row of that initial, or give it the role."""
    return [
        way
        for s in sources
        for way in (
            _step(s, "extra", "K", "role || ':' || text", f"NOT must_go AND role[1:1] = '{initial}'"),
            _step(s, "1 + extra", "R", f"'{name}:' || text", "NOT must_go"),
        )
    ]


_INSERTED = f"""
           {_least('s0')} AS i0, {_least('ss')} AS i_s,
           {_least('su', *(_step(s, '5', 'I', "'user:'") for s in ('s0', 'ss', 'sa')))} AS u1,
           {_least('sa', _step('su', '5', 'I', "'assistant:'"))} AS a1"""

OP13_CONV_GLR = f"""
WITH RECURSIVE spoken AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_CRC32.format(text="(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS harm
    FROM conversations
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
           CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM spoken WHERE harm <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
           right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last_sign
    FROM damaged
),
faulty AS (
    SELECT *, CASE WHEN last_sign = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                   WHEN last_sign NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY place) AS before
    FROM placed
),
steps AS (
    SELECT *, fault IN ('blank', 'duplicate') AS must_go, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra
    FROM faulty
),
walk AS (
    SELECT conv_id, 0::BIGINT AS place, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS s0,
           NULL::STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[]) AS ss,
           NULL::STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[]) AS su,
           NULL::STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[]) AS sa
    FROM (SELECT DISTINCT conv_id FROM damaged)
    UNION ALL
    SELECT conv_id, place, n0, ns, nu, na FROM (
        SELECT conv_id, place,
               {_least(_step('i0', '2', 'D'))} AS n0,
               {_least(_step('i_s', '2', 'D'), _step('i0', 'extra', 'K', "role || ':' || text", "NOT must_go AND role[1:1] = 's'"))} AS ns,
               {_least(_step('iu', '2', 'D'), *_moves('user', 'u', ('i0', 'i_s', 'ia')))} AS nu,
               {_least(_step('ia', '2', 'D'), *_moves('assistant', 'a', ('iu',)))} AS na
        FROM (
            SELECT *, {_least('u1', _step('a1', '5', 'I', "'user:'"))} AS iu,
                   {_least('a1', _step('u1', '5', 'I', "'assistant:'"))} AS ia
            FROM (
                SELECT t.conv_id, t.place, t.role, t.text, t.must_go, t.extra, {_INSERTED}
                FROM walk w JOIN steps t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.place = w.place + 1
            )
        )
    )
),
counted AS (
    SELECT conv_id, max(place) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal
    FROM steps GROUP BY conv_id
),
ended AS (
    SELECT c.*, {_least('s0', 'sa', _step('su', '5', 'I', "'assistant:'"), _step(f"({_step('ss', '5', 'I', chr(39) + 'user:' + chr(39))})", '5', 'I', "'assistant:'"))} AS path
    FROM counted c JOIN walk w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.place
)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(path.cost, 0)::BIGINT AS cost,
       coalesce(path.audit, '') AS audit,
       sha256(coalesce(array_to_string(path.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op4_decontam_fm": OP4_DECONTAM_FM,
    "op5_mix_waterfill": OP5_MIX_WATERFILL,
    "op7_minhash_bbit": OP7_MINHASH_BBIT,
    "op8_url_rules": OP8_URL_RULES,
    "op11_embed_rabitq": OP11_EMBED_RABITQ,
    "op13_conv_glr": OP13_CONV_GLR,
}
