"""Near duplicates, repeated bytes, mixing, quality, URL rules, nearest neighbours,
pipeline: edges and brute-force versions."""

from __future__ import annotations

import time

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quarry.llm import ann_ads, dedup_pfp, minhash_bbit, mix_waterfill, quality_kn, url_rules
from quarry.llm.catalog import QUERIES
from quarry.llm.oracle import ORACLE_SQL
from tests.llm import brute
from tools.oracle_check import _digest

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


def documents(spark, rows):
    """Rows with columns whose names the operators use inside."""
    return spark.createDataFrame(
        [(i, t, "x", 1, 2, b"z", "r") for i, t in rows],
        "doc_id long, text string, row string, uid int, size int, data binary, h string",
    )


def words(rng, n, vocabulary=5_000):
    return " ".join(f"w{k}" for k in rng.integers(0, vocabulary, n))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(columns, want.fetchall())


# ---------------------------------------------------------------------------
# Near duplicates


def near(spark, rows, **kw):
    got = minhash_bbit.near_duplicates(documents(spark, rows), **kw).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def test_near_duplicates_of_edges(spark):
    rng = np.random.default_rng(0)
    base = words(rng, 200).split()
    rows = [(k, " ".join(base[:k] + [f"x{k}"] + base[k + 1 :])) for k in range(1, 9)]  # one word changed each
    rows += [(20, " ".join(base)), (21, " ".join(base).upper()), (22, "  " + "\n".join(base) + "\t")]
    rows += [(30, None), (31, ""), (32, " \t\n"), (33, "two words"), (34, "two  WORDS"), (35, "one"), (36, words(rng, 30_000))]
    want = brute.near_duplicates(rows)
    assert near(spark, rows) == want
    assert near(spark, rows, cell=2) == want  # several cells a side
    assert len({c for _, c in want.values()}) < len(rows)


def test_near_duplicate_chains_join_across_leaders(spark):
    """A long chain of edits: neighbours are near, the ends share nothing."""
    rng = np.random.default_rng(1)
    text = words(rng, 120).split()
    rows = []
    for k in range(60):
        rows.append((k, " ".join(text)))
        text[2 * k], text[2 * k + 1] = f"c{k}", f"d{k}"
    want = brute.near_duplicates(rows)
    assert near(spark, rows, cell=8) == want
    assert {c for _, c in want.values()} == {0}


def test_rows_of_one_id_and_no_id(spark):
    text = "a b c d e f g h"
    got = minhash_bbit.near_duplicates(documents(spark, [(5, text), (5, text), (9, text), (None, text)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("5", "5", True), ("5", "5", True), ("9", "5", False), ("None", "None", True)
    ]
    docs = documents(spark, [(5, text), (5, text), (9, text), (None, text)])
    kept = minhash_bbit.keep_one(docs, minhash_bbit.near_duplicates(docs))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "None"] and kept.columns == docs.columns
    assert near(spark, []) == {}


def test_unlike_texts_of_one_id_stay(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    for rows in ([(3, a), (5, a), (5, b), (7, a), (7, b), (7, "x y z")], [(5, a), (5, b), (5, a), (6, b), (6, "x y z")]):
        for given in (rows, rows[::-1]):
            docs = documents(spark, given)
            kept = minhash_bbit.keep_one(docs, minhash_bbit.near_duplicates(docs)).collect()
            assert sorted(r.text for r in kept if r.doc_id != 7) == [a, b] + ([] if rows[0][0] == 3 else ["x y z"])


def test_op7_on_documents(spark):
    d = pq.read_table(f"{MID}/documents.parquet").to_pandas()
    want = brute.near_duplicates(zip(d.doc_id.tolist(), d.text.tolist()))
    got = QUERIES["op7_minhash_bbit"](spark, MID).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(want)


def test_b_bit_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(2)
    common, n = rng.integers(0, 1 << 63, 600, dtype=np.uint64), 4096
    sets = [np.concatenate((common, rng.integers(0, 1 << 63, 100, dtype=np.uint64))) for _ in range(2)]
    bounds = np.array([0, 700, 1400])
    sig = minhash_bbit.packed(minhash_bbit.minima(np.concatenate(sets), bounds, n))
    fields = np.arange(64 // minhash_bbit.BITS) * minhash_bbit.BITS
    parts = (sig[:, :, None] >> fields.astype(np.uint64)) & np.uint64(3)
    equal = (parts[0] == parts[1]).mean()
    chance = 2.0**-minhash_bbit.BITS
    assert abs((equal - chance) / (1 - chance) - 600 / 800) < 0.05


# ---------------------------------------------------------------------------
# Repeated bytes


def repeated(spark, rows, **kw):
    got = dedup_pfp.repeated_spans(documents(spark, rows), **kw).collect()
    return got


def check_bytes(spark, rows, size=dedup_pfp.SIZE, **kw):
    import hashlib

    want = brute.repeated_bytes(rows, size)
    got = repeated(spark, rows, size=size, **kw)
    assert len(got) == len(rows)
    for r in got:
        found = (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
        assert found == want[r.doc_id], r.doc_id
    return want


def test_repeated_bytes_of_edges(spark):
    rng = np.random.default_rng(3)
    passage = words(rng, 80)
    rows = [(k, words(rng, 60) + f" é{k} " + passage + words(rng, 60)) for k in range(4)]
    rows += [(10, "ab" * 700), (11, "q" * 450), (12, "exact copy " * 30), (13, "exact copy " * 30), (14, None), (15, ""),
             (16, passage[:199]), (17, passage[:200]), (18, words(rng, 20_000)), (19, "Ü" * 99 + passage[5:300])]
    # copies with a word changed every so often: repeats of every length around the limit
    long = words(rng, 900).split()
    for k in range(6):
        own = list(long)
        for at in range(k, 900, 29 + 3 * k):
            own[at] = f"y{k}"
        rows.append((30 + k, " ".join(own)))
    want = check_bytes(spark, rows)
    assert sum(w[1] > 0 for w in want.values()) > 8
    check_bytes(spark, rows, size=90, block=5)
    assert repeated(spark, []) == []


def test_repeated_rows_remove_each_other(spark):
    text = "the same text over and over " * 20
    rows = repeated(spark, [(1, text), (1, text), (None, text + "x"), (None, "short")])
    assert sorted((str(r.doc_id), len(r.kept)) for r in rows) == [("1", 0), ("1", 0), ("None", 1), ("None", 5)]


def test_op6_on_documents(spark):
    d = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    want = brute.repeated_bytes(zip(d.doc_id.tolist(), d.text.tolist()))
    got = QUERIES["op6_dedup_pfp"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


# ---------------------------------------------------------------------------
# Mixing


def mixed(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, h int, copies int")
    return mix_waterfill.mix(docs, **kw)


def rows_of(*docs):
    return [(i, t, s, "x", 1, 2) for i, t, s in docs]


def test_mix_fills_and_caps(spark):
    rng = np.random.default_rng(4)
    docs = [(k, words(rng, int(rng.integers(1, 60))), "abcd"[int(rng.integers(0, 4)) if k % 3 else 0]) for k in range(900)]
    docs += [(5000, "one two three", None), (5001, None, "d"), (5002, "", "e"), (5003, "   ", "e")]
    got = mixed(spark, rows_of(*docs)).select("row.doc_id", "size", "source_size", "target", "copies", "taken", "row.source").collect()
    sizes, targets, taken, biggest = {}, {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        biggest[r.source] = max(biggest.get(r.source, 0), r.size)
        targets[r.source] = r.target
        assert r.taken <= 3 * r.size
    weight = dict(zip(sorted(s for s in sizes if s) + [None], [5, 2, 1, 5, 2, 1]))
    open_, want = set(sizes), {}
    while True:  # water-filling by hand
        level = (sum(sizes.values()) - sum(want.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            break
        want |= {s: 3 * sizes[s] for s in full}
        open_ -= full
    want |= {s: level * weight[s] for s in open_}
    for s in sizes:
        assert sizes[s] == next(r.source_size for r in got if r.source == s)
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= biggest[s]
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))


def test_mix_repeats_its_choice(spark):
    docs = rows_of(*[(k, "a b c", "ab"[k % 2]) for k in range(200)])
    one = mixed(spark, docs).select("row.doc_id", "copies")
    two = mixed(spark, docs[::-1]).select("row.doc_id", "copies")
    assert one.exceptAll(two).count() == 0
    again = mix_waterfill.repeated(mixed(spark, docs))
    assert again.columns == ["doc_id", "text", "source", "size", "h", "copies"]
    assert again.count() == one.agg(F.sum("copies")).first()[0]


def test_mix_of_nothing(spark):
    assert mixed(spark, []).count() == 0
    empty = mixed(spark, rows_of((1, None, "a"), (2, "", None))).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0), (0, 0.0, 0)]


# ---------------------------------------------------------------------------
# URL rules

RULES = [("org", "/", "allow"), ("a.org", "/x/", "block"), ("a.org", "/x/y/", "allow"), ("b.a.org", "/x/", "allow"),
         ("a.org", "", "block"), ("com", "/p", "block"), ("com", "/p", "allow")]


def brute_verdict(host, path):
    best = None
    for h, p, action in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), len(h), action == "block")
            if best is None or rank > best[0]:
                best = (rank, h + p, action)
    return (best[1], best[2]) if best else (None, "allow")


def test_url_rules_against_all_rules(spark):
    hosts = ["org", "a.org", "A.ORG", "b.a.org", "c.b.a.org", "ba.org", "x.com", "com", "net", "", "a.org:80"]
    paths = ["", "/", "/x", "/x/", "/x/y/z", "/X/", "/p", "/pq", "/x/?q=/y/", "#/x/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "http:/a.org/", "ftp://a.org/x/://y"]
    rows = [(k, u, "kept", 0, "none") for k, u in enumerate(urls * 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, key string, part int, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = {r.page_id: r for r in url_rules.judge_urls(pages, rules).collect()}
    assert len(got) == len(rows)
    for k, u, *_ in rows:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        assert (got[k].host, got[k].path) == (host, path), u
        assert (got[k].rule, got[k].verdict) == brute_verdict(host, path), u


def test_url_rules_on_one_hot_url_and_on_nothing(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://b.a.org/x/1").alias("url"))
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = url_rules.judge_urls(pages, rules, sample_keys=200)
    assert {(r.rule, r.verdict, r["count"]) for r in got.groupBy("rule", "verdict").count().collect()} == {
        ("b.a.org/x/", "allow", 3000)
    }
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}


# ---------------------------------------------------------------------------
# Nearest neighbours


def neighbours(spark, rows, **kw):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = ann_ads.search(vectors, F.col("vec_id") % 20 == 0, **kw).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_neighbours_edges(spark):
    one = [1.0, 2.0, 2.0]
    rows = [(0, one, 1), (1, one, 1), (2, one, 1), (3, [3.0, 0.0, 0.0], 1), (20, [0.0, -1.0, 0.5], 1), (3, [3.0, 0.0, 0.0], 2),
            (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 0.0], 1), (7, [float("nan"), 1.0, 1.0], 1),
            (8, [float("inf"), 1.0, 1.0], 1), (9, [1.0, 1.0], 1), (None, one, 1), (40, None, 1), (10, [], 1)]
    got = neighbours(spark, rows)
    assert got == {
        0: [(1, 9.0), (2, 9.0), (3, 3.0), (20, -1.0)],
        20: [(3, 0.0), (0, -1.0), (1, -1.0), (2, -1.0)],
    }
    assert neighbours(spark, [], ) == {}
    assert neighbours(spark, [(0, one, 1)]) == {}


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 24)).astype(np.float32) * rng.uniform(0.5, 2, (3000, 1)).astype(np.float32)
    x[1000:1900] = x[0]  # a very common vector
    got = neighbours(spark, [(k, v.tolist(), 0) for k, v in enumerate(x)])
    y, hits, total = x.astype(float), 0, 0
    for q, found in got.items():
        s = y @ y[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(s)), -s))[:20]
        hits += len({v for v, _ in found} & set(best.tolist()))
        total += 20
        assert len(found) == 20
        assert [(-s, v) for v, s in found] == sorted((-s, v) for v, s in found)
        assert all(abs(score - y[v] @ y[q]) < 1e-9 for v, score in found)
    assert len(got) == 150 and hits > 0.9 * total


def test_op1_recall(spark):
    got = QUERIES["op1_ann_ads"](spark, MID).collect()
    t = pq.read_table(f"{MID}/embeddings.parquet").to_pandas()
    x, ids = np.stack(t.embedding.values).astype(float), t.vec_id.values
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found[ids[q]] & set(ids[np.argsort(-s)[:20]].tolist()))
    assert hits > 0.9 * 20 * len(found) and len(got) == 20 * len(found)


def fitted(x, lists, seed=1):
    """An index of all rows ``x`` (ids by place) and each row's list."""
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.standard_normal((x.shape[1] + 1,) * 2))
    sample = rng.choice(len(x), min(len(x), 200), replace=False)
    index = ann_ads.Index((x**2).sum(1).max(), rotation, np.empty((0, 0)), sample, x[sample])
    points = index.rotated(x, False)
    index.centres = ann_ads.list_centres(points, lists, rng)
    return index, ann_ads.nearest(points, index.centres)


@pytest.mark.parametrize("dim,noise", [(3, 1.0), (24, 0.02), (64, 1.0)])
def test_scan_of_a_block_against_brute_force(monkeypatch, dim, noise):
    """With room for every candidate, a tile's tests lose none: sparse and dense, over several tiles, with ties."""
    monkeypatch.setattr(ann_ads, "EPSILON", 50.0)
    monkeypatch.setattr(ann_ads, "TILE", (64, 100))
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((12, dim))[rng.integers(0, 12, 1500)] + noise * rng.standard_normal((1500, dim))
    x *= rng.uniform(0.5, 90, (1500, 1))
    x[300:420] = x[7]
    index, lists = fitted(x, 30)
    places = np.arange(0, 1500, 7)
    asked = rng.random((len(places), len(index.centres))) < 0.7
    asked[0] = True
    for bounds in (np.full(len(places), -np.inf), ann_ads.first_hits(index, places, x[places], 20)[1]):
        i, j, scores = ann_ads.scan_block(
            index, np.arange(1500), x, lists, places, x[places], bounds, np.nonzero(asked), 20
        )
        for q, p in enumerate(places):
            s = ann_ads.inner(x, x[p])
            s[(np.arange(1500) == p) | ~asked[q, lists] | (s < bounds[q])] = -np.inf
            best = np.lexsort((np.arange(1500), -s))[:20]
            best = best[s[best] > -np.inf]
            assert j[i == q].tolist() == best.tolist() and scores[i == q].tolist() == s[best].tolist()


def test_scan_is_not_one_query_at_a_time():
    """A block for many queries takes a fraction of the time of testing each query alone."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((2_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index, lists = fitted(x, 16)
    places = np.arange(0, 2_000, 4)
    bounds = ann_ads.first_hits(index, places, x[places], 20)[1]
    every = np.nonzero(np.ones((len(places), len(index.centres)), bool))
    turned, width = index.rotated(x, False), x.shape[1] + 1

    def alone():
        for one in range(len(index.centres)):
            held = turned[lists == one]
            for q, p in zip(index.rotated(x[places], True), range(len(places))):
                limit, alive, sofar = 1 + index.top - 2 * bounds[p], np.arange(len(held)), np.zeros(len(held))
                for c in range(0, width, 16):
                    sofar += ((held[alive, c : c + 16] - q[c : c + 16]) ** 2).sum(1)
                    seen = min(c + 16, width)
                    fine = sofar * (width / seen) <= limit * (1 + ann_ads.EPSILON / np.sqrt(seen)) ** 2
                    alive, sofar = alive[fine], sofar[fine]

    def seconds(run):
        start = time.perf_counter()
        run()
        return time.perf_counter() - start

    def together():
        ann_ads.scan_block(index, np.arange(2_000), x, lists, places, x[places], bounds, every, 20)

    assert 2 * min(seconds(together) for _ in range(3)) < min(seconds(alone) for _ in range(3))


def test_queries_go_once_to_a_region():
    sizes = np.array([3, 5, 0, 2, 40, 1, 1, 9])
    region = ann_ads.regions(sizes, 10)
    assert region.tolist() == [0, 0, 0, 0, 1, 5, 5, 5]
    asked = np.array([[1] * 8, [0] * 8, [0, 1, 0, 0, 0, 1, 0, 1]], bool)
    assert ann_ads.visited_regions(asked, region).to_pylist() == [
        [{"region": 0, "lists": [0, 1, 2, 3]}, {"region": 1, "lists": [4]}, {"region": 5, "lists": [5, 6, 7]}],
        [],
        [{"region": 0, "lists": [1]}, {"region": 5, "lists": [5, 7]}],
    ]


@pytest.mark.parametrize("n", [1_000, 4_000])
def test_neighbours_over_many_cells(spark, monkeypatch, n):
    """Regions, blocks and chunks of a few rows: recall on vectors without clusters, one common vector."""
    monkeypatch.setattr(ann_ads, "BLOCK", 64)
    monkeypatch.setattr(ann_ads, "CHUNK", 16)
    monkeypatch.setattr(ann_ads, "BOUND_SAMPLE", 100)
    monkeypatch.setattr(ann_ads, "LEAST_BLOCK", 64)
    x = np.random.default_rng(n).standard_normal((n, 16)).astype(np.float32)
    x[n // 2 : n // 2 + 200] = x[0]
    got, y, hits = neighbours(spark, [(k, v.tolist(), 0) for k, v in enumerate(x)]), x.astype(float), 0
    assert len(got) == n // 20 and all(len(found) == 20 for found in got.values())
    for q, found in got.items():
        s = y @ y[q]
        s[q] = -np.inf
        hits += len({v for v, _ in found} & set(np.lexsort((np.arange(n), -s))[:20].tolist()))
    assert hits >= 0.95 * n


# ---------------------------------------------------------------------------
# Quality


def test_kneser_ney_probabilities_by_hand(spark):
    """Against a direct computation on one text; every context's probabilities sum to one."""
    text = b"abracadabra abracadabra alakazam"
    grams = quality_kn.text_grams(np.frombuffer(text, np.uint8))
    counts = {}
    for g in grams.tolist():
        counts[g] = counts.get(g, 0) + 1
    table = spark.createDataFrame(list(counts.items()), "gram long, a long")
    contexts = sorted({g >> 8 for g in counts})[:5]
    asked = spark.createDataFrame([(c << 8 | b,) for c in contexts for b in range(256)], "gram long")
    got = {r.gram: r.p for r in quality_kn.probabilities(asked, table).collect()}
    for c in contexts:
        assert sum(got[c << 8 | b] for b in range(256)) == pytest.approx(1)

    tables = [counts]
    for order in range(quality_kn.ORDER - 1, 0, -1):
        lower = {}
        for g in tables[-1]:
            tail = g & ((1 << 8 * order) - 1)
            lower[tail] = lower.get(tail, 0) + 1
        tables.append(lower)
    tables = tables[::-1]

    def discounts(t):
        n = [sum(a == k for a in t.values()) for k in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) if n[k - 1] else 0 for k in range(1, 4)]

    def p(g, order):
        if order == 0:
            return 1 / 256
        t = tables[order - 1]
        below = p(g & ((1 << 8 * (order - 1)) - 1), order - 1)
        d = discounts(t)
        own = [a for x, a in t.items() if x >> 8 == g >> 8]
        if not own:
            return below
        freed = sum(d[min(a, 3) - 1] for a in own)
        a = t.get(g, 0)
        return (max(a - d[min(a, 3) - 1], 0) if a else 0) / sum(own) + freed * below / sum(own)

    for g in list(got)[::37]:
        assert got[g] == pytest.approx(p(g, quality_kn.ORDER))


def test_quality_edges(spark):
    rng = np.random.default_rng(6)
    docs = [(k, words(rng, 60, 40), "en") for k in range(60)] + [
        (100, None, "en"), (101, "", "xx"), (102, "@@##$$%%^^&&" * 30, "en"), (103, words(rng, 50, 40), None),
        (104, words(rng, 20_000, 40), "en"), (None, words(rng, 50, 40), "en"), (5, words(rng, 50, 40), "en")]
    table = spark.createDataFrame([(i, t, g, "x", 1) for i, t, g in docs], "doc_id long, text string, lang string, block string, gram int")
    labels = spark.createDataFrame(
        [(k, 1, 0) for k in range(50)] + [(5, 0, 0), (102, 0, 0), (None, 1, 0), (7, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = [(r.doc_id, r.perplexity, r.kept) for r in quality_kn.judge_quality(table, labels).collect()]
    assert len(got) == len(docs)
    kept = {i: k for i, _, k in got}
    assert not kept[100] and not kept[101] and not kept[102] and kept[103] and kept[104] and kept[None]
    assert quality_kn.judge_quality(table.limit(0), labels).count() == 0
    nothing = quality_kn.judge_quality(table, labels.limit(0)).collect()
    assert all(r.kept == (r.n_bytes > 0) for r in nothing)


def test_op9_separates_labelled_documents(spark):
    got = QUERIES["op9_quality_kn"](spark, MID).join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id")
    share = {(r.quality, r.toxic): r.kept for r in got.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1, 0] > 0.97 and share[0, 0] < 0.2


def test_worst_stretches_do_not_grow_with_the_text():
    rng = np.random.default_rng(9)
    log_p = -rng.gamma(1.0, 1.5, 400_000)
    short = [quality_kn.worst_stretches(log_p[k : k + 2_000]) for k in range(0, 400_000, 2_000)]
    assert min(short) < quality_kn.worst_stretches(log_p) < max(short)
    assert quality_kn.worst_stretches(log_p[:3]) == pytest.approx(log_p[:3].mean())
    seeded = log_p.copy()
    seeded[1_000:1_006] = -12.0
    assert quality_kn.worst_stretches(seeded[:2_000]) < min(short)


def test_op9_drops_insults_and_keeps_long_clean_text(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = docs.join(labels, "doc_id", "left_semi")
    clean = docs.join(quality_kn.trusted_ids(labels), "doc_id").where(quality_kn.held_out(F.col("doc_id")))
    joined = clean.groupBy("lang").agg(F.concat_ws("\n", F.sort_array(F.collect_list("text"))).alias("text"))
    long = joined.select((-F.crc32("lang") - 1).alias("doc_id"), "text", "lang")
    judged = quality_kn.judge_quality(docs.select("doc_id", "text", "lang").unionByName(long), labels)
    got = judged.join(labels, "doc_id", "left").collect()
    assert sum(r.kept for r in got if r.doc_id < 0) == 4
    toxic = [r for r in got if (r.quality, r.toxic) == (1, 1)]
    english = [r.kept for r in toxic if r.lang == "en"]
    assert len(toxic) == 382 and np.mean([r.kept for r in toxic]) < 0.4 and np.mean(english) < 0.02
    assert np.mean([r.kept for r in got if (r.quality, r.toxic) == (1, 0)]) > 0.98
    print({g: np.mean([r.kept for r in toxic if r.lang == g]) for g in ("en", "de", "fr", "es")})


# ---------------------------------------------------------------------------
# Pipeline


def test_pipeline_against_its_parts(spark):
    import corpus_pipeline as cp
    from quarry.llm.common import read_table
    from quarry.llm.token_orc import END_ID  # noqa: F401

    given = read_table(spark, SF, "documents")
    steps = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontaminate", "mix", "token_orc"]
    known = steps["language"](spark, given, SF)
    assert known.columns == given.columns and known.count() > 0.95 * given.count()
    rows = [(r.doc_id, r.text) for r in known.collect()]
    single = steps["near_duplicates"](spark, known, SF)
    want = {c for _, c in brute.near_duplicates(rows).values()}
    assert {r.doc_id for r in single.collect()} == want and single.columns == given.columns
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    clean = steps["decontaminate"](spark, single, SF)
    left = [(r.doc_id, r.text) for r in single.collect()]
    assert {r.doc_id for r in clean.collect()} == {d for d, _, h, _, _ in brute.decontaminated(left, items) if not h}
    taken = steps["mix"](spark, clean, SF)
    assert taken.columns == given.columns and {r.doc_id for r in taken.collect()} <= {r.doc_id for r in clean.collect()}
    final = cp.run(spark, SF)
    assert final.count() == taken.count()
    assert final.agg(F.sum("n_tokens")).first()[0] == final.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0]
