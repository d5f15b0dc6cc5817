"""Near-duplicate embeddings: all pairs by brute force, edges, estimates and plans."""

from __future__ import annotations

import numpy as np
import pytest

from quarry.llm import embed_rabitq as er

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=er.THRESHOLD):
    """vec_id -> (n_links, component_id), comparing all pairs of equal label and length."""
    out = {}
    fine = []
    for i, v, label in rows:
        out[i] = (0, i)
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine.append((i, np.array(v, np.float32).astype(float), label))
    top = {i: i for i, _, _ in fine}

    def root(c):
        while top[c] != c:
            c = top[c]
        return c

    for i, v, label in fine:
        n = 0
        for j, w, other in fine:
            if i != j and label == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                n += 1
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
        out[i] = (n, i)
    return {i: (out[i][0], root(i) if i in top else i) for i in out}


def got(spark, rows, schema=SCHEMA, **kw):
    found = er.near_duplicates(spark.createDataFrame(rows, schema), **kw).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)
    return {r.vec_id: (r.n_links, r.component_id) for r in found}


def clusters(rng, sizes, dim, noise, labels=2):
    """Groups of vectors about common directions, and a chain of links."""
    rows = []
    for k, size in enumerate(sizes):
        base = rng.standard_normal(dim)
        for _ in range(size):
            v = base / np.linalg.norm(base) + noise[k % len(noise)] * rng.standard_normal(dim) / np.sqrt(dim)
            rows.append((v * rng.uniform(0.1, 9)).astype(np.float32).tolist())
    a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
    rows += [(a * np.cos(t) + b * np.sin(t)).astype(np.float32).tolist() for t in np.arange(0, 3, 0.15)]
    order = rng.permutation(len(rows))
    return [(int(1000 + i), rows[i], int(n % labels)) for n, i in enumerate(order)]


@pytest.mark.parametrize("dim,cell", [(64, 2_048), (64, 16), (5, 32), (300, 16)])
def test_links_and_components_match_brute_force(spark, dim, cell):
    rng = np.random.default_rng(dim)
    rows = clusters(rng, [120, 60, 3, 2, 1, 1, 40], dim, [0.1, 0.13, 0.16, 0.2])
    assert got(spark, rows, cell=cell) == brute(rows)


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    w = [-1.0, 2.0, 0.5]
    rows = [
        (1, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [], 0),
        (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 3.0], 0), (10, [1.0, float("nan"), 3.0], 0),
        (11, [float("inf"), 2.0, 3.0], 0), (12, [1.0, 2.0], 0), (13, [1e30, 2e30, 3e30], 0),
        (14, [1e-30, 2e-30, 3e-30], 0), (15, [0.0, 1.0, 0.0], 0), (16, [-0.0, 1.0, 0.0], 0), (17, w, 0),
        (18, [-x for x in v], 0),
    ]
    found = got(spark, rows)
    want = {k: (0, k) for k in range(1, 19)}
    want |= {k: (4, 1) for k in (1, 2, 3, 13, 14)} | {15: (1, 15), 16: (1, 15)}
    assert found == want
    # Repeated rows and ids are one vector; rows without an id stay.
    rows = [(1, v, 0), (1, v, 0), (2, v, 0), (2, w, 1), (None, v, 0), (None, v, 0)]
    out = er.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in out) == [
        (0, 0, 0, True), (0, 0, 0, True), (1, 1, 1, True), (2, 1, 1, False)
    ]


def test_empty_table_and_other_columns(spark):
    assert er.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert got(spark, [(1, None, 0), (2, [], None)]) == {1: (0, 1), 2: (0, 2)}
    wide = SCHEMA + ", v int, same string, cls long, comp int, n int, band string, n_links string, kept int"
    rows = [(k, [1.0, 0.0], 0, 1, "s", 2, 3, 4, "b", "l", 5) for k in (3, 4)]
    assert got(spark, rows, wide) == {3: (1, 3), 4: (1, 3)}


def test_a_large_group_of_copies_is_one_class(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal(32).astype(np.float32).tolist()
    rows = [(k, v, 0) for k in range(3_000)] + [(9_000 + k, rng.standard_normal(32).tolist(), 0) for k in range(50)]
    found = got(spark, rows)
    assert all(found[k] == (2_999, 0) for k in range(3_000))
    assert all(found[9_000 + k] == (0, 9_000 + k) for k in range(50))


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    errors = []
    for seed in range(40):
        coder = er.Coder(64, 16, 4, 0.98, seed)
        a, b = rng.standard_normal((2, 50, 64))
        b = a + 0.5 * b
        _, codes, factors = coder.codes(a)
        units = coder.directions(b)
        signs = np.unpackbits(codes, axis=1, count=coder.width) * 2.0 - 1
        estimate = (signs * (units @ coder.rotations[0])).sum(1) / (np.sqrt(coder.width) * factors)
        true = (coder.directions(a) * units).sum(1)
        assert (np.abs(estimate - true) <= coder.bound(factors)).all()
        errors.append(estimate - true)
    errors = np.concatenate(errors)
    assert abs(errors.mean()) < 4 * errors.std() / np.sqrt(len(errors))


def test_bands_lose_no_pair_at_the_threshold():
    for n in (10, 10_000, 10**9):
        signs, bands = er.bands_for(n, 0.98)
        agree = (1 - np.arccos(0.98) / np.pi) ** signs
        assert (1 - agree) ** bands <= 1.01e-7
        assert 2.0**signs >= min(2.0**48, 10 * n)


@pytest.mark.parametrize("cell", [64, 256])
def test_cells_hold_each_pair_once(spark, cell):
    """Rows in cells stay near the parts a group has, whatever its buckets hold."""
    n = 600
    grouped = spark.range(n).selectExpr("id AS cls", "0L AS comp")
    cells = er._group_cells(grouped, cell).collect()
    parts = -(-n // cell)
    assert len(cells) == n * parts
    met = {}
    for r in cells:
        met.setdefault(r.cell, []).append((r.cls, r.side))
    pairs = set()
    for members in met.values():
        sides = {s for _, s in members}
        for a, s in members:
            for b, t in members:
                if a < b and (len(sides) == 1 or s != t):
                    assert (a, b) not in pairs
                    pairs.add((a, b))
    assert len(pairs) == n * (n - 1) // 2
