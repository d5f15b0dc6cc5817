"""Periodic runs: all runs by trying every period, edges, planted documents."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from quarry.llm import runs_ipm
from quarry.llm.catalog import QUERIES
from tests.llm.brute import SPACE_WORD

SF = "/root/testdata/sf0.001"


def brute_runs(words, least=24, times=3):
    """(start, length, period) of every run, by comparing the words at every distance."""
    _, codes = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True) if words else (0, np.empty(0))
    found = {}
    for q in range(1, len(words) // times + 1):
        equal = np.concatenate(([False], codes[q:] == codes[:-q], [False]))
        starts = np.flatnonzero(equal[1:] & ~equal[:-1])
        ends = np.flatnonzero(equal[:-1] & ~equal[1:])
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a + q >= max(least, times * q):
                found.setdefault((a, b - a + q), q)  # smallest period first
    return sorted((a, length, q) for (a, length), q in found.items())


def collapsed(words, runs):
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def got(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in runs_ipm.find_runs(df).collect()}


def check(spark, texts):
    found = got(spark, texts)
    for k, text in enumerate(texts):
        words = SPACE_WORD.findall(text or "")
        want = brute_runs(words)
        assert [tuple(r) for r in found[k].runs] == want, text[:200]
        assert found[k].collapsed == collapsed(words, want)
        assert found[k].n_words == len(words)


def test_random_periodic_texts(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(300):
        alphabet = [f"w{k}" for k in range(rng.choice([1, 2, 2, 3, 30]))]
        words = []
        for _ in range(rng.randint(1, 4)):
            phrase = [rng.choice(alphabet) for _ in range(rng.randint(1, 40))]
            words += phrase * rng.randint(1, 9) + phrase[: rng.randint(0, len(phrase))]
            words += [rng.choice(alphabet) for _ in range(rng.randint(0, 5))]
        texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    check(spark, texts)


def test_every_period_at_the_least_length(spark):
    """Each period at its shortest run and one word less, behind heads of every offset."""
    texts = []
    for q in [*range(1, 36), 63, 64, 65]:
        for short in (0, 1):
            for head in (0, 1, q // 2, q - 1, 7):
                phrase = [f"p{k}" for k in range(q)]
                n = max(24, 3 * q) - short
                texts.append(" ".join([f"h{k}" for k in range(head)] + (phrase * (n // q + 1))[:n] + ["end"]))
    check(spark, texts)


def test_words_that_make_many_nested_runs(spark):
    fib = ["a", "ab"]
    while len(fib[-1]) < 3_000:
        fib.append(fib[-1] + fib[-2])
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(4_096))
    texts = [" ".join(fib[-1]), " ".join(thue), " ".join(thue * 3), " ".join("a" * 5_000), " ".join("ab" * 2_500)]
    texts.append(" ".join(("a" * 30 + "b") * 40))
    check(spark, texts)


def test_edges(spark):
    texts = [None, "", " \t\n", "one", "a " * 23, "a " * 24, " a\x0b" * 24 + "\u00a0", "x\u00a0y " * 30, "é ü " * 12]
    found = got(spark, texts)
    assert [tuple(map(tuple, found[k].runs)) for k in range(9)] == [
        (), (), (), (), (), ((0, 24, 1),), ((0, 24, 1),), ((0, 30, 1),), ((0, 24, 2),)
    ]
    assert [found[k].collapsed for k in (0, 1, 2, 3, 5, 8)] == ["", "", "", "one", "a", "é ü"]
    assert found[6].collapsed == "a \u00a0"


def test_empty_table_other_columns_and_repeated_rows(spark):
    schema = "doc_id long, text string, runs int, n_words string, collapsed int, row string"
    assert runs_ipm.find_runs(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a " * 30, 1, "x", 2, "r"), (1, "a " * 30, 1, "x", 2, "r"), (None, "b " * 30, 1, "x", 2, "r")]
    out = runs_ipm.find_runs(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, len(r.runs), r.collapsed) for r in out) == [(0, 1, "b"), (1, 1, "a"), (1, 1, "a")]


def test_a_very_long_text(spark):
    rng = np.random.default_rng(1)
    noise = [f"w{k}" for k in rng.integers(0, 300, 200_000)]
    phrase = [f"w{k}" for k in rng.integers(0, 300, 5_001)]
    (row,) = got(spark, [" ".join(noise + phrase * 7 + noise[:100])]).values()
    assert [(r.length // r.period, r.period) for r in row.runs if r.period > 100] == [(7, 5_001)]
    assert row.n_words == 200_000 + 7 * 5_001 + 100


@pytest.mark.parametrize("period", [1, 2, 3, 8, 9])
def test_codes_that_are_equal_by_chance(spark, period):
    """Runs that only the codes have are found out, and the words numbered anew."""
    real, calls = runs_ipm.span_hashes, []

    def poor(data, begins, ends):
        calls.append(1)
        return real(data, begins, ends) % np.uint64(2)

    words = [f"{k % period}" for k in range(40)] + [f"z{k}" for k in range(60)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    spans = runs_ipm.word_spans(data, np.array([0, len(data)]))
    runs_ipm.span_hashes = poor
    try:
        found = runs_ipm.runs_of(data, *spans, 1)
    finally:
        runs_ipm.span_hashes = real
    assert calls and [tuple(r[1:]) for r in found.tolist()] == brute_runs(words)


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    rows = {r.doc_id: r for r in QUERIES["op12_runs_ipm"](spark, SF).collect()}
    assert len(rows) == len(docs)
    with_runs = 0
    for doc_id, text in docs:
        words = planted(doc_id, SPACE_WORD.findall(text or ""))
        runs = brute_runs(words)
        top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        r = rows[doc_id]
        with_runs += bool(runs)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (top or (None,) * 3)
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        listed = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert with_runs > 5
