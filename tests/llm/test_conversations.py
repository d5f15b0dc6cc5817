"""Conversation repair: every edit sequence of short conversations, edges, long streams."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest

from quarry.llm import catalog, conv_glr

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def edits(row, must_go, truncated):
    """(letter, cost, spoken) of one row."""
    role, text = row
    more = 5 if truncated else 0
    found = [("D", 2, None)]
    if not must_go:
        found += [("K", more, (role, text))]
        found += [("R", 1 + more, (name, text)) for name in ("user", "assistant")]
    return found


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, most_inserts=2):
    """(cost, audit, lines) by trying every edit of every row and inserts in every gap."""
    found = faults(rows)
    ways = [edits(r, f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, found)]
    best = None
    gaps = range(len(rows) + 1)
    fillings = [
        fill
        for n in range(most_inserts + 1)
        for where in itertools.combinations_with_replacement(gaps, n)
        for fill in [[where.count(g) for g in gaps]]
    ]
    for taken in itertools.product(*ways):
        for fill in fillings:
            for names in itertools.product(("user", "assistant"), repeat=sum(fill)):
                audit, spoken, cost, left = "", [], 5 * len(names), list(names)
                for g in gaps:
                    for _ in range(fill[g]):
                        audit, spoken = audit + "I", spoken + [(left.pop(0), "")]
                    if g < len(rows):
                        letter, own, said = taken[g]
                        audit, cost = audit + letter, cost + own
                        spoken += [said] if said else []
                if LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in spoken)):
                    key = (cost, audit, [f"{r}:{t}" for r, t in spoken])
                    best = key if best is None else min(best, key)
    return best


def repaired(spark, rows, **kw):
    return {r.conv_id: r for r in conv_glr.repair(spark.createDataFrame(rows, SCHEMA), **kw).collect()}


def test_repairs_are_the_cheapest_of_all(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", " "]
    convs = {
        c: [(rng.choice(roles), rng.choice(["a.", "b!", "c", "", "d?", "a.", f"t{k}."])) for k in range(rng.randint(0, 4))]
        for c in range(120)
    }
    rows = [(c, t, *row) for c, conv in convs.items() for t, row in enumerate(conv)]
    rng.shuffle(rows)
    got = repaired(spark, rows)
    for c, conv in convs.items():
        if conv:
            cost, audit, lines = cheapest(conv)
            assert (got[c].cost, got[c].audit) == (cost, audit), (conv, got[c])
            assert got[c].repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
            assert [got[c].blank, got[c].duplicate, got[c].truncated] == [
                sum(f == k for f in faults(conv)) for k in ("blank", "duplicate", "truncated")
            ]
    turns = conv_glr.repaired_turns(
        spark.createDataFrame(rows, SCHEMA), conv_glr.repair(spark.createDataFrame(rows, SCHEMA))
    ).collect()
    for c, conv in convs.items():
        if conv:
            said = [f"{r.role}:{r.text}" for r in sorted((r for r in turns if r.conv_id == c), key=lambda r: r.position)]
            assert said == cheapest(conv)[2]


def test_counts_and_edges(spark):
    rows = [
        (1, 0, "user", "hi."), (1, 1, "assistant", "yes."), (1, 5, "user", "so?"), (1, 6, "user", "so?"),
        (2, None, "user", "hi."), (2, None, "assistant", "ok."),
        (3, 2, None, None), (3, 2, "user", " \t"),
        (None, 0, "assistant", "x."), (None, 1, "user", "y."),
        (4, 0, "system", "be brief."),
        (5, 7, "user", "a."), (5, 7, "user", "a."), (5, 7, "user", "a."),
        (6, 1 << 40, "user", "é!"), (6, 3, "assistant", "ß?"),
    ]
    ids = spark.createDataFrame([(k,) for k in (1, 2, 9, 9, None)], "conv_id long")
    got = repaired(spark, rows, ids=ids)
    short = {k: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for k, r in got.items()}
    assert short[1] == (3, 0, 1, 0, 1, 4, "KKDD")
    assert short[2] == (0, 0, 0, 0, 0, 2, "RR")
    assert short[3] == (0, 2, 0, 0, 1, 4, "DD")
    assert short[None] == (0, 0, 0, 0, 0, 2, "RR")
    assert short[4] == (0, 0, 0, 0, 0, 2, "D")
    assert short[5] == (0, 0, 2, 0, 2, 6, "DDD")
    assert short[6][0] == (1 << 40) - 3 + 1 - 2
    assert short[9] == (0, 0, 0, 0, 0, 0, "") and got[9].repaired_sha256 == EMPTY
    assert got[3].repaired_sha256 == EMPTY


def test_empty_table_and_other_columns(spark):
    assert conv_glr.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    wide = spark.createDataFrame(
        [(1, 0, "user", "a.", "x", 1, "y", 2, True, "z"), (1, 1, "assistant", "b.", "x", 1, "y", 2, True, "z")],
        SCHEMA + ", audit string, cost int, conv string, seen int, there boolean, fault string",
    )
    (row,) = conv_glr.repair(wide, ids=wide).collect()
    assert (row.cost, row.audit) == (0, "KK")
    assert conv_glr.repair(wide).columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]


def test_one_long_conversation_and_very_long_texts(spark):
    n = 20_000
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(n) if t % 1_000 != 7]
    rows += [(2, 0, "user", "w " * 300_000 + "."), (2, 1, "assistant", "v" * 500_000)]
    got = repaired(spark, rows)
    # The row after a dropped one repeats a role: deleting it and the next costs 4,
    # inserting one row 5, so is each later row's role.
    assert got[1].gaps == n // 1_000 and got[1].illegal == n // 1_000
    assert len(got[1].audit) >= n - n // 1_000
    assert (got[2].truncated, got[2].cost, got[2].audit) == (1, 4, "DD")


@pytest.mark.parametrize("key", ["5:1", "0:0", "12:3", " : ", "123456789:99"])
def test_damage_follows_the_checksum(spark, key):
    import zlib

    conv, turn = (None if p == " " else int(p) for p in key.split(":"))
    rows = spark.createDataFrame([(conv, turn, "assistant", "Yes. No! Why? so")], SCHEMA)
    got = [(r.role, r.text) for r in catalog.damaged_turns(rows).collect()]
    harm = zlib.crc32(key.encode()) % 20
    plain = ("assistant", "Yes. No! Why? so")
    want = {0: [], 1: [("assistant", "")], 2: [("assistant", "Yes No Why so")], 3: [plain] * 2, 4: [("user", plain[1])]}
    assert got == want.get(harm, [plain])
