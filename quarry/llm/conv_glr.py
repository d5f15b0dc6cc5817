"""Conversation structure repair by generalised LR parsing.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``, that is

    S -> (nothing) | T | s T        T -> u a | T u a

The parser keeps a graph-structured stack: nodes are shared, and a row of the
conversation may be kept (0), given another role (``Rerole``, 1) or deleted (2), and
empty rows may be put in anywhere (``Insert``, 5). Blank rows and repeats must be
deleted; a truncated row that stays costs 5 more. Every action shifts or not, stacks
reduce, and stacks of equal top merge into the one of least (cost, audit), where the
audit is the string of the actions' initials. That loses nothing: in this grammar the
top state alone tells what may follow. Equal audits have equal costs, and at the end
of a row no audit is a proper part of another (it ends in that row's letter), so the
lesser one stays the lesser whatever follows.

Rows are dealt to conversations in one shuffle, sorted by turn inside the partitions
and streamed: the parser holds one entry for each live stack top (8 at most), each with
the running sha256 of its repaired text, so a conversation of any length needs memory
for its audit alone. A conversation's digest is one stream by definition, so one task
reads one conversation.

Defined results: nulls in role and text count as one space; rows come by turn (nulls
first), rows of one turn by role and text; a null conversation id is a conversation
like any other; repeated rows are repeats; a conversation named in ``ids`` without
rows has zeros, an empty audit and the digest of nothing; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.llm.common import small_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
SPOKEN = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}

# The LR automaton of the grammar above. States: 0 start, 1 after s, 2 after T,
# 3 after s T, 4 after the first u, 5 after T u, 6 and 7 after the a behind them.
SHIFT = {0: {"s": 1, "u": 4}, 1: {"u": 4}, 2: {"u": 5}, 3: {"u": 5}, 4: {"a": 6}, 5: {"a": 7}}
REDUCE = {6: 2, 7: 3}  # symbols of the right side; the left side is T
GOTO_T = {0: 2, 1: 3}
ACCEPT = {0, 2, 3}


class Node:
    """A stack: its top state and the shared stack below. Shifts are remembered, so
    equal stacks are one node."""

    __slots__ = ("state", "below", "after")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below, self.after = state, below, {}

    def shift(self, token: str) -> Node | None:
        """The stack after ``token`` and all reductions that follow, if it may come."""
        if token not in self.after:
            to = SHIFT.get(self.state, {}).get(token)
            self.after[token] = None if to is None else Node(to, self).reduced()
        return self.after[token]

    def reduced(self) -> Node:
        if self.state not in REDUCE:
            return self
        under = self
        for _ in range(REDUCE[self.state]):
            under = under.below
        if "T" not in under.after:
            under.after["T"] = Node(GOTO_T[under.state], under)
        return under.after["T"]


class Audit:
    """Letters, the newest last, in pieces: long audits share what they have in common."""

    __slots__ = ("before", "letters")
    PIECE = 256

    def __init__(self, before: Audit | None = None, letters: str = ""):
        self.before, self.letters = before, letters

    def plus(self, more: str) -> Audit:
        if len(self.letters) >= self.PIECE:
            return Audit(self, more)
        return Audit(self.before, self.letters + more)

    def __str__(self) -> str:
        pieces, at = [], self
        while at is not None:
            pieces.append(at.letters)
            at = at.before
        return "".join(reversed(pieces))


class Entry:
    """A live stack with its cost, audit, the audit's place among the live ones and
    the digest of the repaired text so far."""

    __slots__ = ("node", "cost", "place", "audit", "digest", "lines")

    def __init__(self, node, cost, place, audit, digest, lines):
        self.node, self.cost, self.place, self.audit, self.digest, self.lines = node, cost, place, audit, digest, lines


class Parser:
    def __init__(self):
        self.live = [Entry(Node(0, None), 0, 0, Audit(), hashlib.sha256(), 0)]

    def _with_inserts(self) -> dict[int, tuple]:
        """Per top state the least (cost, place, letters, base entry, stack, inserted
        tokens) that any number of inserts makes of the live stacks."""
        best: dict[int, tuple] = {}
        queue = [(e.cost, e.place, "", e, e.node, "") for e in self.live]
        while queue:
            one = queue.pop()
            state = one[4].state
            if state in best and best[state][:3] <= one[:3]:
                continue
            best[state] = one
            cost, place, letters, base, node, tokens = one
            for token in SPOKEN:
                there = node.shift(token)
                if there is not None:
                    queue.append((cost + INSERT, place, letters + "I", base, there, tokens + token))
        return best

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        found: dict[int, tuple] = {}

        def offer(one, node, cost, letter, spoken):
            """Candidates compare by cost, then audit: place of the base, then new letters."""
            key = (one[0] + cost, one[1], one[2] + letter)
            if node is not None and (node.state not in found or key < found[node.state][0]):
                found[node.state] = (key, one, node, spoken)

        more = TRUNCATED if truncated else 0
        for one in self._with_inserts().values():
            node = one[4]
            offer(one, node, DELETE, "D", None)
            if not must_go:
                offer(one, node.shift(role[:1]), KEEP + more, "K", role)
                for token, name in SPOKEN.items():
                    offer(one, node.shift(token), REROLE + more, "R", name)
        self.live = [
            self._entry(place, cost, letters, one, node, None if spoken is None else f"{spoken}:{text}")
            for place, ((cost, _, letters), one, node, spoken) in enumerate(
                sorted(found.values(), key=lambda f: f[0][1:])
            )
        ]

    @staticmethod
    def _entry(place: int, cost: int, letters: str, one: tuple, node: Node, line: str | None) -> Entry:
        base, tokens = one[3], one[5]
        lines = [f"{SPOKEN[t]}:" for t in tokens] + ([line] if line is not None else [])
        digest, n = base.digest, base.lines
        if lines:
            digest = digest.copy()
            for one_line in lines:
                digest.update((("\n" if n else "") + one_line).encode("utf-8", "surrogatepass"))
                n += 1
        return Entry(node, cost, place, base.audit.plus(letters), digest, n)

    def end(self) -> Entry:
        cost, _, letters, *_ = one = min(
            (o for s, o in self._with_inserts().items() if s in ACCEPT), key=lambda o: o[:3]
        )
        return self._entry(0, cost, letters, one, one[4], None)


class Tally:
    """What is counted while a conversation's rows pass by in order."""

    def __init__(self):
        self.parser = Parser()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.turns = 0
        self.before: str | None = None

    def row(self, turn, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL_PAIRS
        self.before = role[:1]
        self.parser.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        end = self.parser.end()
        return (
            gaps, self.blank, self.duplicate, self.truncated, self.illegal, end.cost,
            str(end.audit), end.digest.hexdigest(),
        )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _fault() -> Column:
    """A row's first fault: blank, a role and text seen earlier, or an open end."""
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    return (
        F.when(end == "", "blank").when(F.col("seen") > 1, "duplicate").when(~end.isin(*".!?"), "truncated")
    )


def judged_rows(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    ids: DataFrame | None = None,
) -> DataFrame:
    """Rows dealt to conversations and sorted by turn, each with its first ``fault``.
    Rows of ``ids`` come along with ``there`` unset."""
    given = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        *(F.coalesce(F.col(c), F.lit(" ")).alias(a) for c, a in ((role_col, "role"), (text_col, "text"))),
        F.lit(True).alias("there"),
    )
    if ids is not None:
        empty = F.lit(None)
        given = given.unionByName(
            ids.select(
                F.col(conv_col).alias("conv"), empty.cast("long").alias("turn"),
                *(empty.cast("string").alias(c) for c in ("role", "text")), F.lit(False).alias("there"),
            ).distinct()
        )
    # Dealt once: the window and the order by turn both work inside these partitions.
    same = F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))
    dealt = given.withColumn("same", same).repartition("conv")
    seen = F.row_number().over(Window.partitionBy("conv", "same").orderBy(F.col("turn").asc_nulls_first()))
    return (
        dealt.withColumn("seen", seen)
        .select("conv", "turn", "role", "text", "there", F.when(F.col("there"), _fault()).alias("fault"), "seen")
        .sortWithinPartitions("conv", "there", F.col("turn").asc_nulls_first(), "role", "text", "seen")
        .drop("seen")
    )


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    ids: DataFrame | None = None,
) -> DataFrame:
    """One row per conversation: its id, the counts of its faults, the ``cost`` and
    ``audit`` of the cheapest repair, and ``repaired_sha256`` of the repaired
    ``role:text`` lines. ``ids`` names conversations that may have no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tally, done = None, None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            names = ("conv", "turn", "role", "text", "there", "fault")
            for conv, turn, role, text, there, fault in zip(*(batch.column(c).to_pylist() for c in names)):
                if tally is None or conv != at:
                    if tally is not None:
                        done.append((at, *tally.result()))
                    at, tally = conv, Tally()
                if there:
                    tally.row(turn, role, text, fault)
            if len(done) >= 1_000:
                yield flush()
                done = []
        if tally is not None:
            done.append((at, *tally.result()))
        yield flush()

    kind = rows.schema[conv_col].dataType
    out = StructType(
        [StructField("conv", kind), *(StructField(c, LongType()) for c in COUNTS)]
        + [StructField(c, StringType()) for c in ("audit", "repaired_sha256")]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)
    with small_batches(rows.sparkSession):
        return judged_rows(rows, conv_col, turn_col, role_col, text_col, ids).mapInArrow(run, out).withColumnRenamed(
            "conv", conv_col
        )


def repaired_turns(
    rows: DataFrame, repaired: DataFrame,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The repaired conversations: (conversation, ``position``, ``role``, ``text``,
    ``edit``), made by following each audit along the conversation's sorted rows."""
    audits = repaired.select(F.col(conv_col).alias("conv"), "audit")
    kind = rows.schema[conv_col].dataType
    given = judged_rows(rows, conv_col, turn_col, role_col, text_col)
    both = given.select("conv", F.lit(1).alias("part"), "turn", "role", "text", F.lit(None).cast("string").alias("audit"))
    both = both.unionByName(
        audits.select("conv", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"),
                      *(F.lit(None).cast("string").alias(c) for c in ("role", "text")), "audit")
    )
    both = both.repartition("conv").sortWithinPartitions("conv", "part", F.col("turn").asc_nulls_first(), "role", "text")
    out = StructType(
        [StructField("conv", kind), StructField("position", LongType())]
        + [StructField(c, StringType()) for c in ("role", "text", "edit")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        conv = audit = spoken = None
        at = n = 0

        def inserts() -> Iterator[tuple]:
            nonlocal at, n, spoken
            while at < len(audit) and audit[at] == "I":
                spoken = "assistant" if spoken == "user" else "user"
                yield conv, n, spoken, "", "I"
                at, n = at + 1, n + 1

        for batch in batches:
            found: list[tuple] = []
            names = ("conv", "part", "role", "text", "audit")
            for own, part, role, text, letters in zip(*(batch.column(c).to_pylist() for c in names)):
                if part == 0:
                    conv, audit, at, n, spoken = own, letters, 0, 0, None
                else:
                    letter = audit[at]
                    at += 1
                    if letter != "D":
                        turn = "assistant" if spoken == "user" else "user"
                        if letter == "R":
                            role = turn
                        spoken = None if role[:1] == "s" else turn
                        found.append((conv, n, role, text, letter))
                        n += 1
                found.extend(inserts())
            columns = list(zip(*found)) if found else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return both.mapInArrow(run, out).withColumnRenamed("conv", conv_col)
