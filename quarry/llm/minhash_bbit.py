"""Near-duplicate documents by b-bit MinHash.

1. Each document becomes its set of distinct word shingles, ``BANDS`` band keys (each over
   ``ROWS`` minima) and a packed signature of the low ``BITS`` bits of its minima. Documents of
   equal sets are one class, held by its smallest doc_id; only classes go on.
2. Classes that share a band key meet in a bucket. Each is paired with the
   bucket's leader first, so a large group of copies needs one pair for each
   member, not all pairs. The similarity of a pair is estimated from the equal
   signature fields, corrected for chance agreement; pairs clearly below the
   threshold go, the others are confirmed on the full shingle sets.
3. Links give components. Buckets that still hold several components get ``ROUNDS`` more
   leaders, which joins what is a group of copies.
4. Members of buckets that stay open are dealt anew, once each, by ``FINE_BANDS`` keys of
   ``FINE_ROWS`` fresh minima: few but close texts share one. Members that share one with
   another component compare longer b-bit signatures inside the task; those that come
   near the threshold get their full sets, and the task confirms such pairs until its
   components are joined or all are refused. So members and links are sent, never
   pairs, and a member has one row for each of its keys, whatever the size of its group.
   Only a key that over ``CELL`` members share is laid on a grid of such cells, so no
   bucket is capped.

At similarity s >= 0.85 a pair shares no band, coarse or fine, with probability
(1 - s^ROWS)^BANDS < 3e-7, and an estimate errs by more than ``SIGMAS`` standard
deviations with about the same; nothing else can lose a link, and no link is
made without full sets.

Defined results: a text without words (or null) has an empty set and is linked
with nothing; rows of equal doc_id are one document; a null doc_id has no
component and is kept; repeated rows give a row each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import row_chunks, stage, tidy, utf8_column
from quarry.llm.components import components
from quarry.llm.shingles import mixed, shingle_sets

SHINGLE = 3
PERCENT = 85
BANDS, ROWS = 26, 5
BITS = 2
SHORT, LONG = 128, 1024
SIGMAS = 5.0
ROUNDS = 2
FINE_BANDS, FINE_ROWS = 69, 10
CELL = 4_096
PAIRS = 1 << 20
CHUNK_BYTES = 1 << 20
SEED = 7


def _permutations(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    flip = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    factor = rng.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return flip, factor


def minima(values: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """The least of each of ``n`` hash orders over each (non-empty) set: sets x n."""
    flip, factor = _permutations(n)
    out = np.empty((len(bounds) - 1, n), np.uint64)
    for k in range(n):
        out[:, k] = np.minimum.reduceat((values ^ flip[k]) * factor[k], bounds[:-1])
    return out


def packed(lows: np.ndarray) -> np.ndarray:
    """Low ``BITS`` bits of mixed minima, packed into 64-bit words: sets x words."""
    fields = mixed(lows) & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    shifts = (np.arange(per) * BITS).astype(np.uint64)
    return np.bitwise_or.reduce(fields.reshape(len(lows), -1, per) << shifts, axis=2)


def least_fields(percent: int, n: int, sigmas: float = SIGMAS) -> int:
    """Equal fields (of ``n``) that a pair at the threshold has but for ``sigmas``
    standard deviations. Two sets of similarity s agree in a field with
    probability c + (1 - c) s, where c = 2^-BITS is chance agreement."""
    chance = 2.0**-BITS
    agree = chance + (1 - chance) * percent / 100
    return int(np.floor(n * agree - sigmas * np.sqrt(n * agree * (1 - agree))))


def _text_md5(text: str) -> Column:
    return F.coalesce(F.md5(text), F.lit(""))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, ``text_md5``, ``n_shingles``, set digest (``d1``, ``d2``), ``bands``, ``sig``."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in row_chunks(batches, "text", CHUNK_BYTES):
            values, bounds = shingle_sets(*utf8_column(chunk.column("text")), SHINGLE)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            digests = np.zeros((2, len(sizes)), np.uint64)
            bands, sig = [[] for _ in sizes], [[] for _ in sizes]
            if len(full):
                inner = np.concatenate((bounds[:-1][full], bounds[-1:]))
                for k, by in enumerate((np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3))):
                    digests[k, full] = np.add.reduceat(mixed(values, by), inner[:-1])
                lows = minima(values, inner, BANDS * ROWS)
                keys = np.zeros((len(full), BANDS), np.uint64)
                for k in range(ROWS):
                    keys = mixed(keys * np.uint64(31) + lows[:, k::ROWS][:, :BANDS])
                words = packed(lows[:, :SHORT])
                for at, k, w in zip(full.tolist(), keys.view(np.int64), words.view(np.int64)):
                    bands[at], sig[at] = k, w
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    chunk.column("text_md5"),
                    pa.array(sizes, pa.int64()),
                    *(pa.array(d.view(np.int64)) for d in digests),
                    pa.array(bands, longs),
                    pa.array(sig, longs),
                ],
                ["doc_id", "text_md5", "n_shingles", "d1", "d2", "bands", "sig"],
            )

    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _text_md5(text_col).alias("text_md5"), F.col(text_col).alias("text")
    )
    return given.mapInArrow(
        run, "doc_id long, text_md5 string, n_shingles long, d1 long, d2 long, bands array<long>, sig array<long>"
    )


def _equal_fields(a: str, b: str, words: int) -> Column:
    """Equal fields of two packed signatures: fields whose bits all agree."""
    ones = sum(1 << (BITS * k) for k in range(64 // BITS))
    ones = ones - (1 << 64) if ones >> 63 else ones
    total = F.lit(0)
    for k in range(words):
        differ = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        for step in range(1, BITS):
            differ = differ.bitwiseOR(F.shiftrightunsigned(F.col(a)[k].bitwiseXOR(F.col(b)[k]), step))
        total = total + F.bit_count(differ.bitwiseAND(F.lit(ones)))
    return F.lit(words * 64 // BITS) - total


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full shingle sets reach the threshold."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in row_chunks(iter([batch]), "text_u", CHUNK_BYTES):
                sets = [shingle_sets(*utf8_column(chunk.column(c)), SHINGLE) for c in ("text_u", "text_v")]
                owner = np.concatenate([np.repeat(np.arange(chunk.num_rows), np.diff(b)) for _, b in sets])
                value = np.concatenate([v for v, _ in sets])
                order = np.lexsort((value, owner))
                value, owner = value[order], owner[order]
                twice = (value[1:] == value[:-1]) & (owner[1:] == owner[:-1])
                both = np.bincount(owner[1:][twice], minlength=chunk.num_rows)
                union = np.bincount(owner, minlength=chunk.num_rows) - both
                linked = (100 * both >= percent * union) & (union > 0)
                yield chunk.select(["u", "v"]).filter(pa.array(linked))

    first = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    second = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    return pairs.select("u", "v").join(first, "u").join(second, "v").mapInArrow(run, "u long, v long")


def _open_buckets(members: DataFrame) -> DataFrame:
    """(band, key) of buckets of several components, with their size."""
    return (
        members.groupBy("band", "key")
        .agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("band", "key", "n")
    )


def _open_cells(members: DataFrame, cell: int) -> DataFrame:
    """Members of buckets of several components, in the cells of the bucket: one, or a
    grid if it has over ``cell`` members, in which chunk i meets chunk j in cell
    (min, max)."""
    sized = _open_buckets(members).select("band", "key", F.ceil(F.col("n") / cell).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    placed = members.join(sized, ["band", "key"]).withColumn("mine", mine)
    meets = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    return placed.select("band", "key", "rep", "component", "mine", meets).select(
        F.xxhash64("band", "key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
        "band", "key", "rep", "component", "mine",
        F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
    )


def long_signatures(texts: DataFrame) -> DataFrame:
    """For documents that need a closer look: signatures of ``LONG`` minima as bytes, and
    ``FINE_BANDS`` keys of those minima that the first bands did not use."""
    first = BANDS * ROWS

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in row_chunks(batches, "text", CHUNK_BYTES):
            values, bounds = shingle_sets(*utf8_column(chunk.column("text")), SHINGLE)
            lows = minima(values, bounds, LONG)
            fresh = lows[:, first : first + FINE_BANDS * FINE_ROWS]
            keys = np.zeros((len(lows), FINE_BANDS), np.uint64)
            for k in range(FINE_ROWS):
                keys = mixed(keys * np.uint64(31) + fresh[:, k::FINE_ROWS])
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    pa.array([w.tobytes() for w in packed(lows)], pa.binary()),
                    pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                ],
                ["rep", "fields", "fine"],
            )

    return texts.select("doc_id", "text").mapInArrow(run, "rep long, fields binary, fine array<long>")


_CELL = "cell long, band int, key long, i int, j int"
_MEMBER = "rep long, component long, mine int, fields binary"
_CELL_NAMES, _MEMBER_NAMES = ("cell", "band", "key", "i", "j"), ("rep", "component", "mine", "fields")


def _in_cells(cells: DataFrame) -> DataFrame:
    return cells.repartition("cell").sortWithinPartitions(*_CELL_NAMES, "rep")


def _by_cell(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Cells of sorted rows, one after the other, with their members' columns ``names``."""
    at, members = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in _CELL_NAMES))
        for key, member in zip(keys, zip(*(batch.column(c).to_pylist() for c in names))):
            if key != at:
                if len(members) > 1:
                    yield at, members
                at, members = key, []
            members.append(member)
    if len(members) > 1:
        yield at, members


def _near_pairs(members: list[tuple], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members of different components whose signatures agree in ``least``
    fields: of all members of a cell on the grid's diagonal, else across its sides."""
    ones = np.uint64(sum(1 << (BITS * k) for k in range(64 // BITS)))
    comps, sides = (np.array([m[k] for m in members]) for k in (1, 2))
    words = np.frombuffer(b"".join(m[3] for m in members), np.uint64).reshape(len(members), -1)
    left = np.flatnonzero(sides == sides.min())
    right = left if (sides == sides[0]).all() else np.flatnonzero(sides != sides.min())
    found_a, found_b = [], []
    step = max(1, PAIRS // max(1, len(right)))
    for at in range(0, len(left), step):
        some = left[at : at + step]
        equal = np.full((len(some), len(right)), LONG, np.int32)
        for k in range(words.shape[1]):
            x = words[some, k][:, None] ^ words[right, k][None, :]
            y = x.copy()
            for shift in range(1, BITS):
                y |= x >> np.uint64(shift)
            equal -= np.bitwise_count(y & ones)
        a, b = np.nonzero((equal >= least) & (comps[some][:, None] != comps[right][None, :]))
        found_a.append(some[a])
        found_b.append(right[b])
    return np.concatenate(found_a), np.concatenate(found_b)


def _near_members(cells: DataFrame, percent: int) -> DataFrame:
    """Members that have a near pair in their cell."""
    least = least_fields(percent, LONG)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, members in _by_cell(batches, _MEMBER_NAMES):
            a, b = _near_pairs(members, least)
            kept = [members[k] for k in np.union1d(a, b).tolist()]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(_CELL_NAMES, key)) | dict(zip(_MEMBER_NAMES, m)) for m in kept], schema=schema
            )

    longs, ints = pa.int64(), pa.int32()
    schema = pa.schema(
        list(zip(_CELL_NAMES + _MEMBER_NAMES, (longs, ints, longs, ints, ints, longs, longs, ints, pa.binary())))
    )
    return _in_cells(cells).mapInArrow(run, f"{_CELL}, {_MEMBER}")


def full_sets(texts: DataFrame) -> DataFrame:
    """Sorted shingle hashes of each document, as bytes."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in row_chunks(batches, "text", CHUNK_BYTES):
            values, bounds = shingle_sets(*utf8_column(chunk.column("text")), SHINGLE)
            sets = [values[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(sets, pa.binary())], ["rep", "shingles"])

    return texts.select("doc_id", "text").mapInArrow(run, "rep long, shingles binary")


def _cell_links(cells: DataFrame, percent: int) -> DataFrame:
    """Links between components, confirmed on the full sets inside each cell.

    A cell gives at most one link fewer than it has members: pairs whose
    components a link of the cell has joined already need no other.
    """
    least = least_fields(percent, LONG)

    def links(members: list[tuple]) -> list[tuple[int, int]]:
        sets = [np.frombuffer(m[4], np.uint64) for m in members]
        joined = {m[1]: m[1] for m in members}

        def root(c: int) -> int:
            while joined[c] != c:
                joined[c] = c = joined[joined[c]]
            return c

        found = []
        for a, b in zip(*(x.tolist() for x in _near_pairs(members, least))):
            c, d = root(members[a][1]), root(members[b][1])
            if c == d:
                continue
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                joined[c] = d
                found.append((members[a][0], members[b][0]))
        return found

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in _by_cell(batches, (*_MEMBER_NAMES, "shingles")):
            found = links(members)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in range(2)], ["u", "v"]
            )

    return _in_cells(cells).mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL
) -> DataFrame:
    """Per row: doc_id, ``n_shingles``, ``component_id``, ``kept``, and the digests of
    its text (``text_md5``) and set (``d1``, ``d2``)."""
    rows = stage(signatures(docs, id_col, text_col), "minhash-signatures")
    classes = stage(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig")),
        "minhash-classes",
    )
    banded = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.min_by("rep", F.xxhash64("rep", "band")).alias("leader")
    )
    members = stage(
        banded.join(buckets.where("n > 1"), ["band", "key"]).select("band", "key", "rep", "leader"),
        "minhash-buckets",
    )
    sigs = classes.select("rep", "sig")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = stage(
        given.join(wanted, "doc_id", "left_semi")
        .groupBy("doc_id", F.md5("text").alias("digest"))
        .agg(F.first("text").alias("text"))
        .where("text IS NOT NULL"),
        "minhash-texts",
    )

    def linked(pairs: DataFrame) -> DataFrame:
        """Of pairs (rep, leader) those that are linked, as (u, v)."""
        likely = (
            pairs.select(F.least("rep", "leader").alias("u"), F.greatest("rep", "leader").alias("v"))
            .distinct()
            .join(sigs.select(F.col("rep").alias("u"), F.col("sig").alias("sig_u")), "u")
            .join(sigs.select(F.col("rep").alias("v"), F.col("sig").alias("sig_v")), "v")
            .where(_equal_fields("sig_u", "sig_v", SHORT * BITS // 64) >= least_fields(percent, SHORT))
        )
        # Rows of one doc_id are one document, whatever their texts.
        return stage(confirm(likely, texts, percent), "minhash-links")

    def labelled(found: DataFrame) -> DataFrame:
        return stage(
            members.join(found, members.rep == found.node, "left").select(
                "band", "key", "rep", F.coalesce("component", "rep").alias("component")
            ),
            "minhash-labelled",
        )

    links = linked(members.where("rep != leader"))
    found = components(links)
    in_bands = labelled(found)
    for k in range(1, ROUNDS + 1):
        leaders = (
            in_bands.join(_open_buckets(in_bands).drop("n"), ["band", "key"])
            .groupBy("band", "key")
            .agg(F.min_by(F.struct("rep", "component"), F.xxhash64(F.lit(k), "rep", "band")).alias("top"))
            .select("band", "key", F.col("top.rep").alias("leader"), F.col("top.component").alias("of"))
        )
        more = linked(in_bands.join(stage(leaders, "minhash-leaders"), ["band", "key"]).where("component != of"))
        if more.isEmpty():
            break
        links = stage(links.unionByName(more), "minhash-links")
        found = components(links)
        in_bands = labelled(found)

    still_open = in_bands.join(_open_buckets(in_bands).drop("n"), ["band", "key"])
    still_open = stage(still_open.select("rep", "component").distinct(), "minhash-open")
    open_texts = texts.join(still_open.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    long = stage(long_signatures(open_texts), "minhash-long")
    fine = still_open.join(long.select("rep", "fine"), "rep").select(
        "rep", "component", F.posexplode("fine").alias("band", "key")
    )
    cells = stage(_open_cells(fine, cell), "minhash-cells")
    near = stage(_near_members(cells.join(long.select("rep", "fields"), "rep"), percent), "minhash-near")
    near_texts = texts.join(near.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    more = stage(_cell_links(near.join(full_sets(near_texts), "rep"), percent), "minhash-links")
    found = components(links.unionByName(more))

    class_of = classes.select("d1", "d2", "rep")
    final = class_of.join(found, class_of.rep == found.node, "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component")
    )
    # Written here: a class of many equal texts is split by the join, before any grouping.
    return stage(
        rows.select("doc_id", "text_md5", "n_shingles", "d1", "d2")
        .join(stage(final, "minhash-final"), ["d1", "d2"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
            "text_md5", "d1", "d2",
        )
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept", "text_md5", "d1", "d2"),
        "minhash-judged",
    )


def keep_one(docs: DataFrame, judged: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each doc_id and shingle set that is kept, always the same
    one; rows without an id stay."""
    chosen = (
        judged.where("kept AND doc_id IS NOT NULL")
        .groupBy("doc_id", "d1", "d2")
        .agg(F.min("text_md5").alias("_md5"))
        .select(F.col("doc_id").alias("_id"), "_md5")
        .distinct()
    )
    # Rows of one text differ in their other columns, which may not be comparable (maps).
    others = F.to_json(F.struct(F.lit(0).alias("_"), *(c for c in docs.columns if c != text_col)))
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), _text_md5(text_col).alias("_md5"), F.struct(*docs.columns).alias("row"),
        others.alias("_order"),
    )
    kept = rows.join(chosen, ["_id", "_md5"], "left_semi").groupBy("_id", "_md5").agg(F.min_by("row", "_order").alias("row"))
    return kept.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
