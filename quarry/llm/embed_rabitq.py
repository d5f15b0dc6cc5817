"""Near-duplicate embeddings by randomised-rotation binary codes (Gao and Long,
"RaBitQ: Quantizing High-Dimensional Vectors with a Theoretical Error Bound", 2024).

Two vectors of one label are linked when their cosine reaches the threshold.

1. Equal vectors of a label are one class, held by its smallest id; only classes go on.
2. A class gets a binary code: the signs of its direction after random rotations (padded
   to ``WIDTH`` columns each), and, with the first rotation's ``WIDTH`` signs, the
   correction factor <code, direction>. For another direction q, <code, q> divided by the
   factor is an unbiased estimate of the cosine, wrong by more than
   ``SIGMAS`` sqrt(1 - factor^2) / (factor sqrt(WIDTH - 1)) with a chance below 1e-8. A
   pair whose upper bound stays below the threshold goes; every other pair is computed
   anew from the vectors, in double precision, and that decides.
3. Candidates come from bands of code signs. Two directions at the threshold differ in a
   sign with probability angle / pi, so the number of bands follows from the signs in a
   band and the chance ``MISS`` of a pair without a common band; the signs in a band
   grow with the logarithm of the largest label, so that unlike vectors seldom meet.
   Each member of a bucket meets its leader first; these links give groups.
4. Links are counted inside tasks, never sent as pairs: the members of a group in cells of
   at most ``CELL`` by ``CELL``, each pair in one cell; members of different groups in the
   buckets that hold several, a pair in its first common band only, and a bucket's largest
   group never against itself. A cell sends one count for each member, and links that
   join groups.

Counting all links of a group of m unlike vectors compares its m^2 / 2 pairs once, in
m / ``CELL`` copies of each vector; nothing else grows faster than the table.

Defined results: vectors that are null, empty, zero or hold null or non-finite components,
rows without a label and rows without an id link with nothing and are kept (a null id has
no component); vectors of different lengths are not compared; rows of one id are one vector
and one row, the least (label, vector) of those that can link; rows without an id stay
one each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stage
from quarry.llm.components import components

THRESHOLD = 0.98
WIDTH = 256
SIGMAS = 6.0
MISS = 1e-7
SPARE_SIGNS = 6
CELL = 2_048
PAIRS = 1 << 20
SEED = 11


@dataclass(frozen=True)
class Coder:
    """Rotations for vectors of one length, and how their signs are cut into bands."""

    dim: int
    signs: int
    bands: int
    threshold: float
    seed: int = SEED

    @cached_property
    def rotations(self) -> list[np.ndarray]:
        """Rows of random rotations of the padded space: dim x width each."""
        rng = np.random.default_rng((self.seed, self.dim))
        width = max(WIDTH, self.dim)
        n = -(-self.signs * self.bands // width)
        return [np.linalg.qr(rng.standard_normal((width, self.dim)))[0].T for _ in range(n)]

    @property
    def width(self) -> int:
        return max(WIDTH, self.dim)

    def directions(self, vectors: np.ndarray) -> np.ndarray:
        # Scaled first, so that the squares of very large or small numbers stay finite.
        vectors = vectors / np.abs(vectors).max(1, keepdims=True)
        return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Band keys, packed signs of the first rotation and correction factors."""
        units = self.directions(vectors)
        turned = [units @ r for r in self.rotations]
        bits = np.concatenate([t > 0 for t in turned], axis=1)
        cut = bits[:, : self.signs * self.bands].reshape(len(bits), self.bands, self.signs)
        keys = cut.astype(np.int64) @ (np.int64(1) << np.arange(self.signs, dtype=np.int64))
        factors = np.abs(turned[0]).sum(1) / np.sqrt(self.width)
        return keys, np.packbits(bits[:, : self.width], axis=1), factors

    def near(self, codes: np.ndarray, factors: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Codes x directions: may the cosine reach the threshold? Estimates by the
        codes of the left side, with their confidence bounds."""
        signs = np.unpackbits(codes, axis=1, count=self.width).astype(np.float32) * 2 - 1
        turned = (units @ self.rotations[0]).astype(np.float32)
        estimate = signs @ turned.T / (np.sqrt(self.width) * factors.astype(np.float32))[:, None]
        return estimate + self.bound(factors)[:, None] >= self.threshold

    def bound(self, factors: np.ndarray) -> np.ndarray:
        return SIGMAS * np.sqrt(np.maximum(0.0, 1 - factors**2)) / (factors * np.sqrt(self.width - 1)) + 1e-5


def bands_for(n: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Signs in a band and bands, for ``n`` classes of one label."""
    signs = int(min(48, max(10, np.ceil(np.log2(max(2, n))) + SPARE_SIGNS)))
    agree = (1 - np.arccos(threshold) / np.pi) ** signs
    return signs, int(np.ceil(np.log(miss) / np.log1p(-agree)))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows, pair by pair, in double precision."""
    top_a, top_b = np.abs(a).max(1, keepdims=True), np.abs(b).max(1, keepdims=True)
    a, b = a / top_a, b / top_b
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


def _usable(v):
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~odd & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long little-endian doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0))
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _coded(classes: DataFrame, shapes: dict[int, tuple[int, int]], threshold: float) -> DataFrame:
    """Each class with its code: (grp, cls, vec, code, factor, bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = {d: Coder(d, *shape, threshold) for d, shape in shapes.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False).astype("<f8")
                vectors = flat.reshape(part.num_rows, dim)
                keys, codes, factors = coders[int(dim)].codes(vectors)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label"), part.column("dim"), part.column("cls"), part.column("n"),
                        pa.array([v.tobytes() for v in vectors], pa.binary()),
                        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factors),
                        pa.array(list(keys), pa.list_(pa.int64())),
                    ],
                    ["label", "dim", "cls", "n", "vec", "code", "factor", "bands"],
                )

    kind = classes.schema["label"].dataType.simpleString()
    return classes.mapInArrow(
        run,
        f"label {kind}, dim int, cls long, n long, vec binary, code binary, factor double, bands array<long>",
    )


def _confirmed(pairs: DataFrame, coded: DataFrame, shapes: dict, threshold: float) -> DataFrame:
    """Pairs (u, v) of classes whose cosine reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = {d: Coder(d, *shape, threshold) for d, shape in shapes.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part, coder = batch.filter(pa.array(dims == dim)), coders[int(dim)]
                a, b = _matrix(part.column("vec_u")), _matrix(part.column("vec_v"))
                signs = np.unpackbits(_bytes(part.column("code_u")), axis=1, count=coder.width).astype(np.float64) * 2 - 1
                factors = part.column("factor_u").to_numpy()
                turned = coder.directions(b) @ coder.rotations[0]
                estimate = (signs * turned).sum(1) / (np.sqrt(coder.width) * factors)
                close = np.flatnonzero(estimate + coder.bound(factors) >= threshold)
                close = close[cosines(a[close], b[close]) >= threshold]
                yield part.select(["u", "v"]).take(pa.array(close))

    side = lambda s: coded.select(
        F.col("cls").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("vec", "code", "factor")), *(["dim"] if s == "u" else [])
    )
    return pairs.join(side("u"), "u").join(side("v").drop("dim"), "v").mapInArrow(run, "u long, v long")


_CELL_COLUMNS = ["cell", "side", "cls", "comp", "n", "band", "dim", "vec", "code", "factor", "bands"]


def _count_in_cells(members: DataFrame, shapes: dict, threshold: float, within: bool) -> DataFrame:
    """Rows (cls, links, other): the vectors linked with a class inside a cell, and
    (``links`` 0) classes of other groups that it is linked with, as many as join groups.

    ``members`` has a row for each cell a class is in, with its ``side`` of it: rows of
    one side are compared with the other side's, or with each other in a cell of one
    side. ``within`` groups all pairs count; else those of different groups whose first
    common band is the cell's.
    """

    def linked(rows: pa.Table, coders: dict[int, Coder]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of linked pairs, a block of rows of the left side at a time."""
        coder = coders[rows["dim"][0].as_py()]
        vectors, codes = _matrix(rows["vec"]), _bytes(rows["code"].combine_chunks())
        factors, sides = rows["factor"].to_numpy(), rows["side"].to_numpy()
        comps, band = rows["comp"].to_numpy(), rows["band"][0].as_py()
        keys = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(vectors), -1)
        units = coder.directions(vectors)
        one_side = (sides == sides[0]).all()
        left = np.flatnonzero(sides == sides.min())
        right = left if one_side else np.flatnonzero(sides != sides.min())
        step = max(1, PAIRS // len(right))
        for at in range(0, len(left), step):
            a = left[at : at + step]
            near = coder.near(codes[a], factors[a], units[right])
            if one_side:
                near &= a[:, None] < right[None, :]
            if not within:
                near &= comps[a][:, None] != comps[right][None, :]
            x, y = np.nonzero(near)
            x, y = a[x], right[y]
            if not within and len(x):
                first = (keys[x] == keys[y]).argmax(1)
                x, y = x[first == band], y[first == band]
            fine = cosines(vectors[x], vectors[y]) >= threshold
            yield x[fine], y[fine]

    def one_cell(rows: pa.Table, coders: dict[int, Coder]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cls, n, comps = rows["cls"].to_numpy(), rows["n"].to_numpy(), rows["comp"].to_numpy()
        links, joins = np.zeros(len(cls), np.int64), []
        top: dict[int, int] = {}

        def root(c: int) -> int:
            while top.get(c, c) != c:
                c = top[c]
            return c

        for x, y in linked(rows, coders):
            np.add.at(links, x, n[y])
            np.add.at(links, y, n[x])
            if not within:
                for a, b in zip(x.tolist(), y.tolist()):
                    c, d = root(int(comps[a])), root(int(comps[b]))
                    if c != d:
                        top[max(c, d)] = min(c, d)
                        joins.append((a, b))
        some = np.flatnonzero(links)
        a, b = (np.array([j[k] for j in joins], np.int64) for k in (0, 1))
        return (
            np.concatenate((cls[some], cls[a])),
            np.concatenate((links[some], np.zeros(len(a), np.int64))),
            np.concatenate((np.zeros(len(some), np.int64), cls[b])),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = {d: Coder(d, *shape, threshold) for d, shape in shapes.items()}
        held: list[pa.RecordBatch] = []
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*done)] if done else [np.empty(0, np.int64)] * 3
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cls", "links", "other"])

        for batch in batches:
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and held[-1].column("cell")[0].as_py() != cells[a]:
                    done.append(one_cell(pa.Table.from_batches(held), coders))
                    held = []
                held.append(batch.slice(a, b - a))
            if sum(len(d[0]) for d in done) > 10_000:
                yield flush()
        if held:
            done.append(one_cell(pa.Table.from_batches(held), coders))
        yield flush()

    return (
        members.select(*_CELL_COLUMNS).repartition("cell").sortWithinPartitions("cell", "cls")
        .mapInArrow(run, "cls long, links long, other long")
    )


def _spread(own: str, other: str):
    """A member's cells: its own part against every part it meets."""
    return (
        F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), (F.col(own) > F.col(other)).cast("int").alias("side")
    )


def _group_cells(grouped: DataFrame, cell: int) -> DataFrame:
    """Members of groups, in parts of about ``cell``; each two parts meet in one cell."""
    sizes = grouped.groupBy("comp").agg(F.ceil(F.count("*") / cell).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    placed = grouped.join(sizes, "comp").withColumn("own", own)
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.select("cls", "comp", F.lit(0).alias("band"), *_spread("own", "other")).withColumn(
        "cell", F.concat_ws("/", "comp", "i", "j")
    )


def _bucket_cells(members: DataFrame, cell: int) -> DataFrame:
    """Members of buckets of several groups. A bucket's largest group is never compared
    with itself: its parts come after the others' and meet those only."""
    bucket = ["label", "dim", "band", "key"]
    by_group = members.groupBy(*bucket, "comp").agg(F.count("*").alias("m"))
    mixed = (
        by_group.groupBy(*bucket)
        .agg(F.count("*").alias("groups"), F.sum("m").alias("all"), F.max(F.struct("m", "comp")).alias("hub"))
        .where("groups > 1")
        .select(
            *bucket, F.col("hub.comp").alias("hub"), F.ceil(F.col("hub.m") / cell).cast("int").alias("hub_parts"),
            F.ceil((F.col("all") - F.col("hub.m")) / cell).cast("int").alias("parts"),
        )
    )
    inside = F.col("comp") == F.col("hub")
    spread = lambda parts: F.pmod(F.xxhash64("cls"), F.col(parts)).cast("int")
    placed = members.join(mixed, bucket).select(
        *bucket, "cls", "comp",
        F.when(inside, F.col("parts") + spread("hub_parts")).otherwise(spread("parts")).alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("parts") + F.when(inside, 0).otherwise(F.col("hub_parts")) - 1)).alias("other"),
    )
    return placed.select(*bucket, "cls", "comp", *_spread("own", "other")).select(
        "cls", "comp", "band", "side", F.concat_ws("/", *(F.col(c).cast("string") for c in (*bucket, "i", "j"))).alias("cell")
    )


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
    label_col: str = "label", cell: int = CELL,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable by links) and ``kept``."""
    given = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v"),  # one zero, not two
    )
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("v"))
    # One row for each id; those that cannot link are known by their missing vector.
    ids = given.where("vec_id IS NOT NULL").select("vec_id", F.when(able, F.struct("label", "v")).alias("it"))
    rows = stage(
        ids.groupBy("vec_id").agg(F.min("it").alias("it"))
        .select("vec_id", "it.label", "it.v", F.md5(F.to_json("it")).alias("same")),
        "rabitq-rows",
    )
    able_rows = rows.where("same IS NOT NULL")
    classes = stage(
        able_rows.groupBy("same")
        .agg(F.min("vec_id").alias("cls"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
        .withColumn("dim", F.size("v")),
        "rabitq-classes",
    )
    # A few numbers for each length of vectors, the largest label's classes among them.
    shapes = {
        r.dim: bands_for(r.n, threshold)
        for r in classes.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("n")).collect()
    }
    coded = stage(_coded(classes, shapes, threshold), "rabitq-codes")
    banded = coded.select("label", "dim", "cls", F.posexplode("bands").alias("band", "key"))
    bucket = ["label", "dim", "band", "key"]
    leaders = banded.groupBy(*bucket).agg(F.count("*").alias("m"), F.min_by("cls", F.xxhash64("cls")).alias("leader"))
    members = stage(
        banded.join(leaders.where("m > 1").drop("m"), bucket).select(*bucket, "cls", "leader"), "rabitq-buckets"
    )
    stars = (
        members.where("cls != leader")
        .select(F.least("cls", "leader").alias("u"), F.greatest("cls", "leader").alias("v"))
        .distinct()
    )
    links = stage(_confirmed(stars, coded, shapes, threshold), "rabitq-links")
    found = stage(components(links), "rabitq-groups")
    group = F.coalesce("component", "cls").alias("comp")
    labelled = stage(
        members.join(found, members.cls == found.node, "left").select(*bucket, "cls", group), "rabitq-labelled"
    )
    tops = found.select(F.col("component").alias("cls")).distinct().withColumn("comp", F.col("cls"))
    grouped = found.select(F.col("node").alias("cls"), F.col("component").alias("comp")).unionByName(tops)
    facts = coded.select("cls", "n", "dim", "vec", "code", "factor", "bands")
    inner = _count_in_cells(_group_cells(grouped, cell).join(facts, "cls"), shapes, threshold, within=True)
    outer = _count_in_cells(_bucket_cells(labelled, cell).join(facts, "cls"), shapes, threshold, within=False)
    counts = stage(inner.unionByName(outer), "rabitq-counts")
    more = counts.where("links = 0").select(F.col("cls").alias("u"), F.col("other").alias("v"))
    whole = components(links.unionByName(more))

    linked = counts.where("links > 0").groupBy("cls").agg(F.sum("links").alias("links"))
    result = stage(
        classes.select("cls", "n", "same")
        .join(linked, "cls", "left")
        .join(whole.withColumnRenamed("node", "cls"), "cls", "left")
        .select(
            "same", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("component", "cls").alias("component"),
        ),
        "rabitq-result",
    )
    # A class may have many vectors: the join stands alone, so that it can be split.
    judged = able_rows.select("vec_id", "same").join(result, "same", "left")
    out = judged.select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        (F.col("vec_id") == F.col("component")).alias("kept"),
    )
    alone = rows.where("same IS NULL").select("vec_id").unionByName(given.where("vec_id IS NULL").select("vec_id"))
    return out.unionByName(
        alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    )
