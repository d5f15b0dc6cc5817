"""Approximate nearest neighbours by largest inner product, with adaptive dimension
sampling (Gao and Long, "High-Dimensional Approximate Nearest Neighbor Search:
with Reliable and Efficient Distance Comparison Operations", 2023).

Inner products become distances by one more coordinate (vectors of norm x get
sqrt(M^2 - x^2), M the largest norm; queries get 0). Lists come from k-means in two
levels on a bounded sample, about the square root of the rows in number; every vector
goes to its nearest list. A query visits its nearest lists. There the rotated vectors
are read in column blocks: after each, the distance so far, scaled up, is tested
against the query's k-th best distance, and a candidate that is significantly farther
is abandoned. What survives all columns is scored exactly on the original vectors.

A list is read for all its queries at once: a column block of a tile of queries and
candidates is one matrix product, the test one comparison of the tile. Once few
candidates of a tile are left, only those are read on.

How many lists a query visits is measured, not guessed: for ``CALIBRATION``
seeded vectors the exact neighbours are found against all rows, and the least
number of lists that holds ``TARGET_RECALL`` of them is taken.

The work is laid on a grid: neighbouring lists are one region of about ``BLOCK`` vectors
(a larger list is dealt into blocks of that size), its queries come in chunks of about
``CHUNK``, one cell for each pair, so neither a crowded list nor a popular one grows a
task. A query is sent once to a region, whatever the number of lists it visits there.
The driver holds the sample, the list sizes and the calibration's neighbours, all
bounded by parameters.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part, nor do rows without an id or of another length than
most; rows of one id are one vector (the least); a query with fewer than k
candidates gets all of them; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import hash_sample, stage

K = 20
SAMPLE = 16_384
SAMPLE_A_LIST = 16
MAX_LISTS = 4_096
BOUND_SAMPLE = 4_096
CALIBRATION = 96
TARGET_RECALL = 0.96
COLUMNS = 16
EPSILON = 2.1
BLOCK, CHUNK = 16_384, 16_384
REGIONS = 16  # at least, if they hold LEAST_BLOCK vectors
LEAST_BLOCK = 512
TILE = 512, 2_048
SPARSE = 16  # one candidate in so many left: the others are not read on
SEED = 3


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, one for each id."""
    v = F.col("v")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(v, lambda x: x != 0)
    fine = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
        .where(~odd & ~zero)
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )
    return stage(fine, "ads-vectors")


def _norm2(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)


def matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.empty((0, 0))


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the same for a vector wherever it lies."""
    return np.ascontiguousarray(vectors * query).sum(axis=1)


@dataclass
class Index:
    """Rotation, list centres and a sample for first bounds."""

    top: float
    rotation: np.ndarray
    centres: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray

    def rotated(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(vectors), len(self.rotation)))
        out[:, : vectors.shape[1]] = vectors
        if not query:
            out[:, vectors.shape[1]] = np.sqrt(np.maximum(0.0, self.top - (vectors**2).sum(1)))
        return out @ self.rotation

    def list_distances(self, rotated: np.ndarray) -> np.ndarray:
        return (self.centres**2).sum(1) - 2 * rotated @ self.centres.T


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    own = (centres**2).sum(1)
    parts = [(own - 2 * points[at : at + 512] @ centres.T).argmin(1) for at in range(0, len(points), 512)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def kmeans(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(10):
        near = nearest(points, centres)
        order = near.argsort(kind="stable")
        full, starts = np.unique(near[order], return_index=True)
        counts = np.diff(np.append(starts, len(points)))
        centres[full] = np.add.reduceat(points[order], starts) / counts[:, None]
    return centres


def list_centres(points: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    """About ``lists`` centres in two levels; those of one coarse cell are neighbours."""
    coarse = int(np.ceil(np.sqrt(lists)))
    near = nearest(points, kmeans(points, coarse, rng))
    out = []
    for c in np.unique(near):
        own = points[near == c]
        fine = round(lists * len(own) / len(points))
        out.append(kmeans(own, min(max(1, fine), len(own), 4 * coarse), rng))
    return np.concatenate(out)


def fit(clean: DataFrame, n_rows: int, dim: int, top: float, seed: int = SEED) -> Index:
    h = F.xxhash64(F.lit(seed), "vec_id")
    lists = int(min(MAX_LISTS, max(1, np.sqrt(n_rows))))
    size = max(SAMPLE, SAMPLE_A_LIST * lists)
    rows = hash_sample(clean, size, n_rows, h).select("vec_id", "v", h.alias("h")).toArrow()
    if not rows.num_rows:  # a rate may miss all of a few rows
        rows = clean.select("vec_id", "v", h.alias("h")).limit(1).toArrow()
    rows = rows.sort_by([("h", "ascending"), ("vec_id", "ascending")])
    ids, sample = rows["vec_id"].to_numpy(), matrix(rows["v"].combine_chunks())
    rng = np.random.default_rng(seed)
    width = dim + 1
    rotation, _ = np.linalg.qr(rng.standard_normal((width, width)))
    index = Index(top, rotation, np.empty((0, width)), ids[:BOUND_SAMPLE], sample[:BOUND_SAMPLE])
    points = index.rotated(sample, False)
    index.centres = list_centres(points, min(lists, len(points)), rng)
    return index


def regions(sizes: np.ndarray, block: int) -> np.ndarray:
    """The region of each list: neighbouring lists that begin in the same ``block`` vectors."""
    return (np.cumsum(sizes) - sizes) // block


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def column_blocks(width: int) -> list[tuple[int, int]]:
    """Blocks of ``COLUMNS`` columns; a short rest joins the last one."""
    starts = [c for c in range(0, width, COLUMNS) if not c or width - c >= COLUMNS // 2]
    return list(zip(starts, [*starts[1:], width]))


class Scan:
    """A cell's vectors (sorted by list) and queries, rotated, in column blocks.

    A block has one more column, so that the sum of its products up to a block is
    <x, q> - |x|^2 / 2 over the columns seen: the test of the distance so far
    compares it with one number a query.
    """

    def __init__(self, index: Index, vectors: np.ndarray, queries: np.ndarray, bounds: np.ndarray):
        turned, asked = index.rotated(vectors, False), index.rotated(queries, True)
        width = turned.shape[1]
        self.vectors, self.queries, self.top = vectors, queries, index.top
        self.own = (queries**2).sum(1)
        self.reach = bounds.astype(float)
        self.x, self.q, self.seen_q, self.scale = [], [], [], []
        for a, b in column_blocks(width):
            x, q = turned[:, a:b], asked[:, a:b]
            self.x.append(np.hstack([x, (x**2).sum(1, keepdims=True)]))
            self.q.append(np.hstack([q, np.full((len(q), 1), -0.5)]))
            self.seen_q.append((asked[:, :b] ** 2).sum(1))
            self.scale.append(1.0 if b == width else b / width * (1 + EPSILON / np.sqrt(b)) ** 2)

    def least(self, q: np.ndarray) -> list[np.ndarray]:
        """After each block, the least sum with which a candidate of ``q`` goes on."""
        room = self.own[q] + self.top
        # Squared distance of a candidate at the k-th best score, with room for rounding.
        limit = np.where(self.reach[q] > -np.inf, room - 2 * self.reach[q], np.inf) + 1e-9 * room
        return [(seen[q] - limit * scale) / 2 for seen, scale in zip(self.seen_q, self.scale)]

    def survivors(self, q: np.ndarray, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of queries ``q`` and vectors start to stop that pass all blocks (places)."""
        least = self.least(q)
        last = len(least) - 1
        sums = alive = None
        for c in range(last + 1):
            part = self.q[c][q] @ self.x[c][start:stop].T
            sums = part if sums is None else np.add(sums, part, out=sums)
            fine = sums >= least[c][:, None]
            alive = fine if alive is None else np.logical_and(alive, fine, out=alive)
            if c < last and SPARSE * np.count_nonzero(alive) < alive.size:
                break
        i, j = np.divmod(np.flatnonzero(alive), stop - start)
        some = sums[i, j]
        for c in range(c + 1, last + 1):
            some += np.einsum("ij,ij->i", self.q[c][q[i]], self.x[c][start + j])
            fine = some >= least[c][i]
            i, j, some = i[fine], j[fine], some[fine]
        return q[i], start + j

    def scores(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        step = 16_384
        parts = [inner(self.vectors[j[a : a + step]], self.queries[i[a : a + step]]) for a in range(0, len(i), step)]
        return np.concatenate(parts) if parts else np.empty(0)


def best_each(i: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k largest scores of each ``i``, best first, ties to the smaller id;
    and each one's rank."""
    order = np.lexsort((ids, -scores, i))
    sorted_i = i[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_i, sorted_i)
    return order[rank < k], rank[rank < k]


def scan_block(
    index: Index, ids: np.ndarray, vectors: np.ndarray, lists: np.ndarray, query_ids: np.ndarray,
    queries: np.ndarray, bounds: np.ndarray, visits: tuple[np.ndarray, np.ndarray], k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best of the lists it visits in a block: places of the queries,
    of the vectors, and exact scores.

    ``bounds`` has a score that a candidate must reach; it rises to the k-th best of
    a list once that is larger. ``visits``: places of queries, and a list for each.
    """
    by_list = lists.argsort(kind="stable")
    ids, held = ids[by_list], lists[by_list]
    scan = Scan(index, vectors[by_list], queries, bounds)
    by_visit = visits[1].argsort(kind="stable")
    visitor, visited = visits[0][by_visit], visits[1][by_visit]
    n_q, n_x = TILE
    found = []
    for one in np.unique(held):
        first, end = np.searchsorted(held, [one, one + 1])
        own = visitor[slice(*np.searchsorted(visited, [one, one + 1]))]
        for a in range(0, len(own), n_q):
            for start in range(first, end, n_x):
                i, j = scan.survivors(own[a : a + n_q], start, min(end, start + n_x))
                other = ids[j] != query_ids[i]
                i, j = i[other], j[other]
                scores = scan.scores(i, j)
                kept, rank = best_each(i, scores, ids[j], k)
                i, j, scores = i[kept], j[kept], scores[kept]
                full = rank == k - 1
                scan.reach[i[full]] = np.maximum(scan.reach[i[full]], scores[full])
                found.append((i, j, scores))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    i, j, scores = (np.concatenate(c) for c in zip(*found))
    kept, _ = best_each(i, scores, ids[j], k)
    return i[kept], by_list[j[kept]], scores[kept]


def _assign(clean: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            vectors = matrix(batch.column("v"))
            near = nearest(index.rotated(vectors, False), index.centres) if len(vectors) else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.int32())], ["vec_id", "v", "list"]
            )

    return clean.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<double>, list int")


def _calibrate(assigned: DataFrame, index: Index, k: int, target: float) -> int:
    """Lists to visit so that ``target`` of the exact neighbours of a few seeded
    vectors lie in them."""
    ids, queries = index.sample_ids[:CALIBRATION], index.sample[:CALIBRATION]
    shared = assigned.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own = shared.value
        top: list = [[] for _ in own_ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            vec_ids = batch.column("vec_id").to_numpy()
            lists = batch.column("list").to_numpy()
            scores = matrix(batch.column("v")) @ own.T
            for q in range(len(own)):
                s = np.where(vec_ids == own_ids[q], -np.inf, scores[:, q])
                for p in best(s, vec_ids, k):
                    top[q].append((-s[p], vec_ids[p], lists[p]))
                top[q] = sorted(top[q])[:k]
        rows = [(q, -s, i, l) for q, found in enumerate(top) for s, i, l in found if s < np.inf]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([],) * 4, (pa.int32(), pa.float64(), pa.int64(), pa.int32()))],
            ["q", "score", "vec_id", "list"],
        )

    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = (
        assigned.mapInArrow(run, "q int, score double, vec_id long, list int")
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .collect()
    )
    order = index.list_distances(index.rotated(queries, True)).argsort(1).argsort(1)
    visits = np.sort([order[r.q, r.list] for r in found])
    if not len(visits):
        return 1
    return int(visits[min(len(visits) - 1, int(np.ceil(target * len(visits))))]) + 1


def first_hits(index: Index, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray]:
    """Each query's k best of the index's sample, and the k-th score (-inf, if fewer)."""
    rough = queries @ index.sample.T
    rough[index.sample_ids == ids[:, None]] = -np.inf
    room = 1e-9 * np.sqrt((queries**2).sum(1) * index.top)
    at = max(0, rough.shape[1] - k)
    least = np.partition(rough, at, axis=1)[:, at] - room
    i, j = np.nonzero((rough >= least[:, None]) & (rough > -np.inf))
    scores = inner(index.sample[j], queries[i])
    kept, rank = best_each(i, scores, index.sample_ids[j], k)
    i, j, scores = i[kept], j[kept], scores[kept]
    bounds = np.full(len(ids), -np.inf)
    bounds[i[rank == k - 1]] = scores[rank == k - 1]
    hits = pa.StructArray.from_arrays(
        [pa.array(index.sample_ids[j], pa.int64()), pa.array(scores, pa.float64())], ["vec_id", "score"]
    )
    starts = np.searchsorted(i, np.arange(len(ids) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(starts, hits), bounds


def visited_regions(asked: np.ndarray, region: np.ndarray) -> pa.Array:
    """Per query (row of ``asked``, lists by columns) its regions, each with its lists."""
    q, lists = np.nonzero(asked)
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (region[lists[1:]] != region[lists[:-1]])
    at = np.flatnonzero(new)
    own = pa.ListArray.from_arrays(np.append(at, len(q)).astype(np.int32), pa.array(lists, pa.int32()))
    visit = pa.StructArray.from_arrays([pa.array(region[lists[at]], pa.int32()), own], ["region", "lists"])
    starts = np.searchsorted(q[at], np.arange(len(asked) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(starts, visit)


def search(
    vectors: DataFrame, is_query: Column, k: int = K, target_recall: float = TARGET_RECALL,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """Per query (rows of ``vectors`` where ``is_query``, a condition on vec_id) and
    rank: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    clean = usable(vectors, id_col, vec_col)
    lengths = clean.groupBy(F.size("v").alias("dim")).count().collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    dim = max(lengths, key=lambda r: (r["count"], r.dim)).dim
    clean = clean.where(F.size("v") == dim)
    n_rows, top = clean.agg(F.count("*"), F.max(_norm2(F.col("v")))).first()
    index = fit(clean, n_rows, dim, top)
    shared = spark.sparkContext.broadcast(index)
    assigned = stage(_assign(clean, shared), "ads-lists")
    sizes = np.zeros(len(index.centres), np.int64)
    for r in assigned.groupBy("list").count().collect():
        sizes[r.list] = r["count"]
    visits = _calibrate(assigned, index, k, target_recall)

    block = int(min(BLOCK, max(LEAST_BLOCK, n_rows // REGIONS)))
    region = regions(sizes, block)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, queries = part.column("vec_id").to_numpy(), matrix(part.column("v"))
                hits, bounds = first_hits(index, ids, queries, k)
                order = index.list_distances(index.rotated(queries, True)).argsort(1, kind="stable")
                enough = (np.cumsum(sizes[order], 1) <= k).sum(1) + 1
                asked = np.zeros(order.shape, bool)
                near = np.arange(order.shape[1]) < np.maximum(visits, enough)[:, None]
                np.put_along_axis(asked, order, near, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"), part.column("v"), visited_regions(asked & (sizes > 0), region),
                        hits, pa.array(bounds, pa.float64()),
                    ],
                    ["query_id", "v", "visits", "hits", "bound"],
                )

    asked = stage(
        assigned.where(is_query).select("vec_id", "v").mapInArrow(
            visit,
            "query_id long, v array<double>, visits array<struct<region:int,lists:array<int>>>, "
            "hits array<struct<vec_id:long,score:double>>, bound double",
        ),
        "ads-queries",
    )
    visiting = asked.select("query_id", "v", "bound", F.explode("visits").alias("visit"))
    visiting = visiting.select("query_id", "v", "bound", "visit.*")
    # The grid: at most MAX_LISTS rows.
    chunks = {r.region: -(-r["count"] // CHUNK) for r in visiting.groupBy("region").count().collect()}
    blocks = {r: -(-int(sizes[region == r].sum()) // BLOCK) for r in chunks}
    cells = spark.createDataFrame([(r, blocks[r], chunks[r]) for r in chunks], "region int, blocks int, chunks int")
    grid = spark.createDataFrame(
        [(n, r, blocks[r], chunks[r]) for n, r in enumerate(region.tolist()) if r in chunks],
        "list int, region int, blocks int, chunks int",
    )
    across = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = assigned.join(F.broadcast(grid), "list").select(
        "region", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), across("chunks").alias("chunk"),
        "vec_id", "v", "list",
    )
    wanted = visiting.join(F.broadcast(cells), "region").select(
        "region", across("blocks").alias("block"), F.pmod(F.xxhash64("query_id"), "chunks").cast("int").alias("chunk"),
        "query_id", "v", "bound", "lists",
    )

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        q_ids, ids = right["query_id"].to_numpy(), left["vec_id"].to_numpy()
        i, j, scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        if len(ids) and len(q_ids):
            held_vectors, queries = (matrix(t["v"].combine_chunks()) for t in (left, right))
            own = right["lists"].combine_chunks()
            visitor = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy())
            i, j, scores = scan_block(
                shared.value, ids, held_vectors, left["list"].to_numpy(), q_ids, queries,
                right["bound"].to_numpy(), (visitor, own.flatten().to_numpy()), k,
            )
        return pa.table(
            {"query_id": pa.array(q_ids[i], pa.int64()), "vec_id": pa.array(ids[j], pa.int64()), "score": scores}
        )

    keys = ["region", "block", "chunk"]
    found = held.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(
        cell, "query_id long, vec_id long, score double"
    )
    first = asked.select("query_id", F.explode("hits").alias("hit")).select("query_id", "hit.vec_id", "hit.score")
    every = found.unionByName(first).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
