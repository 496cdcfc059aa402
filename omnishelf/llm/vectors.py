"""Nearest vectors by inner product: inverted lists scanned by dimension, abandoning early."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omnishelf.llm.common import ready, stored

NEAREST = 20
# Rows (smallest hashes of the id) that the lists are fitted on; every row is indexed.
SAMPLE_ROWS = 20_000
MOST_LISTS = 1024
# Lists are probed until queries from the sample (so many, spread over it) reach this recall in it.
RECALL, RECALL_QUERIES = 0.96, 400
# A query's nearest lists with so many times k candidates are scanned first, for its bound.
FIRST = 4
# Columns that one step adds to the partial distances.
COLUMNS = 8
# A candidate is abandoned when its partial distance, carried on to all columns, passes the bound by
# this factor over the root of the columns seen. Larger: fewer wrongly abandoned, more work.
CAUTION = 2.1
# Candidates looked at before the bound is drawn tighter: at first, and at most.
CHUNK, MOST_CHUNK = 64, 1024
# Queries that scan a chunk together. Whole blocks are compared, instead of pair by pair, for so many
# queries or more and while such a share of their pairs is left.
TOGETHER, LEAST_TOGETHER, DENSE = 256, 8, 0.25
# Vectors and queries that one task compares at a time; a hot list is dealt over several.
CELL_VECTORS, CELL_QUERIES = 8192, 2048
# Coordinates that one task should look at.
TASK_COORDINATES = 200_000_000


@dataclass
class Index:
    """Fitted on the sample: longest norm, rotation of the augmented space, centroids in it."""

    longest: float
    rotation: np.ndarray
    centroids: np.ndarray

    def place(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Rotated vectors with one more coordinate, so that the nearest point has the largest inner
        product: sqrt(longest**2 - norm**2) for stored vectors, 0 for queries."""
        spare = np.zeros(len(vectors))
        if not query:
            spare = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, spare]) @ self.rotation


def kmeans(points: np.ndarray, lists: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), lists, replace=False)].copy()
    for _ in range(rounds):
        near = nearest_centre(points, centres)
        size = np.bincount(near, minlength=lists)
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        full = size > 0
        centres[full] = total[full] / size[full, None]
        # A list that lost all its points starts again from a random one.
        centres[~full] = points[rng.integers(0, len(points), int((~full).sum()))]
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    norm = (centres**2).sum(axis=1)
    out = np.empty(len(points), np.int64)
    for a in range(0, len(points), 1024):
        out[a : a + 1024] = (norm - 2 * points[a : a + 1024] @ centres.T).argmin(axis=1)
    return out


def needed_probes(index: Index, sample: np.ndarray, k: int, recall: float = RECALL) -> int:
    """Lists to probe so that queries from the sample find ``recall`` of their ``k`` nearest in it.

    The sample is thinner than the table, so its neighbours lie further off and need more lists.
    """
    asked = np.arange(0, len(sample), max(1, len(sample) // RECALL_QUERIES))
    near = nearest_centre(index.place(sample, query=False), index.centroids)
    norm = (index.centroids**2).sum(axis=1)
    need = []
    for q in asked:
        score = sample @ sample[q]
        score[q] = -np.inf
        best = np.argsort(-score, kind="stable")[: min(k, len(sample) - 1)]
        order = (norm - 2 * (index.place(sample[[q]], query=True) @ index.centroids.T)[0]).argsort()
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        need.append(turn[near[best]] + 1)
    need = np.sort(np.concatenate(need))
    return int(need[max(0, int(np.ceil(recall * len(need))) - 1)]) if len(need) else 1


class Cell:
    """Vectors of a cell, and their rotated coordinates in blocks of columns."""

    def __init__(self, index: Index, ids: np.ndarray, raw: np.ndarray):
        self.index, self.ids, self.raw = index, ids, raw
        points = index.place(raw, query=False)
        self.width = points.shape[1]
        self.blocks = [
            np.ascontiguousarray(points[:, c : c + COLUMNS]) for c in range(0, self.width, COLUMNS)
        ]
        # Coordinates that scans have looked at.
        self.looked = 0

    def scan(self, query_id: int, query: np.ndarray, target: np.ndarray, k: int, least: float):
        """The ``k`` best candidates with an inner product of ``least`` or more: ids and products."""
        asked = np.array([query_id]), query[None], target[None], np.array([least], float)
        return self.scan_all(*asked, k)[1:]

    def scan_all(self, query_ids: np.ndarray, queries: np.ndarray, targets: np.ndarray,
                 least: np.ndarray, k: int):
        """The ``k`` best candidates of each query with an inner product of its ``least`` or more:
        numbers of the queries, ids and products."""
        out = []
        for a in range(0, len(queries), TOGETHER):
            own = slice(a, a + TOGETHER)
            q, ids, scores = self._together(query_ids[own], queries[own], targets[own], least[own], k)
            out.append((q + a, ids, scores))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _together(self, query_ids, queries, targets, least, k: int):
        """Candidates are looked at in chunks, block by block. After each block a test asks whether
        a candidate's partial distance could still belong to a full one within the query's bound;
        those that fail are abandoned. The bound is the distance of ``least`` and then of the k-th
        best found."""
        far = np.einsum("ij,ij->i", queries, queries) + self.index.longest**2
        bound = np.maximum(far - 2 * least, 0.0) * (1 + 1e-9)
        best_q, best_ids, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        a, chunk = 0, CHUNK
        while a < len(self.ids):
            q, v = self._near(slice(a, a + chunk), query_ids, targets, bound, far)
            a, chunk = a + chunk, min(2 * chunk, MOST_CHUNK)
            if not len(q):
                continue
            scores = np.einsum("ij,ij->i", self.raw[v], queries[q])
            best_q = np.concatenate([best_q, q])
            best_ids = np.concatenate([best_ids, self.ids[v]])
            best_scores = np.concatenate([best_scores, scores])
            order = np.lexsort((best_ids, -best_scores, best_q))
            rank = np.arange(len(order)) - np.searchsorted(best_q[order], best_q[order], "left")
            order, rank = order[rank < k], rank[rank < k]
            best_q, best_ids, best_scores = best_q[order], best_ids[order], best_scores[order]
            full = rank == k - 1
            tighter = np.maximum(far[best_q[full]] - 2 * best_scores[full], 0.0) * (1 + 1e-9)
            bound[best_q[full]] = np.minimum(bound[best_q[full]], tighter)
        return best_q, best_ids, best_scores

    def _near(self, chunk: slice, query_ids, targets, bound, far):
        """(query, candidate) pairs of a chunk that no block's test abandons.

        Blocks are compared whole, by a matrix product, while many pairs are left, then pair by
        pair. ``far`` scales what the product's rounding may add to a distance.
        """
        alive = self.ids[chunk] != query_ids[:, None]
        partial, q, v = np.zeros(alive.shape), None, None
        if len(alive) < LEAST_TOGETHER:
            q, v = np.nonzero(alive)
            partial, v = partial[q, v], v + chunk.start
        for c, block in enumerate(self.blocks):
            seen = c * COLUMNS + block.shape[1]
            wanted = targets[:, c * COLUMNS : seen]
            slack = (1 + CAUTION / np.sqrt(seen)) ** 2 if seen < self.width else 1 + 1e-9
            most = bound * (seen / self.width) * slack + 1e-12 * (1 + far)
            if q is None:
                own = block[chunk]
                self.looked += partial.shape[0] * own.size
                ones = np.ones((len(wanted), 1)), np.ones((len(own), 1))
                sums = [np.einsum("ij,ij->i", x, x)[:, None] for x in (wanted, own)]
                partial += np.hstack([-2 * wanted, ones[0], sums[0]]) @ np.hstack([own, sums[1], ones[1]]).T
                alive &= partial <= most[:, None]
                if np.count_nonzero(alive) < DENSE * alive.size:
                    q, v = np.nonzero(alive)
                    partial, v = partial[q, v], v + chunk.start
            else:
                part = block[v] - wanted[q]
                self.looked += part.size
                partial = partial + np.einsum("ij,ij->i", part, part)
                stay = partial <= most[q]
                q, v, partial = q[stay], v[stay], partial[stay]
            if q is not None and not len(q):
                break
        if q is None:
            q, v = np.nonzero(alive)
            v = v + chunk.start
        return q, v


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _assign(batches: Iterator[pa.RecordBatch], shared):
    index: Index = shared.value
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _matrix(batch.column(1))
        near = nearest_centre(index.place(vectors, query=False), index.centroids)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(near.astype(np.int32))], ["vec_id", "vector", "list"]
        )


def _probes(batches: Iterator[pa.RecordBatch], shared, sizes: np.ndarray, probes: int, k: int):
    """The lists of each query, nearest first, and how many of them are scanned first."""
    index: Index = shared.value
    norm = (index.centroids**2).sum(axis=1)
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _matrix(batch.column(1))
        order = (norm - 2 * index.place(vectors, query=True) @ index.centroids.T).argsort(axis=1)
        # Enough lists to hold k candidates besides the query's own row.
        held = np.cumsum(sizes[order], axis=1)
        enough = np.maximum((held <= k).sum(axis=1) + 1, probes)
        first = (held <= FIRST * k).sum(axis=1) + 1
        lists = [o[:n].astype(np.int32) for o, n in zip(order, enough, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(lists, pa.list_(pa.int32())), pa.array(first, pa.int32())],
            ["query_id", "query", "lists", "first"],
        )


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _cell(vectors: pa.Table, queries: pa.Table, shared, k: int) -> pa.Table:
    """What the queries of a cell find among its vectors."""
    columns = [[]] * 3
    if len(vectors) and len(queries):
        vectors = vectors.sort_by("vec_id")
        cell = Cell(shared.value, vectors["vec_id"].to_numpy(), _matrix(vectors["vector"]))
        asked, ids = _matrix(queries["query"]), queries["query_id"].to_numpy()
        targets, least = shared.value.place(asked, query=True), queries["least"].to_numpy()
        q, *found = cell.scan_all(ids, asked, targets, least, k)
        columns = [ids[q], *found]
    return pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND
    )


def _search(kept: DataFrame, asked: DataFrame, counts: np.ndarray, shared, k: int) -> DataFrame:
    """query_id, vec_id, score: the best ``k`` of each cell for the queries (query_id, query, list,
    least) of its list.

    Lists are cut into cells of about ``CELL_VECTORS``, and the queries of a list likewise, so a hot
    list is shared by many tasks. The number of tasks follows the coordinates to be looked at.
    """
    spark = kept.sparkSession
    # One row per list, at most MOST_LISTS.
    asking = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}
    work = sum(int(counts[i]) * n for i, n in asking.items()) * shared.value.rotation.shape[0]
    tasks = max(1, spark.sparkContext.defaultParallelism, -(-work // TASK_COORDINATES))
    plan = [
        (i, int(-(-counts[i] // CELL_VECTORS)), -(-n // CELL_QUERIES)) for i, n in asking.items() if counts[i]
    ]
    cells = F.broadcast(spark.createDataFrame(plan, "list int, cells int, q_cells int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = kept.join(cells, "list").select(
        "vec_id", "vector", "list",
        F.pmod(F.xxhash64("vec_id"), F.col("cells")).cast("int").alias("cell"),
        every("q_cells").alias("q_cell"),
    )
    right = asked.join(cells, "list").select(
        "query_id", "query", "least", "list", every("cells").alias("cell"),
        F.pmod(F.xxhash64("query_id"), F.col("q_cells")).cast("int").alias("q_cell"),
    )
    by = ["list", "cell", "q_cell"]
    left, right = (df.repartition(tasks, *by).groupBy(*by) for df in (left, right))
    return left.cogroup(right).applyInArrow(
        lambda v, q: _cell(v, q, shared, k), "query_id long, vec_id long, score double"
    )


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long"), v.alias("vector"), fine.alias("fine")).filter(
        "vec_id IS NOT NULL AND vector IS NOT NULL AND fine"
    ).filter(F.exists("vector", lambda x: x != 0)).drop("fine")


def nearest(vectors: DataFrame, every: int = 20, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products found for each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates all other rows. Vectors
    get one more coordinate that turns inner product into distance, and a random rotation that makes
    partial distances tell. Lists come from k-means on at most ``SAMPLE_ROWS`` rows; every row is
    put in its list. A query probes as many lists as queries from the sample need for ``RECALL``,
    and more where they hold fewer than ``k`` candidates. Its nearest lists are scanned first; the
    k-th best product found there bounds the scan of the others, where most candidates are abandoned
    after a few columns. Scores are inner products of the original vectors in double precision; ties
    go to the smaller vec_id.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do those
    without a vec_id or of another length than most. Rows that repeat a vec_id are candidates each,
    but never for that id's query, which asks with the least of their vectors. Too few rows give fewer ranks, none an empty result.
    """
    spark = ready(vectors.sparkSession)
    schema = "query_id long, rank int, vec_id long, score double"
    valid = usable(vectors)
    sizes = valid.groupBy(F.size("vector").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("m")
    ).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    dims, n, longest = sizes["d"], sizes["n"], float(np.sqrt(sizes["m"]))
    valid = valid.filter(F.size("vector") == dims)

    sample = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vector").toArrow()
    sample = _matrix(sample["vector"])
    lists = int(min(MOST_LISTS, max(1, np.sqrt(n)), len(sample)))
    turn, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((dims + 1, dims + 1)))
    index = Index(longest, turn, np.zeros((0, dims + 1)))
    index.centroids = kmeans(index.place(sample, query=False), lists)
    shared = spark.sparkContext.broadcast(index)

    kept = stored(
        valid.mapInArrow(lambda b: _assign(b, shared), "vec_id long, vector array<double>, list int")
    )
    counts = np.zeros(lists, np.int64)
    for row in kept.groupBy("list").count().collect():  # one row per list: at most MOST_LISTS
        counts[row["list"]] = row["count"]
    probes = min(lists, needed_probes(index, sample, k))
    asked = kept.filter(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(
        F.min("vector").alias("query")
    )
    asked = asked.mapInArrow(
        lambda b: _probes(b, shared, counts, probes, k),
        "query_id long, query array<double>, lists array<int>, first int",
    )
    asked = stored(
        asked.select("query_id", "query", "first", F.posexplode("lists").alias("turn", "list"))
    )
    no_bound = F.lit(float("-inf")).alias("least")
    first = asked.filter("turn < first").select("query_id", "query", "list", no_bound)
    nearby = stored(_search(kept, first, counts, shared, k))
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = nearby.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") == k)
    bounds = bounds.select(F.col("query_id").alias("bound_id"), F.col("score").alias("least"))
    rest = asked.filter("turn >= first").join(
        bounds, F.col("query_id") == F.col("bound_id"), "left"
    ).select("query_id", "query", "list", F.coalesce("least", no_bound).alias("least"))
    found = nearby.union(_search(kept, stored(rest), counts, shared, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
