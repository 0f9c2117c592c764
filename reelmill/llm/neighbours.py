"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a sample is cut into balanced parts, and a small classifier learns which parts a vector's neighbours
are in. Every vector of the table goes to its most probable part; a query is routed to the several parts it finds most
probable, and all vectors there are ranked by exact inner products. How many parts that takes is measured on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.shared import frozen, hash_sample, small_batches

SAMPLE = 4096  # vectors that partition and classifier are fitted on; twice as many at most
PARTS = 32  # a power of two
GRAPH = 10  # neighbours in the graph
HIDDEN = 96
STEPS = 600
RECALL = 0.96  # of the true neighbours within the sample that routing has to reach, on vectors held out of the fit
BLOCK = 16_384  # vectors that a task holds while queries pass


@dataclass
class Router:
    """A two-layer classifier of vectors into parts, and how many parts a query visits."""

    weights: list[np.ndarray]
    visits: int

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.maximum(vectors / np.where(norms > 0, norms, 1) @ a + b, 0) @ c + d


def nearest(queries: np.ndarray, vectors: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """The k vectors with the largest inner products for each query, nearest first; ``own`` is left out."""
    out = []
    for at in range(0, len(queries), 512):
        products = queries[at:at + 512] @ vectors.T
        if own is not None:
            products[np.arange(len(products)), own[at:at + 512]] = -np.inf
        top = np.argpartition(-products, min(k, products.shape[1] - 1), axis=1)[:, :k]
        out.append(np.take_along_axis(top, np.argsort(-np.take_along_axis(products, top, 1), axis=1), 1))
    return np.concatenate(out) if out else np.zeros((0, k), np.int64)


def balanced_parts(links: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Cut a graph (row: a node's neighbours) into equal parts with few links between them.

    Halves are cut again and again. A half is where a slow mode of the graph, found by smoothing a random vector over the
    links, is above its median; then pairs of nodes that gain most by changing sides are swapped.
    """
    count, width = links.shape
    heads = np.repeat(np.arange(count), width)
    tails = links.ravel()
    part = np.zeros(count, np.int64)
    size = 1
    while size < parts:
        for k in range(size):
            nodes = np.flatnonzero(part == k)
            place = np.full(count, -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[heads] >= 0) & (place[tails] >= 0)
            a, b = place[heads[inside]], place[tails[inside]]
            a, b = np.concatenate([a, b]), np.concatenate([b, a])
            degree = np.bincount(a, minlength=len(nodes)) + 1.0
            mode = rng.normal(size=len(nodes))
            for _ in range(60):
                mode -= (mode * degree).sum() / degree.sum()
                mode = (mode + np.bincount(a, mode[b], len(nodes))) / degree
                mode /= max(np.abs(mode).max(), 1e-12)
            side = np.zeros(len(nodes), bool)
            side[np.argsort(mode, kind="stable")[len(nodes) // 2:]] = True
            for _ in range(10):
                other = np.bincount(a, side[a] != side[b], len(nodes))
                gain = 2 * other - (degree - 1)
                up, down = (np.flatnonzero((side == s) & (gain > 0)) for s in (False, True))
                swaps = min(len(up), len(down), max(len(nodes) // 20, 1))
                if not swaps:
                    break
                up, down = (x[np.argsort(-gain[x], kind="stable")[:swaps]] for x in (up, down))
                side[up], side[down] = True, False
            part[nodes[side]] = k + size
        size *= 2
    return part


def fit_router(vectors: np.ndarray, k: int, parts: int = PARTS, recall: float = RECALL, seed: int = 0) -> Router:
    """Fit on four fifths of a sample, and choose the visits by the rest's recall of their k nearest of the sample."""
    rng = np.random.default_rng(seed)
    count, width = vectors.shape
    parts = max(1, min(parts, 1 << max(int(np.log2(max(count // 32, 1))), 0)))
    weights = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    router = Router(weights, parts)
    if parts == 1:
        return router
    order = rng.permutation(count)
    held, used = order[:count // 5], order[count // 5:]
    links = nearest(vectors[used], vectors[used], GRAPH, np.arange(len(used)))
    part = balanced_parts(links, parts, rng)
    goal = np.zeros((len(used), parts))  # where a vector and its neighbours are
    np.add.at(goal, (np.arange(len(used)), part), 2.0)
    for column in links.T:
        np.add.at(goal, (np.arange(len(used)), part[column]), 1.0)
    goal /= goal.sum(axis=1, keepdims=True)
    norms = np.linalg.norm(vectors[used], axis=1, keepdims=True)
    inputs = vectors[used] / np.where(norms > 0, norms, 1)
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        rows = rng.integers(0, len(used), 512)
        x, y = inputs[rows], goal[rows]
        a, b, c, d = weights
        hidden = np.maximum(x @ a + b, 0)
        z = hidden @ c + d
        z = np.exp(z - z.max(axis=1, keepdims=True))
        error = (z / z.sum(axis=1, keepdims=True) - y) / len(rows)
        back = (error @ c.T) * (hidden > 0)
        for w, g, m, v in zip(weights, (x.T @ back, back.sum(0), hidden.T @ error, error.sum(0)), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.01 * (1 - (step - 1) / STEPS) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    where = router.scores(vectors).argmax(axis=1)
    truth = nearest(vectors[held], vectors, k, held)
    visited = np.argsort(-router.scores(vectors[held]), axis=1, kind="stable")
    rank = np.argsort(visited, axis=1)  # of each part in a query's order
    needed = np.take_along_axis(rank, where[truth], 1).ravel()
    reached = np.cumsum(np.bincount(needed, minlength=parts)) / max(len(needed), 1)
    router.visits = int(np.searchsorted(reached, recall)) + 1 if len(needed) else parts
    router.visits = min(router.visits, parts)
    return router


def _usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Rows with an id and a vector of the usual length with finite components, not all of them 0; and that length."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(
        finite & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = sizes["size"] if sizes else 0
    return rows.where(F.size("embedding") == size), size


def _matrix(column: pa.ListArray) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy().reshape(len(column), width)


def nearest_neighbours(vectors: DataFrame, every: int, k: int, sample: int = SAMPLE, parts: int = PARTS,
                       recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """The k nearest of each query found: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``vectors`` has ``vec_id`` and ``embedding``; queries are the rows whose vec_id is divisible by ``every``, candidates all
    rows but the query's own. Nearness is the largest inner product of the original vectors in double precision, ties go
    to the smaller vec_id. Vectors that are missing, zero, hold missing or non-finite components, have no id or another
    length than most take no part. Rows that repeat a vec_id count once, with their best score. Fewer candidates than k
    give fewer rows, an empty table none; other columns are ignored. Every vector is indexed; fitting sees at most
    ``2 * sample``.
    """
    spark = vectors.sparkSession
    rows, width = _usable(small_batches(vectors))
    taken = hash_sample(rows, sample, "vec_id").orderBy("vec_id").select("embedding").toArrow()
    fitted = _matrix(taken["embedding"].combine_chunks()) if taken.num_rows else np.zeros((0, max(width, 1)))
    router = spark.sparkContext.broadcast(fit_router(fitted, k, parts, recall))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = router.value.scores(_matrix(batch.column("embedding"))) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores.argmax(axis=1), pa.int32())], names=["vec_id", "embedding", "part"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = router.value.scores(_matrix(batch.column("embedding"))) if batch.num_rows else np.zeros((0, 1))
            visits = np.argsort(-scores, axis=1, kind="stable")[:, :router.value.visits]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(visits.tolist(), pa.list_(pa.int32()))], names=["vec_id", "embedding", "parts"])

    index = frozen(rows.mapInArrow(assign, "vec_id long, embedding array<double>, part int"), "vector-index")
    # Large parts are dealt out in blocks, and a query visits all blocks of its parts.
    blocks = index.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    stored = index.join(blocks, "part").select(
        "part", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), F.lit(0).alias("role"), "vec_id", "embedding")
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]).mapInArrow(
        route, "vec_id long, embedding array<double>, parts array<int>")
    asked = queries.select("vec_id", "embedding", F.explode("parts").alias("part")).join(blocks, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "vec_id", "embedding")
    dealt = stored.union(asked).repartition("part", "block").sortWithinPartitions("part", "block", "role")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, held = None, [], []
        for batch in batches:
            part, number, role = (batch.column(x).to_numpy() for x in ("part", "block", "role"))
            names, matrix = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"))
            change = np.flatnonzero((part[1:] != part[:-1]) | (number[1:] != number[:-1]) | (role[1:] != role[:-1])) + 1
            edges = [0, *change.tolist(), len(part)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low == high:
                    continue
                if key != (part[low], number[low]):
                    key, ids, held = (part[low], number[low]), [], []
                if role[low] == 0:
                    ids.append(names[low:high].copy())
                    held.append(matrix[low:high].copy())
                elif held:
                    ids, held = [np.concatenate(ids)], [np.concatenate(held)]
                    for at in range(low, high, 256):
                        yield _best(names[at:min(at + 256, high)], matrix[at:min(at + 256, high)], ids[0], held[0], k)

    found = dealt.mapInArrow(rank, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _best(names: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best of a block for each query. A fast product finds candidates with a margin for its rounding; their scores
    are then summed in one fixed order, so that equal vectors have equal scores wherever they are."""
    products = queries @ vectors.T
    products[names[:, None] == ids[None, :]] = -np.inf
    size = min(k, len(ids))
    # Repeated ids take places, so look at the k-th best among distinct ids only if there are repeats.
    extra = len(ids) - len(np.unique(ids))
    size = min(size + extra, len(ids))
    floor = -np.partition(-products, size - 1, axis=1)[:, size - 1]
    margin = 1e-9 * (1 + np.abs(np.where(np.isfinite(floor), floor, 0)))
    margin += 1e-12 * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max(initial=0)
    out: list[list[np.ndarray]] = [[], [], []]
    for i, name in enumerate(names):
        near = np.flatnonzero((products[i] >= floor[i] - margin[i]) & (products[i] > -np.inf))
        scores = np.add.reduce(np.ascontiguousarray(vectors[near] * queries[i]), axis=1)
        order = np.lexsort((ids[near], -scores))
        if extra:
            _, firsts = np.unique(ids[near][order], return_index=True)
            order = order[np.sort(firsts)]
        order = order[:k]
        out[0].append(np.full(len(order), name))
        out[1].append(ids[near][order])
        out[2].append(scores[order])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["query_id", "vec_id", "score"])
