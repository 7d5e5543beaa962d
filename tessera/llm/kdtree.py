"""Exact top-k search by inner product with a KD-tree in every shard.

Vectors are split at the median of the dimension in which they spread most until a leaf is small; each node keeps the tight box around
its vectors. The largest inner product of a query with a box is the sum, over dimensions, of the larger of its products with the
two bounds. Nodes are visited best bound first, and no node is entered whose bound is under the k-th best score known. That score is
propagated: one shard is searched first, and its k-th scores are given to the searches of all others.

Nulls: rows without an id, without a vector, or with a null or non-finite component take no part, as query or
candidate. Vectors of different lengths aren't compared. Repeated rows (same id and vector) count once; of ids with several vectors each
counts, and a query never finds its own id. Scores beyond a long's range are given as its ends. Ties go to the smaller id. Empty tables give empty results. Extra columns don't matter.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table, written
from tessera.llm.shards import BLOCK_ROWS, SHARD_ROWS, clean_vectors, distinct_rows, found_table, matrix, number, on_grid, ranked, sized, with_shard

LEAF = 256
SCALE = 256
FOUND = "query_id long, vec_id long, score long"
_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Tree:
    """A KD-tree over the rows of a matrix; `order` lists rows so that each node's are a slice."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.slices: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        low, high = [], []
        waiting = [(0, len(points), -1)]
        while waiting:
            a, b, parent = waiting.pop()
            here, rows = len(self.slices), points[self.order[a:b]]
            low.append(rows.min(axis=0))
            high.append(rows.max(axis=0))
            self.slices.append((a, b))
            self.children.append(None)
            if parent >= 0:
                self.children[parent] = (*(self.children[parent] or ()), here)
            spread = high[-1] - low[-1]
            if b - a > leaf and spread.max() > 0:
                half = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(rows[:, spread.argmax()], half)]
                waiting += [(a, a + half, here), (a + half, b, here)]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that each query can have with each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def search_tree(tree: Tree, points: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, bounds: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows that reach `floor`. points and ids are in the tree's order."""
    best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=points.dtype)
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if -bound < floor:
            break
        if children := tree.children[node]:
            for child in children:
                if bounds[child] >= floor:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        a, b = tree.slices[node]
        scores = points[a:b] @ query
        good = np.flatnonzero(scores >= floor)
        if len(good):
            new = ids[a:b][good]
            other = new != own
            best_ids, best = np.concatenate([best_ids, new[other]]), np.concatenate([best, scores[good][other]])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            if len(best) == k:
                floor = max(floor, best[-1])
    return best_ids, best


def _search(k: int):
    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        if not len(shard) or not len(block):
            return _SCHEMA.empty_table()
        dims = shard.column("dims")[0].as_py()
        points, queries = matrix(shard.column("vector"), dims), matrix(block.column("vector"), dims)
        ids = shard.column("vec_id").to_numpy()
        unique = distinct_rows(ids, points)
        points, ids = points[unique], ids[unique]
        if not dims:
            points, queries, dims = np.zeros((len(points), 1)), np.zeros((len(queries), 1)), 1
        tree = Tree(points)
        points, ids = points[tree.order], ids[tree.order]
        bounds = tree.bounds(queries)
        if np.abs(points).max() * np.abs(queries).max() * dims >= 2.0**53:
            # beyond what doubles hold exactly: whole numbers without bounds on size, and bounds with room for rounding
            points, queries = np.vectorize(int, otypes=[object])(points), np.vectorize(int, otypes=[object])(queries)
            bounds = bounds + np.abs(bounds).max() * 1e-9
        floors = block.column("floor").to_pylist()
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for i, own in enumerate(block.column("query_id").to_pylist()):
            floor = -np.inf if floors[i] is None else floors[i]
            near, scores = search_tree(tree, points, ids, queries[i], own, bounds[i], k, floor)
            out.append((own, near, np.array([max(-(2**63), min(2**63 - 1, int(score))) for score in scores], dtype=np.int64)))
        return found_table(out, _SCHEMA)

    return search


def top_k(vectors: DataFrame, every: int, k: int, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of vectors (vec_id, vector, dims) whose id is divisible by `every`, the k best."""
    kept, count = sized(vectors)
    asked = kept.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "vector", "dims").dropDuplicates(["query_id", "vector"])
    shards, blocks = number(count, shard_rows), number(asked.count(), block_rows)
    dealt = with_shard(kept, shards)
    first = written(on_grid(dealt.where("shard = 0"), asked.withColumn("floor", F.lit(None).cast("long")), 1, blocks, _search(k), FOUND))
    if shards == 1:
        return ranked(first, k)
    known = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k).select("query_id", "floor")
    rest = on_grid(dealt.where("shard > 0"), asked.join(known, "query_id", "left"), shards, blocks, _search(k), FOUND)
    return ranked(first.unionByName(rest), k)


def scaled(vectors: DataFrame) -> DataFrame:
    """Components as whole numbers: floor(SCALE * x), as doubles. Doubles of 2^53 and more are whole as they are, and don't go through
    long; those beyond the largest double stay at it."""
    largest = 1.7976931348623157e308
    whole = lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(F.greatest(F.least(y, F.lit(largest)), F.lit(-largest)))
    return vectors.withColumn("vector", F.transform("vector", lambda x: whole(x * SCALE)))


def op6_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(scaled(clean_vectors(table(spark, sf_dir, "embeddings"))), every=50, k=5)
