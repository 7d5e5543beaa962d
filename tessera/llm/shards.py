"""What the vector searches share: clean vectors, a grid of shards and query blocks, and the merge of partial results.

Every shard of the table meets every block of queries in a task of its own, so memory is bounded by the sizes of a shard and
a block. Rows are dealt to shards by a hash of their id, so repeated rows meet in one shard, where they count once, and equal
vectors under many ids spread over all shards."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Every vector is shuffled once for each block of queries and every query once for each shard, so both are as large as a task's memory allows.
SHARD_ROWS = 16384
BLOCK_ROWS = 16384


def clean_vectors(table: DataFrame, allow_zero: bool = True) -> DataFrame:
    """vec_id, vector (array<double>), dims: rows with an id and a vector of finite components only."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector")).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & good)
    return (rows if allow_zero else rows.where(F.exists("vector", lambda v: v != 0))).withColumn("dims", F.size("vector"))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(flat), dims)


def distinct_rows(ids: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Places of the different (id, vector) rows, by id. Compared as bytes, as ids have more digits than doubles."""
    if len(np.unique(ids)) == len(ids):
        return np.argsort(ids)
    raw = np.column_stack([ids.astype(np.int64).view(np.uint8).reshape(len(ids), 8), (points + 0.0).view(np.uint8).reshape(len(ids), -1)])
    _, first = np.unique(np.ascontiguousarray(raw).view(f"V{raw.shape[1]}").ravel(), return_index=True)
    return first[np.argsort(ids[first], kind="stable")]


def found_table(parts: list[tuple[int, np.ndarray, np.ndarray]], schema: pa.Schema) -> pa.Table:
    """The rows (query_id, vec_id, score) of what each query has found."""
    if not parts:
        return schema.empty_table()
    asked = np.repeat(np.array([p[0] for p in parts], dtype=np.int64), [len(p[1]) for p in parts])
    return pa.Table.from_arrays([pa.array(asked), pa.array(np.concatenate([p[1] for p in parts]), pa.int64()), pa.array(np.concatenate([p[2] for p in parts]), schema.field("score").type)], schema=schema)


def number(count: int, size: int) -> int:
    return max(1, -(-count // size))


def on_grid(vectors: DataFrame, queries: DataFrame, shards: int, blocks: int, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """search(shard rows, query rows) for every shard and block of vectors of one length; shard: a column of `vectors`."""
    left = vectors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit("block")), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["shard", "block", "dims"]
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # both may come from one table
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def with_shard(vectors: DataFrame, shards: int) -> DataFrame:
    return vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of partial results, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def sized(vectors: DataFrame) -> tuple[DataFrame, int]:
    kept = written(vectors)
    return kept, kept.count()
