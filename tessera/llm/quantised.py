"""Approximate nearest neighbours by additive quantisation.

A vector is coded as a sum of BOOKS codewords, one of each codebook. Codebooks span all dimensions and are learned one after another, by k-means on
the residuals of a bounded sample. Encoding keeps a beam of the best partial sums. With the code, the ratio of the norms of the vector and of its
reconstruction is stored, and the length of what the scaled reconstruction leaves. A query has a table of its products with all codewords; a row's
estimate is the sum of BOOKS entries, scaled by the stored ratio. The best RERANK rows of each shard, and PROBES others, are scored exactly on the
original vectors. They tell how far estimates of this query are off, for what is left of a row: every row that could be among the k best if its own
were SPREAD times as far off (at most by the query's norm times what is left, which is certain) is scored exactly, too, until none is left. Where codes
say little, more rows are scored; no number of them is a limit.

Every row is coded and searched; only the codebooks rest on a sample (the SAMPLE rows of the smallest hash of their id).
tests/llm measures recall against brute force.

Nulls: rows without an id or vector, with a null or non-finite component, and zero vectors take no part. Vectors of another length than
most of the sample's are searched exactly, among their like. Repeated rows count once; a query never finds its own id; ties go to the smaller id,
also among equal codes. Empty tables give empty results. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table, written
from tessera.llm.shards import BLOCK_ROWS, SHARD_ROWS, clean_vectors, distinct_rows, found_table, matrix, number, on_grid, ranked, with_shard

BOOKS, WORDS, BEAM = 24, 64, 4
SAMPLE = 8192
RERANK = 100
#: Rows of a shard, at even distances, that show how far estimates are off besides the best.
PROBES = 64
SPREAD = 6.0
FOUND = "query_id long, vec_id long, score double"
_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


@dataclass
class Codebooks:
    words: np.ndarray  # books, words, dimensions

    @property
    def dims(self) -> int:
        return self.words.shape[2]

    def encode(self, vectors: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(codes, reconstructions) by beam search: after each codebook, the `beam` sums that come closest."""
        codes, sums = np.zeros((len(vectors), 1, 0), dtype=np.uint8), np.zeros((len(vectors), 1, self.dims))
        at = np.arange(len(vectors))[:, None]
        for words in self.words:
            left = vectors[:, None, :] - sums
            cost = (left**2).sum(2)[:, :, None] - 2 * left @ words.T + (words**2).sum(1)
            best = np.argsort(cost.reshape(len(vectors), -1), axis=1)[:, :beam]
            parent, word = best // len(words), best % len(words)
            codes = np.concatenate([codes[at, parent], word[:, :, None].astype(np.uint8)], axis=2)
            sums = sums[at, parent] + words[word]
        return codes[:, 0], sums[:, 0]


def learn(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 8, seed: int = 3) -> Codebooks:
    """Codebooks by k-means on what the earlier ones leave."""
    random, left, learned = np.random.default_rng(seed), sample.copy(), []
    for _ in range(books):
        centre = left[random.choice(len(left), words, replace=len(left) < words)].copy()
        for _ in range(rounds):
            near = ((centre**2).sum(1) - 2 * left @ centre.T).argmin(1)
            count = np.bincount(near, minlength=words)
            sums = np.zeros_like(centre)
            np.add.at(sums, near, left)
            centre[count > 0] = sums[count > 0] / count[count > 0, None]
        left = left - centre[((centre**2).sum(1) - 2 * left @ centre.T).argmin(1)]
        learned.append(centre)
    return Codebooks(np.array(learned))


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vectors with code (binary), scale (norm over the reconstruction's norm) and rest (norm of the vector without its scaled reconstruction) of the rows of the codebooks' length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, len(whole), 1024)):
                codes: list[bytes | None] = [None] * len(batch)
                scale, rest = np.ones(len(batch)), np.zeros(len(batch))
                fit = np.flatnonzero(batch.column("dims").to_numpy(zero_copy_only=False) == books.dims)
                if len(fit):
                    x = matrix(batch.column("vector").take(pa.array(fit)), books.dims)
                    found, sums = books.encode(x)
                    scale[fit] = np.sqrt((x**2).sum(1) / np.maximum((sums**2).sum(1), 1e-300))
                    rest[fit] = np.sqrt(((x - sums * scale[fit, None]) ** 2).sum(1))
                    for i, code in zip(fit, found, strict=True):
                        codes[i] = code.tobytes()
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(scale), pa.array(rest)], names=["vec_id", "vector", "dims", "code", "scale", "rest"])

    return vectors.select("vec_id", "vector", "dims").mapInArrow(rows, "vec_id long, vector array<double>, dims int, code binary, scale double, rest double")


def _best(scores: np.ndarray, most: int) -> np.ndarray:
    """Rows of the `most` highest scores; of equal ones at the border, the first."""
    if len(scores) <= most:
        return np.arange(len(scores))
    border = np.partition(scores, len(scores) - most)[len(scores) - most]
    above, equal = np.flatnonzero(scores > border), np.flatnonzero(scores == border)
    return np.concatenate([above, equal[: most - len(above)]])


def _candidates(estimate: np.ndarray, rest: np.ndarray, points: np.ndarray, query: np.ndarray, can: np.ndarray, slack: np.ndarray, k: int, rerank: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of all rows that `can` be found and may be among the k best. Estimates that aren't numbers count as best."""
    estimate = np.where(can, np.where(np.isnan(estimate), np.inf, estimate), -np.inf)
    open_ = can.copy()
    rows = np.union1d(_best(estimate, max(rerank, k)), np.arange(0, len(can), max(1, len(can) // PROBES)))
    rows = rows[can[rows]]
    scores = np.empty(0)
    chosen = np.empty(0, dtype=np.int64)
    size = np.sqrt(query @ query)
    while len(rows):
        open_[rows] = False
        chosen, scores = np.append(chosen, rows), np.append(scores, points[rows] @ query)
        if len(chosen) < k:
            rows = np.flatnonzero(open_)
            continue
        border = np.partition(scores, len(scores) - k)[len(scores) - k]
        told = rest[chosen] > 0
        off = (scores[told] - estimate[chosen[told]]) / rest[chosen[told]]
        # the best and the others by themselves, as either may be off in a way of its own
        high = scores[told] >= border
        spread = max((np.sqrt((x**2).mean()) for x in (off, off[high]) if len(x)), default=0.0)
        reach = np.minimum(SPREAD * spread, size) * rest + size * slack if np.isfinite(spread) else size * rest + size * slack
        rows = np.flatnonzero(open_ & ~(estimate + reach < border))
    return chosen, scores


def _search(books: Codebooks | None, k: int, rerank: int):
    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        if not len(shard) or not len(block):
            return _SCHEMA.empty_table()
        dims = shard.column("dims")[0].as_py()
        points, queries = matrix(shard.column("vector"), dims), matrix(block.column("vector"), dims)
        ids = shard.column("vec_id").to_numpy()
        order = distinct_rows(ids, points)
        points, ids = points[order], ids[order]
        if books is not None and dims == books.dims:
            codes = np.frombuffer(b"".join(shard.column("code").to_pylist()), dtype=np.uint8).reshape(len(shard), -1)[order]
            scale, rest = (shard.column(c).to_numpy()[order] for c in ("scale", "rest"))
            slack = 1e-12 * dims * np.sqrt((points**2).sum(1))  # rounding of sums of products
            books_at = [np.ascontiguousarray(codes[:, m]) for m in range(codes.shape[1])]
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for i, own in enumerate(block.column("query_id").to_pylist()):
            if books is not None and dims == books.dims:
                lookup = books.words @ queries[i]
                estimate = sum(t[c] for t, c in zip(lookup, books_at, strict=True)) * scale
                chosen, scores = _candidates(estimate, rest, points, queries[i], ids != own, slack, k, rerank)
            else:
                chosen = np.flatnonzero(ids != own)
                scores = points[chosen] @ queries[i]
            top = np.lexsort((ids[chosen], -scores))[:k]
            out.append((own, ids[chosen[top]], scores[top]))
        return found_table(out, _SCHEMA)

    return search


def nearest(vectors: DataFrame, every: int, k: int, rerank: int = RERANK, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of vectors (vec_id, vector, dims) whose id is divisible by `every`, the k best found."""
    taken = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector", "dims").collect()
    books = None
    if taken:
        sizes = [r["dims"] for r in taken]
        usual = max(set(sizes), key=lambda d: (sizes.count(d), d))
        if usual:
            books = learn(np.array([r["vector"] for r in taken if r["dims"] == usual]))
    index = written(coded(vectors, books) if books is not None else vectors.withColumn("code", F.lit(None).cast("binary")).withColumn("scale", F.lit(1.0)).withColumn("rest", F.lit(0.0)))
    asked = index.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "vector", "dims").dropDuplicates(["query_id", "vector"])
    shards, blocks = number(index.count(), shard_rows), number(asked.count(), block_rows)
    return ranked(on_grid(with_shard(index, shards), asked, shards, blocks, _search(books, k, rerank), FOUND), k)


def op9_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(clean_vectors(table(spark, sf_dir, "embeddings"), allow_zero=False), every=20, k=20)
