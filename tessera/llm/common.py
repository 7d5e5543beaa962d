"""Shared helpers of the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch, written  # noqa: F401  the operators take them from here

#: What separates words in the operators that count or shingle words: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of rows that a Python worker is given at once, or one row if that is longer.
BATCH = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_bytes(setting: str) -> int:
    """A size as Spark writes it, such as 64m or 512kb."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)(?:i?b)?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def tidy(spark: SparkSession) -> SparkSession:
    """Have Spark drop a job's shuffle files when its result is written, not when the driver collects its garbage. Operators of many
    steps call this first, so that they need disk for their largest step, not for the sum of all. Python workers get rows by BATCH bytes (or what
    the session has, if less), as executors and workers hold some batches for each task, and keep that memory."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if in_bytes(spark.conf.get(limit)) > BATCH:
        spark.conf.set(limit, BATCH)
    return spark


def beside(df: DataFrame, *results: str, row: str = "row") -> list[Column]:
    """The columns of df out of the struct `row` (of all of them), but for those that have the name of a result: a result replaces them.
    Operators pack rows that way, so that columns of theirs may have any name."""
    own = {r.lower() for r in results}
    return [F.col(row).getField(c).alias(c) for c in df.columns if c.lower() not in own]


def text_buffers(texts: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, offsets) of runs of whole texts, without a copy. A run has `limit` bytes,
    or is one text if that is longer. Null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        yield row, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer for 64-bit hashes: every input bit reaches every output bit. Works in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_table(seed: int) -> np.ndarray:
    """A random 64-bit number for each byte value; the same on every machine."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def lower_ascii(column):
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
