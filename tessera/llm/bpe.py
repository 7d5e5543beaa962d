"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Nulls and empty texts encode to an empty list. Long texts are split where no match of the pattern can
cross (between a word character and a following blank), so that memory for one call stays bounded and
the ids are those of the whole text. Repeated rows, ties and extra columns don't matter: the operators
are column functions. Decoding works on bytes, as a token may end inside a character.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tessera.llm.common import table

#: Texts longer than this many characters are encoded in parts.
PART = 100_000
_SAFE = re.compile(r"(?<=[A-Za-z0-9.,;:!?])(?=[ \n])")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file, loaded once for each Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(f"ranks:{rank_file}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, part: int = PART) -> list[str]:
    """Parts of at least `part` characters (but the last) that no match of the pattern crosses. A text
    without such a place stays whole."""
    if len(text) <= part:
        return [text]
    parts, start = [], 0
    while len(text) - start > part and (cut := _SAFE.search(text, start + part)):
        parts.append(text[start : cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


def encode(text: Column, rank_file: str, pattern: str, part: int = PART) -> Column:
    """array<int>: the ordinary token ids of a text."""

    @arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        tokens = encoding(rank_file, pattern)
        ends, ids = np.zeros(len(texts) + 1, dtype=np.int32), []
        for row, value in enumerate(texts):
            found = [np.asarray(tokens.encode_ordinary(x), dtype=np.int32) for x in safe_parts(value.as_py() or "", part)]
            ends[row + 1] = ends[row] + sum(map(len, found))
            ids += found
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)))

    return ids_of(text)


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """binary: the bytes that token ids stand for; an empty list (or null) gives no bytes."""

    @arrow_udf("binary")
    def bytes_of(lists: pa.Array) -> pa.Array:
        tokens = encoding(rank_file, pattern)
        return pa.array([tokens.decode_bytes(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else []) for x in lists], type=pa.binary())

    return bytes_of(ids)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def digests(documents: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document. One row in, one row out."""
    coded = documents.select("doc_id", encode(F.col("text"), rank_file, pattern).alias("ids"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), rank_file, pattern), 256).alias("decoded_sha256"),
    )
