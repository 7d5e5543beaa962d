"""Runs of words: maximal stretches that repeat a period, by uniting suffix classes in the order of decreasing common prefixes.

A run has the smallest period q, at least LEAST words and TIMES * q words, and no neighbouring word goes on with it. In each text:

1. Suffixes that share their first SEED words with another are ordered (ranks of 5 words, doubled from round to round among suffixes that still
   tie), and the common prefix (LCP) of neighbours in that order is taken. All other suffixes can't begin a run, as the starts of a run's first two
   periods share LEAST - 1 words at least.
2. Kruskal: neighbours are united by decreasing LCP. A class is a union-find tree with its positions in order; the smaller set goes into the larger.
3. When all unions of a level are done, positions i < j that are newly neighbours in a set, at a distance d = j - i within the LCP, seed the run that begins
   at i, with the period d and d + LCP words. d is the smallest period, as a multiple's ends have a position between them in their class;
   the seed is a run if the words before i and j differ, and those after both prefixes.

Texts are independent, so one Arrow batch is worked on after the other, without a shuffle; a text needs memory in proportion to its own words. Most texts have no
SEED words twice, which their hashes tell; words are compared themselves in the others.

Nulls and texts without words have no runs. Repeated rows, ties (of length, settled by start and period), empty tables and null ids need no care: a row in gives a row out.
Long texts are worked on whole. Extra columns are kept, whatever their names; columns named as a result are replaced by it.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import beside, table
from tessera.llm.shingles import shingle_set, word_hashes

#: Words and periods of a run, at least.
LEAST, TIMES = 6, 4
#: Words that the starts of a run's first two periods have in common, at least.
SEED = LEAST - 1
RESULT = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,kept:string>"
Run = tuple[int, int, int]


class Positions:
    """Numbers in order, in blocks, so that neighbours are found and numbers added in a time that hardly grows with their count."""

    BLOCK = 1024

    def __init__(self, one: int) -> None:
        self.blocks, self.firsts, self.count = [[one]], [one], 1

    def add(self, x: int) -> None:
        at = max(bisect_left(self.firsts, x) - 1, 0)
        block = self.blocks[at]
        insort(block, x)
        self.firsts[at] = block[0]
        self.count += 1
        if len(block) > 2 * self.BLOCK:
            self.blocks[at : at + 1] = [block[: self.BLOCK], block[self.BLOCK :]]
            self.firsts[at : at + 1] = [block[0], block[self.BLOCK]]

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The numbers before and after x, which is one of them."""
        at = bisect_left(self.firsts, x)
        at -= at == len(self.firsts) or self.firsts[at] != x
        block = self.blocks[at]
        i = bisect_left(block, x)
        before = block[i - 1] if i else self.blocks[at - 1][-1] if at else None
        after = block[i + 1] if i + 1 < len(block) else self.firsts[at + 1] if at + 1 < len(self.firsts) else None
        return before, after


def _dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].reshape(-1)


def ordered_suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of suffixes that share SEED words with another, in the order of suffixes; whether each begins a class of SEED words)."""
    n = len(ids)
    # a place past the end is smaller than any word
    name, width = np.append(ids + 1, np.zeros(SEED, dtype=np.int64)), 1
    while width < SEED:
        step = min(width, SEED - width)
        later = np.append(name[step:], np.zeros(step, dtype=np.int64))
        name, width = _dense(name * (len(name) + 1) + later), width + step
    name = name[:n]
    order = np.argsort(name, kind="stable")
    new = np.append(True, np.diff(name[order]) != 0)
    starts = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    group = rank.copy()
    several = np.bincount(rank, minlength=n)[rank] > 1
    active = np.flatnonzero(several)
    while len(active):
        later = np.where(active + width < n, rank[np.minimum(active + width, n - 1)] + 1, 0)
        order = np.lexsort((later, rank[active]))
        active, later = active[order], later[order]
        old = rank[active]
        new_group = np.append(True, np.diff(old) != 0)
        new = new_group | np.append(True, np.diff(later) != 0)
        at = np.arange(len(active))
        of_group, of_new = (np.maximum.accumulate(np.where(x, at, 0)) for x in (new_group, new))
        rank[active] = old + of_new - of_group
        alone = new & np.append(new[1:], True)
        active, width = active[~alone], width * 2
    some = np.flatnonzero(several)
    some = some[np.argsort(rank[some])]
    return some, np.append(True, np.diff(group[some]) != 0)[: len(some)]


def common_prefixes(ids: list[int], order: np.ndarray, new: np.ndarray) -> list[int]:
    """For each suffix of `order`, the words that it shares with the one before; 0 where a class begins."""
    n = len(ids)
    place = np.argsort(order)
    before = np.where(new, -1, np.append(-1, order[:-1]))
    shared, h = np.zeros(len(order), dtype=np.int64), 0
    for i, j, at in zip(order[place].tolist(), before[place].tolist(), place.tolist(), strict=True):
        if j < 0:
            h = 0
            continue
        # one word less than the suffix that began a word before, or what makes the class
        h = max(h - 1, SEED)
        while i + h < n and j + h < n and ids[i + h] == ids[j + h]:
            h += 1
        shared[at] = h
    return shared.tolist()


def runs_of(ids: np.ndarray) -> list[Run]:
    """(start, length, period) of the runs of a sequence of word numbers, by start and period."""
    if len(ids) < LEAST:
        return []
    order, new = ordered_suffixes(ids)
    if not len(order):
        return []
    words, n = ids.tolist(), len(ids)
    shared, order = common_prefixes(words, order, new), order.tolist()
    parent, sets = list(range(len(order))), [None] * len(order)
    place = {p: k for k, p in enumerate(order)}

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    found: set[Run] = set()
    unions = sorted((k for k in range(len(order)) if shared[k]), key=lambda k: -shared[k])
    for level, group in groupby(unions, key=lambda k: shared[k]):
        moved = []
        for k in group:
            ra, rb = root(k - 1), root(k)
            a, b = (sets[r] or Positions(order[r]) for r in (ra, rb))
            if a.count < b.count:
                a, b, ra, rb = b, a, rb, ra
            parent[rb], sets[ra], sets[rb] = ra, a, None
            for block in b.blocks:
                moved += block
                for x in block:
                    a.add(x)
        for x in moved:
            before, after = sets[root(place[x])].around(x)
            for i, j in ((before, x), (x, after)):
                if i is None or j is None or (d := j - i) * (TIMES - 1) > level or d + level < LEAST:
                    continue
                # not newly neighbours if more is shared; no run if it begins before
                if (j + level < n and words[i + level] == words[j + level]) or (i and words[i - 1] == words[j - 1]):
                    continue
                found.add((i, d + level, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


def rewritten(words: list[bytes], number: int) -> list[bytes]:
    """words with a tail that repeats: from the place a on, word i is word a + (i - a) % p, with a and p made from `number`."""
    n = len(words)
    if not n:
        return words
    a = number % n
    p = 1 + (n - a) // (3 + number % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words, joined by blanks, without what runs hold after their first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    drop = np.cumsum(gone)[:-1] > 0
    return b" ".join(w for w, d in zip(words, drop.tolist(), strict=True) if not d) if drop.any() else b" ".join(words)


def periodic(text: Column, tail: Column | None = None) -> Column:
    """struct of n_words, runs (start, length, period; words numbered from 0, by start and period) and kept: the words without repeats, joined by one blank.

    tail: a number for texts whose words are to be rewritten() first, null for others."""

    @F.arrow_udf(RESULT)
    def found(texts: pa.Array, tails: pa.Array) -> pa.Array:
        numbers, runs, kept = [], [], []
        for value, number, hashes in zip(texts, tails, word_hashes(texts), strict=True):
            words = value.as_buffer().to_pybytes().split() if value.is_valid else []
            if number.is_valid:
                words, own = rewritten(words, number.as_py()), None
            else:
                own = hashes
            numbers.append(len(words))
            if own is not None and (len(own) < LEAST or len(shingle_set(own, SEED)) == len(own) - SEED + 1):
                runs.append([])
            else:
                ids: dict[bytes, int] = {}
                runs.append(runs_of(np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))))
            kept.append(collapsed(words, runs[-1]))
        flat = np.array([r for x in runs for r in x], dtype=np.int64).reshape(-1, 3)
        each = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
        ends = np.append(0, np.cumsum([len(x) for x in runs])).astype(np.int32)
        return pa.StructArray.from_arrays([pa.array(numbers, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), each), pa.array(kept, pa.binary()).cast(pa.string())], names=["n_words", "runs", "kept"])

    return found(text, F.lit(None).cast("long") if tail is None else tail)


def with_runs(documents: DataFrame, tail: Column | None = None) -> DataFrame:
    """documents with n_words, runs and kept, as periodic() gives them."""
    packed = documents.select(F.struct("*").alias("row"), periodic(F.col("text"), tail).alias("found"))
    return packed.select(*beside(documents, "n_words", "runs", "kept"), "found.*")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the words that stay. Of documents, those whose id's CRC is a multiple of ten get a tail that repeats; null ids don't."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = with_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), F.when(crc % 10 == 0, F.floor(crc / 10)))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("longest.length * 1000 div -longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )
