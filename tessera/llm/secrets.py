"""Secrets in texts: fixed patterns, and dictionary-primed zstandard novelty for what follows a sensitive word.

Patterns give spans of the kinds `assign`, `access` and `hex`: leftmost matches that don't overlap others of the kind, of which those that are too short are dropped. The method adds
spans of the kind `novel`:

1. Identifiers. Over all documents, Spark counts in how many a word of an identifier's shape occurs; the DICTIONARY words of most documents are the dictionary, so it has at most
   DICTIONARY * 25 bytes however large the corpus is. What only a few documents have, such as a secret, isn't in it, nor are strings with digits or capitals inside.
2. Candidates: strings of CANDIDATE's characters, LEAST at least, with a letter and a digit, that begin within NEAR characters after a sensitive word and overlap no other span.
3. Novelty: bytes that the candidate adds when zstandard, primed with the dictionary, compresses it behind the AROUND characters on either side, for each byte of its own. Other
   places of the same string around it are taken out first. A word that the code or other code knows costs few bytes; from NOVELTY on, a string is reported. The spans of
   patterns are measured too (of `assign`, what is assigned) and stay whatever that gives.

Spans are in code points, the end exclusive. Nulls and empty texts have none. Repeated rows have the same spans; ties of words in the dictionary are settled by their bytes. Long texts are searched
whole. Empty tables give empty results. Extra columns are kept, whatever their names; a column named `spans` is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import beside, table, written

# The patterns of the kinds, and the least length of the part that counts.
PATTERNS = {
    "assign": (re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),  # the same as runs of any length of which those of 24 and more are taken
}
# Words after which a string may be a secret.
SENSITIVE = ("password", "passwd", "passphrase", "pwd", "secret", "token", "api_key", "apikey", "api-key", "auth", "bearer", "credential", "private_key", "access_key", "signature")
KINDS = (*PATTERNS, "novel")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
LEAST = 12
NEAR = 48
AROUND = 256
#: Added bytes for each byte of a string.
NOVELTY = 0.7
LEVEL = 19
DICTIONARY = 4096
#: Different words that a task counts before it hands them on.
HELD = 1 << 18
_AFTER = re.compile("(?ai:" + "|".join(SENSITIVE) + ")")
_STEMS = (b"passw", b"secret", b"token", b"api")
_MORE_STEMS = (b"passphrase", b"pwd", b"auth", b"bearer", b"credential", b"private_key", b"access_key", b"signature")
_LETTERS = bytes(x if x >= 128 or 65 <= x <= 90 or 97 <= x <= 122 else 32 for x in range(256))
Span = tuple[int, int, str, float]


def identifiers(documents: DataFrame, words: int = DICTIONARY) -> list[str]:
    """Words of 4 to 24 bytes, without capitals after the first letter, that most documents have; the most common first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            good = [w for w in found if 4 <= len(w) <= 24 and not any(65 <= x <= 90 for x in w[1:])]
            return pa.RecordBatch.from_arrays([pa.array(good, pa.binary()).cast(pa.string()), pa.array([found[w] for w in good], pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                found.update(set(text.as_buffer().to_pybytes().translate(_LETTERS).split()))
                if len(found) > HELD:
                    yield out()
                    found.clear()
        yield out()

    counts = written(documents.select("text").where("text is not null").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    # only words of the highest octaves are ordered, however many there are in all
    least, left = 0, words
    for octave, n in sorted(counts.groupBy(F.expr("cast(log2(n) as int)").alias("octave")).count().collect(), reverse=True):
        least, left = octave, left - n
        if left <= 0:
            break
    return [r["word"] for r in counts.where(F.col("n") >= 2**least).orderBy(F.desc("n"), "word").limit(words).collect()]


@lru_cache(maxsize=4)
def _primed(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
    if known:
        known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)


def novelty(candidate: str, around: str, dictionary: bytes) -> float:
    """Bytes that a candidate adds to what is around it, for each byte of its own."""
    coder = _primed(dictionary)
    before, own = around.replace(candidate, "").encode(), candidate.encode()
    return (len(coder.compress(before + own)) - len(coder.compress(before))) / len(own)


def measured(text: str, start: int, end: int, dictionary: bytes) -> float:
    return novelty(text[start:end], text[max(start - AROUND, 0) : start] + text[end : end + AROUND], dictionary)


def spans_of(raw: bytes, dictionary: bytes) -> list[Span]:
    """(start, end, kind, novelty) of a text in UTF-8, by start, then kind as listed."""
    text, low = raw.decode(), raw.lower()
    found: list[Span] = []
    for kind, (pattern, group, least) in PATTERNS.items():
        if kind != "assign" or any(w in low for w in _STEMS):
            found += [(*m.span(), kind, measured(text, *m.span(group), dictionary)) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    if any(w in low for w in _STEMS + _MORE_STEMS):
        found += novel_spans(text, sorted(x[:2] for x in found), dictionary)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def novel_spans(text: str, taken: list[tuple[int, int]], dictionary: bytes) -> Iterator[Span]:
    """Novel candidates that overlap no span of `taken`, which are in order."""
    starts = [s for s, _ in taken]
    furthest = list(accumulate((e for _, e in taken), max))
    upto = 0
    for word in _AFTER.finditer(text):
        # a string is tried once, though several words may stand before it
        begin = max(word.end(), upto)
        while (m := CANDIDATE.search(text, begin, word.end() + NEAR)) is not None:
            s, e = CANDIDATE.match(text, m.start()).span()
            begin = upto = e
            own = text[s:e]
            if e - s < LEAST or not re.search("[A-Za-z]", own) or not re.search("[0-9]", own):
                continue
            at = bisect_left(starts, e)
            if at and furthest[at - 1] > s:
                continue
            value = measured(text, s, e, dictionary)
            if value >= NOVELTY:
                yield s, e, "novel", value


def spans(text: Column, dictionary: bytes) -> Column:
    """array of (kind, start, end, novelty) of a text, by start, then kind."""

    @F.arrow_udf("array<struct<kind:string,start:long,end:long,novelty:double>>")
    def found(texts: pa.Array) -> pa.Array:
        lists = [spans_of(x.as_buffer().to_pybytes(), dictionary) if x.is_valid else [] for x in texts]
        flat = [x for one in lists for x in one]
        columns = [pa.array([x[k] for x in flat], kind) for k, kind in ((2, pa.string()), (0, pa.int64()), (1, pa.int64()), (3, pa.float64()))]
        ends = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, names=["kind", "start", "end", "novelty"]))

    return found(text)


def with_spans(documents: DataFrame) -> DataFrame:
    """documents with `spans`, as spans() gives them; the dictionary is made of all their texts."""
    dictionary = " ".join(reversed(identifiers(documents))).encode()
    packed = documents.select(F.struct("*").alias("row"), spans(F.col("text"), dictionary).alias("spans"))
    return packed.select(*beside(documents, "spans"), "spans")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of the patterns' spans, a digest of them, all spans, those of the method among them, and how many spans are incompressible."""
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = listed(F.filter("spans", lambda s: s["kind"] != "novel"))
    return found.select("doc_id", *map(of_kind, PATTERNS), F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"), F.size(F.filter("spans", lambda s: s["novelty"] >= NOVELTY)).cast("long").alias("n_incompressible"))
