"""Removal of long repeats by bucket-pointer refinement over sampled suffixes.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else too, in the same text or another. Buckets of suffixes are refined
only where they hold more than one, and all of one step's buckets are refined by one sort of Spark's:

1. Initial buckets. The q-gram at a place (q = GRAM) names its bucket. Comparing all suffixes would shuffle many times the input, so suffixes
   are sampled by content: every string of LENGTH bytes picks the place of its smallest q-gram, so equal strings pick the same one at the same offset.
   Neighbouring strings that pick the same place are one block (one in 67 bytes begins one), and a bucket holds the blocks of a q-gram. Equal blocks of
   a text are one row with a count, so that texts of a short period, or of one line, give few. Buckets of one block are final: nothing in them repeats.
2. Classes. Members of a bucket that agree over all their bytes are a class. All strings of a class of several members repeat, and one
   member goes on for all. Buckets of one class are final.
3. Refinement. Members are sorted on their bucket's identifier and the bucket identifiers of q-grams at later offsets (and earlier ones, as a sampled suffix
   stands for strings that begin before it): a range of offsets is cut into ranges of WIDTHS[0], then of WIDTHS[1]. All strings of a range share a core;
   the q-grams that take the core of the bucket to that of the range give the refined bucket, whose identifier the next round uses in place of the
   old one. Each round takes classes again, and only buckets of several go on. In the last, a range is one string of LENGTH bytes.

Bucket identifiers are 64-bit numbers made from content, not places in an array, as no task sees all buckets. Two strings are taken for equal by mistake with a
probability of 2^-64 for each pair in a bucket. Counts are summed before they are shuffled, no bucket is gathered in one task, and joins on
buckets are ones whose hot keys Spark splits.

Texts are known by their MD5, so that exact copies have one set of spans. Null texts are empty, texts shorter than LENGTH keep all bytes,
null or repeated doc_ids don't matter, and repeated rows count as other texts do. Long texts are worked on in parts of bounded
size. Empty tables give empty results. Extra columns are kept, whatever their names; columns named as a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import beside, byte_table, table, text_buffers, tidy, written

LENGTH = 200
#: Of two q-grams side by side, each step of a refinement takes in as many bytes as it needs at most: LENGTH - GRAM <= 2 * GRAM.
GRAM = 68
#: Ranges of offsets of a q-gram in its strings (there are LENGTH - GRAM + 1), round by round.
WIDTHS = (12, 1)
#: String starts that are worked on at once; with what they look ahead, less than 2^16.
PART = 1 << 15
#: Pieces whose ranges are worked on at once; each gives LENGTH - GRAM + 1 rows at most.
PIECES = 1000
_M = byte_table(7) | np.uint64(1)
_LOW = np.uint64(0xFFFF)


def _joined(left: np.ndarray, right: np.ndarray, turn: int) -> np.ndarray:
    """Identifiers of two strings at a fixed distance, as one."""
    both = left * _M[2 * turn]
    both += right * _M[2 * turn + 1]
    both ^= both >> np.uint64(29)
    both *= _M[2 * turn + 40]
    both ^= both >> np.uint64(32)
    return both


def identifiers(raw: np.ndarray) -> dict[int, np.ndarray]:
    """For GRAM and LENGTH bytes: the identifier of the string at each place that has so many bytes. Eight bytes name themselves; 2k bytes are
    named from k bytes there and at the offset k."""
    word = raw.astype(np.uint64)
    for k in (1, 2, 4):
        word = word[:-k] | (word[k:] << np.uint64(8 * k))
    found, k = word, 8
    kept = {}
    while k < 128:
        found = _joined(found[:-k], found[k:], k.bit_length())
        k *= 2
        if k == 64:
            kept[GRAM] = _joined(found[: len(found) - (GRAM - 64)], found[GRAM - 64 :], 8)
    kept[LENGTH] = _joined(found[: len(found) - (LENGTH - 128)], found[LENGTH - 128 :], 9)
    return kept


def _smallest(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours."""
    k = 1
    while 2 * k <= width:
        key = np.minimum(key[:-k], key[k:])
        k *= 2
    return np.minimum(key[: len(key) - (width - k)], key[width - k :]) if width > k else key


def blocks_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(low, high, place, gram, name) of the blocks of texts that lie one after the other in `raw`: first and last start of a
    run of strings that pick the same q-gram, its place, its identifier, and the block's."""
    total = len(raw) - LENGTH + 1
    ends = offsets[1:] - LENGTH + 1
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, max(total, 0), PART):
        low, high = max(begin - 1, 0), min(begin + PART + 1, total)
        part = raw[low : high + LENGTH - 1]
        ids = identifiers(part)
        grams = ids[GRAM]
        at = np.arange(len(grams), dtype=np.uint64)
        pick = (_smallest((grams & ~_LOW) | at, LENGTH - GRAM + 1) & _LOW).astype(np.int64)
        starts = np.arange(low, high)
        text = np.searchsorted(offsets, starts, side="right") - 1
        valid = starts < ends[text]
        same = (pick[1:] == pick[:-1]) & valid[1:] & valid[:-1]
        first, last = valid.copy(), valid.copy()
        first[1:] &= ~same
        last[:-1] &= ~same
        own = (starts >= begin) & (starts < begin + PART)
        lows, highs = np.flatnonzero(first & own), np.flatnonzero(last & own)
        found.append((lows + low, ids[LENGTH][lows], pick[lows] + low, grams[pick[lows]], highs + low, ids[LENGTH][highs]))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    low, low_id, place, gram, high, high_id = (np.concatenate(x) for x in zip(*found, strict=True))
    name = _joined(low_id, high_id, 11) ^ ((high - low).astype(np.uint64) * _M[31])
    return low, high, place, gram.view(np.int64), name.view(np.int64)


def _lists(values: np.ndarray, starts: np.ndarray, some: np.ndarray) -> pa.Array:
    """Lists of values that begin at `starts`; null but for some."""
    sizes = np.diff(np.append(starts, len(values)))
    ends = np.append(0, np.cumsum(np.where(some, sizes, 0)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[np.repeat(some, sizes)], pa.int64()), mask=pa.array(~some))


def block_rows(documents: DataFrame) -> DataFrame:
    """key (of the text), gram, name, times, low, high, place, lows, highs: the different blocks of every text, with the number of blocks
    that are equal, one of them, and the runs of starts that they cover if there are several blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for row, raw, offsets in text_buffers(batch.column("text")):
                low, high, place, gram, name = blocks_of(raw, offsets)
                if not len(low):
                    continue
                text = np.searchsorted(offsets, low, side="right") - 1
                order = np.lexsort((low, name, gram, text))
                low, high, place, gram, name, text = (x[order] for x in (low, high, place, gram, name, text))
                new = np.ones(len(low), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]) | (name[1:] != name[:-1])
                run = new.copy()
                run[1:] |= low[1:] != high[:-1] + 1
                first, begin = np.flatnonzero(new), np.flatnonzero(run)
                end = np.append(begin[1:], len(low)) - 1
                at = offsets[text]
                runs = np.searchsorted(begin, first)
                numbers = [gram[first], name[first], np.diff(np.append(first, len(low))), (low - at)[first], (high - at)[first], (place - at)[first]]
                arrays = [keys.take(pa.array(row + text[first], pa.int64())), *(pa.array(x.astype(np.int64), pa.int64()) for x in numbers), _lists((low - at)[begin], runs, numbers[2] > 1), _lists((high - at)[end], runs, numbers[2] > 1)]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "gram", "name", "times", "low", "high", "place", "lows", "highs"])

    return documents.select("key", "text").mapInArrow(rows, "key binary, gram long, name long, times long, low long, high long, place long, lows array<long>, highs array<long>")


def _carried(bucket: np.ndarray, grams: np.ndarray, place: np.ndarray, old: tuple, new: tuple, turn: int) -> np.ndarray:
    """The identifier of buckets whose core, so far from old[0] bytes before `place` to old[1] after it, is taken to new[0] and new[1], by those
    of the q-grams that cover what is added."""
    for k, (sign, was, now) in enumerate(((-1, old[0], new[0]), (1, old[1] - GRAM, new[1] - GRAM))):
        longer = now - was
        for i, (step, some) in enumerate(((now, longer > 0), (was + GRAM, longer > GRAM))):
            at = np.flatnonzero(some)
            bucket[at] = _joined(bucket[at], grams[place[at] + sign * step[at]], turn + 2 * k + i)
    return bucket


def range_rows(pieces: DataFrame, width: int) -> DataFrame:
    """bucket, name, key, place, first, last, sure: ranges of `width` offsets (a piece's share of them) of the strings of pieces, with the
    identifiers of what all strings of the whole range share and of all bytes of the piece's share.

    pieces: key, place, low, bytes, ranges (bucket, first, last, sure; offsets of the q-gram in the strings), and wide: the width of the ranges so far."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, PIECES) for b in batches for at in range(0, len(b), PIECES)):
            data, lists = batch.column("bytes"), batch.column("ranges")
            ids = identifiers(np.frombuffer(b"".join(data.to_pylist()), dtype=np.uint8))[GRAM]
            sizes = np.array([len(x.as_buffer()) for x in data])
            base = np.concatenate(([0], np.cumsum(sizes)[:-1])) + batch.column("place").to_numpy() - batch.column("low").to_numpy()
            flat = lists.flatten()
            piece = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            bucket, first, last = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("bucket", "first", "last"))
            # the parts of each range
            many = last // width - first // width + 1
            of = np.repeat(np.arange(len(many)), many)
            part = first[of] // width + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            begin, end = np.maximum(first[of], part * width), np.minimum(last[of], part * width + width - 1)
            whole = lambda x, w: (x // w * w, LENGTH - np.minimum(x // w * w + w - 1, LENGTH - GRAM))
            wide = batch.column("wide")[0].as_py()
            core, at = whole(begin, width), base[piece[of]]
            refined = _carried(bucket[of].view(np.uint64).copy(), ids, at, whole(first[of], wide), core, 12)
            refined ^= part.astype(np.uint64) * _M[32]
            name = _carried(refined.copy(), ids, at, core, (end, LENGTH - begin), 16) ^ (begin * LENGTH + end).astype(np.uint64) * _M[33]
            take = pa.array(piece[of])
            arrays = [pa.array(refined.view(np.int64)), pa.array(name.view(np.int64)), batch.column("key").take(take), batch.column("place").take(take), pa.array(begin), pa.array(end), flat.field("sure").take(pa.array(of))]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "name", "key", "place", "first", "last", "sure"])

    return pieces.select("key", "place", "low", "bytes", "ranges", "wide").mapInArrow(rows, "bucket long, name long, key binary, place long, first long, last long, sure boolean")


def _classes(rows: DataFrame, members, *one: str) -> tuple[DataFrame, DataFrame]:
    """(bucket, name of classes of several members; one member of each class of buckets of several, and whether it is `sure` to repeat)."""
    classes = written(rows.groupBy("bucket", "name").agg(members.alias("members"), F.min(F.struct(*one)).alias("one")))
    several = classes.groupBy("bucket").agg(F.count("*").alias("classes")).where("classes > 1").select("bucket")
    return classes.where("members > 1").select("bucket", "name"), classes.join(several, "bucket").select("bucket", "one.*", (F.col("members") > 1).alias("sure"))


def repeats(documents: DataFrame) -> DataFrame:
    """key, lows, highs: for each text with repeats, first and last starts of runs of strings that repeat. documents: doc_id, text, key."""
    blocks = block_rows(documents)
    common = blocks.groupBy("gram").agg(F.sum("times").alias("members")).where("members > 1").select("gram")
    # written as joined, so that Spark may split a hot bucket
    kept = written(blocks.join(common, "gram").withColumnRenamed("gram", "bucket"))
    repeated, open_blocks = _classes(kept, F.sum("times"), "key", "low", "high", "place")
    spans = [kept.join(repeated, ["bucket", "name"]).select("key", F.inline(F.arrays_zip(*[F.coalesce(f"{c}s", F.array(c)).alias(c) for c in ("low", "high")])))]
    pieces = written(_pieces(documents, open_blocks))
    ranges, wide = pieces.select("key", "place", F.array(F.struct("bucket", (F.col("place") - F.col("high")).alias("first"), (F.col("place") - F.col("low")).alias("last"), "sure")).alias("ranges")), LENGTH - GRAM + 1
    for turn, width in enumerate(WIDTHS):
        rows = written(range_rows(pieces.drop("bucket", "sure").join(ranges, ["key", "place"]).withColumn("wide", F.lit(wide)), width))
        repeated, open_ranges = _classes(rows, F.count("*"), "key", "place", "first", "last")
        found = rows.where("not sure").join(repeated, ["bucket", "name"])
        spans.append(found.select("key", (F.col("place") - F.col("last")).alias("low"), (F.col("place") - F.col("first")).alias("high")))
        if turn + 1 < len(WIDTHS):
            ranges = open_ranges.groupBy("key", "place").agg(F.collect_list(F.struct("bucket", "first", "last", "sure")).alias("ranges"))
            wide = width
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    # a set, as exact copies have the same spans
    sets = every.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    return sets.select("key", F.col("found.low").alias("lows"), F.col("found.high").alias("highs"))


def _pieces(documents: DataFrame, open_blocks: DataFrame) -> DataFrame:
    """open_blocks with their bytes. Of texts that are equal, one is read."""
    lists = open_blocks.groupBy("key").agg(F.collect_list(F.struct("bucket", "low", "high", "place", "sure")).alias("blocks"))
    one_each = documents.groupBy("key").agg(F.min("doc_id").alias("one"))
    wanted = lists.join(one_each, "key")
    same = (documents["key"] == wanted["key"]) & documents["doc_id"].eqNullSafe(wanted["one"])
    texts = documents.join(wanted, same).select(documents["key"], "text", "blocks").dropDuplicates(["key"])
    each = texts.select("key", F.col("text").cast("binary").alias("text"), F.explode("blocks").alias("b"))
    return each.select("key", "b.*", F.substring("text", F.col("b.low").cast("int") + 1, (F.col("b.high") - F.col("b.low") + LENGTH).cast("int")).alias("bytes"))


def cut(documents: DataFrame, characters: bool = False) -> DataFrame:
    """row (a struct of all columns of documents) and cut: n_bytes, n_removed, n_spans, and kept (binary), the bytes that stay. characters: of a character,
    remove all bytes or none, so that what stays is UTF-8."""

    @F.arrow_udf("struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary>")
    def remove(texts: pa.Array, lows: pa.Array, highs: pa.Array) -> pa.Array:
        numbers, kept = [], []
        for text, low, high in zip(texts, lows, highs, strict=True):
            raw = np.frombuffer(text.as_buffer(), dtype=np.uint8) if text.is_valid else np.empty(0, dtype=np.uint8)
            if not low.is_valid:
                numbers.append((len(raw), 0, 0))
                kept.append(raw.tobytes())
                continue
            edge = np.zeros(len(raw) + 1, dtype=np.int64)
            np.add.at(edge, low.values.to_numpy(), 1)
            np.add.at(edge, high.values.to_numpy() + LENGTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            if characters:
                gone = whole_characters(raw, gone)
            begins = gone & ~np.concatenate(([False], gone[:-1]))
            numbers.append((len(raw), int(gone.sum()), int(begins.sum())))
            kept.append(raw[~gone].tobytes())
        columns = [pa.array([x[i] for x in numbers], pa.int64()) for i in range(3)]
        return pa.StructArray.from_arrays([*columns, pa.array(kept, pa.binary())], names=["n_bytes", "n_removed", "n_spans", "kept"])

    tidy(documents.sparkSession)
    packed = documents.select(F.struct("*").alias("row"))
    text = F.coalesce("row.text", F.lit(""))
    keyed = packed.withColumn("key", F.unhex(F.md5(text.cast("binary"))))
    spans = repeats(keyed.select(F.col("row.doc_id").alias("doc_id"), text.alias("text"), "key"))
    return keyed.join(spans, "key", "left").select("row", remove("row.text", "lows", "highs").alias("cut"))


def without_repeats(documents: DataFrame, characters: bool = False) -> DataFrame:
    """documents with n_bytes, n_removed, n_spans and kept, as cut() gives them."""
    return cut(documents, characters).select(*beside(documents, "n_bytes", "n_removed", "n_spans", "kept"), "cut.*")


def whole_characters(raw: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """`gone` without the bytes of characters that it holds in part."""
    first = (raw & 0xC0) != 0x80
    of = np.cumsum(first) - 1
    kept_part = np.zeros(of[-1] + 1 if len(of) else 0, dtype=bool)
    kept_part[of[~gone]] = True
    return ~kept_part[of]


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
