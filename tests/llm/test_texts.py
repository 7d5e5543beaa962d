"""Operators on texts against brute force, on awkward small tables."""

import hashlib
import os
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera import session
from tessera.llm import bpe, licenses, minhash, mixing, quality, shingles, suffixes
from tessera.llm.common import tidy
from tests.llm.fixtures import TEXT, documents, prose

SHA = lambda x: hashlib.sha256(x).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), TEXT).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], TEXT)


def brute_repeats(texts):
    """(removed flags) for each text, by counting every string of 200 bytes."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if seen[r[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        out.append((r, gone))
    return out


def test_suffix_dedup(docs):
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], SHA(bytes(r["kept"]))) for r in suffixes.without_repeats(docs).collect())
    want = Counter()
    for (doc_id, *_), (raw, gone) in zip(documents(), brute_repeats([d[1] for d in documents()]), strict=True):
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        want[doc_id, len(raw), sum(gone), spans, SHA(bytes(b for b, g in zip(raw, gone, strict=True) if not g))] += 1
    assert got == want


def test_suffix_dedup_of_texts_made_of_common_parts(spark):
    """Parts that meet at other places, short periods, single changed bytes, copies, and a passage before many endings."""
    random = np.random.default_rng(8)
    parts = [prose(700 + i, 40 + 9 * i)[: 120 + 37 * i] for i in range(8)] + ["ab " * 90, "z" * 230, prose(720, 90)[:199], prose(721, 90)[:200]]
    texts = []
    for i in range(70):
        text = "".join(parts[j] for j in random.integers(0, len(parts), random.integers(1, 6)))
        if i % 3 == 0:
            at = int(random.integers(0, len(text)))
            text = text[:at] + "#" + text[at + 1 :]
        texts.append(text[int(random.integers(0, 40)) :])
    texts += texts[:3] + [parts[7] + prose(800 + i, 30) for i in range(20)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, N_BYTES int, kept string").repartition(4)
    got = suffixes.without_repeats(docs)
    assert sorted(got.columns) == sorted(["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept"])
    want = {i: bytes(b for b, g in zip(raw, gone, strict=True) if not g) for i, (raw, gone) in enumerate(brute_repeats(texts))}
    assert {r["doc_id"]: bytes(r["kept"]) for r in got.collect()} == want


def test_suffix_dedup_keeps_whole_characters(docs, empty):
    for r in suffixes.without_repeats(docs, characters=True).collect():
        bytes(r["kept"]).decode()
    assert suffixes.without_repeats(empty).count() == 0


def test_ranges_of_many_pieces_are_made_in_parts(monkeypatch):
    class Pieces:
        def select(self, *columns):
            return self

        def mapInArrow(self, rows, schema):  # noqa: N802  as Spark names it
            return rows

    raw = np.random.default_rng(7).integers(0, 256, 40_000, dtype=np.uint8).tobytes()
    n, longest = 2500, suffixes.LENGTH - suffixes.GRAM
    low = [7 * i for i in range(n)]
    ranges = [[{"bucket": i % 50, "first": i % 3, "last": longest - i % 5, "sure": i % 2 == 0}] for i in range(n)]
    data = [raw[x : x + 2 * suffixes.LENGTH] for x in low]
    kinds = pa.list_(pa.struct({"bucket": pa.int64(), "first": pa.int64(), "last": pa.int64(), "sure": pa.bool_()}))
    columns = [pa.array([b"k"] * n), pa.array([x + longest for x in low]), pa.array(low), pa.array(data), pa.array(ranges, kinds), pa.array([longest + 1] * n, pa.int32())]
    batch = pa.record_batch(columns, names=["key", "place", "low", "bytes", "ranges", "wide"])
    for width in suffixes.WIDTHS:
        parts = list(suffixes.range_rows(Pieces(), width)(iter([batch])))
        assert max(len(b) for b in parts) <= 1000 * (longest + 1)
        with monkeypatch.context() as m:
            m.setattr(suffixes, "PIECES", n)
            (whole,) = suffixes.range_rows(Pieces(), width)(iter([batch]))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([whole]))
        assert len(parts) > 1


def test_python_workers_get_batches_of_bounded_size(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([len(batch)])], names=["size", "n"])

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "64m")
        tidy(spark)
        wide = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("text"))
        found = wide.mapInArrow(sizes, "size long, n long").collect()
        assert sum(r["n"] for r in found) == 60 and max(r["size"] for r in found) < 6 << 20
        spark.conf.set(limit, "512kb")
        assert tidy(spark).conf.get(limit) == "512kb"
    finally:
        spark.conf.set(limit, before)


def test_long_texts_are_cut_in_parts_without_loss(monkeypatch):
    raw = np.frombuffer((prose(3, 3000) + "a" * 500).encode(), dtype=np.uint8)
    whole = suffixes.blocks_of(raw, np.array([0, len(raw)]))
    monkeypatch.setattr(suffixes, "PART", 700)
    assert all((a == b).all() for a, b in zip(whole, suffixes.blocks_of(raw, np.array([0, len(raw)])), strict=True))


def shingle_sets(rows, width):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(lower))
        yield {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


@pytest.mark.parametrize(("width", "few"), [(2, 32), (5, 32), (2, 1), (5, 1)])
def test_near_duplicates(docs, empty, width, few, monkeypatch):
    monkeypatch.setattr(minhash, "FEW", few)
    rows = documents()
    sets = list(shingle_sets(rows, width))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    lowest = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    want = Counter((rows[i][0], len(sets[i]), lowest[group[i]] if sets[i] else rows[i][0]) for i in range(len(rows)))
    got = minhash.near_duplicates(docs, width=width).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert minhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("few", [32, 1])
def test_small_sketches_keep_links(spark, few, monkeypatch):
    """Copies of one base that are linked with it alone, a chain, and a common passage in unrelated texts."""
    monkeypatch.setattr(minhash, "FEW", few)
    base = prose(1, 150).split()
    copies = [" ".join("x%d_%d" % (c, i) if i % 12 == c % 12 else w for i, w in enumerate(base)) for c in range(40)]
    passage = prose(50, 60)
    rows = [(i, t) for i, t in enumerate([" ".join(base), *copies, *(f"{passage} {prose(100 + i, 90)}" for i in range(60))])]
    sets = list(shingle_sets(rows, 2))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    want = {i: min(k for k in range(len(rows)) if group[k] == group[i]) for i in range(len(rows))}
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_word_hashes_of_long_texts_are_those_of_parts(monkeypatch):
    raw = np.frombuffer((prose(5, 4000) + " " + "z" * 9000).encode(), dtype=np.uint8)
    whole, _ = shingles.words_of(raw, np.zeros(1, dtype=np.int64))
    monkeypatch.setattr(shingles, "CHUNK", 1000)
    assert (shingles._long_words(raw) == whole).all()


def thue_morse(turn):
    return "".join("ab"[(i.bit_count() + turn) % 2] for i in range(1024))


def test_words_that_follow_a_rule_are_told_apart(spark):
    """A word and its complement have equal hashes if these are polynomials modulo a power of two."""
    texts = [f"x {thue_morse(0)}", f"x {thue_morse(1)}", f"x {thue_morse(0)}"]
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string"), width=2)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {1: 1, 2: 2, 3: 1}


def test_groups_around_a_base(spark):
    """Near copies of which few are linked with the base, and texts with a passage that is most of them: hot lists."""
    base = prose(2, 120).split()
    many = [" ".join("y%d_%d" % (c, i) if (i * 7 + c * 13) % 120 < c % 16 else w for i, w in enumerate(base)) for c in range(90)]
    passage = prose(51, 60)
    rows = list(enumerate([*many, *(f"{passage} {prose(300 + i, 12)}" for i in range(50)), *(f"{prose(400 + i, 5)} {passage}" for i in range(45))]))
    sets = list(shingle_sets(rows, 2))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    want = {i: min(k for k in range(len(rows)) if group[k] == group[i]) for i in range(len(rows))}
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def components_of(sets):
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    return [group.index(g) for g in group]


@pytest.mark.parametrize("always", [False, True])
def test_lists_of_several_shingles_keep_links(spark, always, monkeypatch):
    """Texts of 40 of 48 parts, of two sizes: every list is large, few pairs are linked. Lists are parted wherever the sizes allow it, or where it pays."""
    monkeypatch.setattr(minhash, "FEW", 2)
    if always:
        monkeypatch.setattr(minhash, "TURNS", 0)
        monkeypatch.setattr(minhash, "GAIN", 0)
        monkeypatch.setattr(minhash, "no_better", lambda lists: lists.select("parent").limit(0))
    random = np.random.default_rng(4)
    picks = [sorted(random.choice(48, 40 - i % 4, replace=False)) for i in range(60)]
    rows = [(i, " ".join(f"a{j} b{j} |" for j in pick)) for i, pick in enumerate(picks)]
    want = components_of(list(shingle_sets(rows, 2)))
    assert 5 < len(set(want)) < 60
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(enumerate(want))


def test_texts_that_only_share_much_leave_no_list(spark):
    """88 of 100 shingles in common, 12 of each text's own: no two are similar, and no entry is left to be compared."""
    common = " ".join(f"w{i}" for i in range(89))
    rows = [(i, f"{common} " + " ".join(f"u{i}_{j}" for j in range(12))) for i in range(50)]
    sets = spark.createDataFrame([(i, [hash(x) for x in s]) for (i, _), s in zip(rows, shingle_sets(rows, 2), strict=True)], "cid long, shingles array<long>")
    fine = minhash.fine_lists(sets)
    labels = sets.select(F.col("cid").alias("node"), F.col("cid").alias("label"))
    assert fine.count() > 0 and minhash.narrowed(fine, labels, 80).isEmpty()


def test_hubs_of_several_turns_in_one_step(spark):
    """The pairs of several turns are those of each turn, and pairs without any lead to no further job."""
    rows = [(v, c, 100, 1 / (c + 1), 90, 80, True, c) for v in range(3) for c in range(v, 12)]
    lists = spark.createDataFrame(rows, "value long, cid long, n long, own double, left int, least int, whole boolean, label long")
    pairs = lambda turns: {(r["a"], r["b"]) for r in minhash.stars(lists, 80, turns).collect()}
    assert pairs((0, 1, 2)) == pairs((0,)) | pairs((1,)) | pairs((2,)) and len(pairs((0, 1, 2))) > len(pairs((0,)))
    labels = lists.select(F.col("cid").alias("node"), "label").distinct()
    assert minhash.joined(labels, minhash.stars(lists, 80).limit(0), None, 80) is labels


def test_steps_between_leave_no_tables(spark, docs):
    import pathlib

    folder = pathlib.Path(session.shared_folder(spark)) / "tables"
    before = set(folder.iterdir()) if folder.exists() else set()
    got = minhash.near_duplicates(docs, width=2)
    assert got.count() == len(documents()) and len(set(folder.iterdir()) - before) == 2


def test_what_stays_holds_no_sketches(spark, docs):
    import pathlib

    folder = pathlib.Path(session.shared_folder(spark)) / "tables"
    before = set(folder.iterdir()) if folder.exists() else set()
    minhash.near_duplicates(docs, width=2)
    left = [spark.read.parquet(str(path)).columns for path in set(folder.iterdir()) - before]
    assert sorted(map(sorted, left)) == sorted(map(sorted, [["doc_id", "n", "h1", "h2"], ["h1", "h2", "n", "component"]]))


def shuffled(spark, name, job):
    """What job gives, and the bytes that its stages shuffle."""
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        found = job()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    tracker, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = {k for j in tracker.getJobIdsForGroup(name) for k in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(k)}
    return found, sum(store.lastStageAttempt(k).shuffleWriteBytes() for k in stages)


def test_only_texts_that_are_compared_are_shuffled(spark, monkeypatch):
    """Sets of 10 of 400 texts, one id null, one repeated; with a bitmap too small for them, more texts come along, but no set goes."""
    ids = [None, *range(1, 399), 7]
    texts = [(i, prose(1000 + (i or 0), 120)) for i in ids]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    named = minhash.sketches(docs, 2).where("doc_id is null or doc_id % 40 = 7").distinct()
    wanted = session.written(named.select(F.col("doc_id").alias("rep"), F.xxhash64("doc_id").alias("cid"), "h1", "h2"))
    stored = session.written(docs)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        all_texts = shuffled(spark, "all texts", lambda: stored.repartition("doc_id").groupBy(F.spark_partition_id()).agg(F.max("text")).collect())[1]
        sets, moved = shuffled(spark, "few texts", lambda: minhash.full_sets(stored, wanted, 2).select("cid", F.size("shingles")).collect())
        assert len(sets) == 11 and moved * 3 < all_texts
        monkeypatch.setattr(minhash, "ROW", 8)
        monkeypatch.setattr(minhash, "ROWS", 1)
        assert sorted(minhash.full_sets(stored, wanted, 2).select("cid", F.size("shingles")).collect()) == sorted(sets)
        assert minhash.full_sets(stored, wanted.limit(0), 2).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_partitions_of_only_null_and_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "", "en", "s", 0), (4, None, "en", "s", 0)], TEXT).coalesce(1)
    got = minhash.near_duplicates(docs, width=2).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {(i, 0, i, True) for i in range(1, 5)}
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4}


def tokenizer_files():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_byte_bpe(docs, empty):
    files = tokenizer_files()
    tokens = bpe.encoding(*files)
    got = Counter(tuple(r) for r in bpe.digests(docs, *files).collect())
    want = Counter()
    for doc_id, text, *_ in documents():
        ids = tokens.encode_ordinary(text or "")
        want[doc_id, len(ids), SHA(",".join(map(str, ids)).encode()), SHA((text or "").encode())] += 1
    assert got == want
    assert bpe.digests(empty, *files).count() == 0


@pytest.mark.parametrize("text", [prose(1, 900), "a" * 5000, "  \n x  y\t\n " * 300, "don't 12 3's — ok! " * 90, "漢字 かな。 " * 200, "x. y\x1c z\x85 w" * 100])
def test_safe_parts_don_t_change_ids(text):
    tokens = bpe.encoding(*tokenizer_files())
    parts = bpe.safe_parts(text, 50)
    assert "".join(parts) == text
    assert [i for p in parts for i in tokens.encode_ordinary(p)] == tokens.encode_ordinary(text)


def test_mixing(spark, docs, empty):
    mixed = mixing.mix(docs.withColumn("size", F.lit(1)).withColumn("Target", F.lit("t")).withColumn("mix_u", F.lit(2)).withColumn("row", F.lit(3)))
    assert sorted(mixed.columns) == sorted([*docs.columns, "mix_u", "row", "size", "source_size", "target", "copies"])
    rows = mixed.collect()
    assert len(rows) == len(documents())
    assert sum(r["copies"] * r["size"] for r in rows) > 0
    for source in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == source]
        assert sum(r["size"] for r in mine) == mine[0]["source_size"]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine)
    assert all(r["copies"] <= mixing.MAX_COPIES and (r["size"] or not r["copies"]) for r in rows)
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r["doc_id"], r["size"], r["copies"]) for r in again) == Counter((r["doc_id"], r["size"], r["copies"]) for r in rows)
    assert mixing.mix(empty).count() == 0


def test_targets_fill_up(spark):
    sized = spark.createDataFrame([("a", 1), ("b", 100), (None, 100), ("c", 0)], "source string, size long")
    got = {r["mix_source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    assert got["a"] == 3.0 and got["c"] == 0.0
    assert got["b"] == pytest.approx(2 * 198 / 3) and got[None] == pytest.approx(198 / 3)


def test_licenses(spark, empty):
    rows = [
        (1, "Released under THE mit-license, under the MIT license.\nmore"),
        (2, "cc by nc cc by nc"),
        (3, None),
        (4, ""),
        (5, "you may not use this file, except in full compliance with license terms\nx"),
        (6, "Apache License, Version 2.0 under the mit license" + " w" * 5000),
        (6, "Apache License, Version 2.0 under the mit license" + " w" * 5000),
        (7, "under the mit\nlicense"),
        (8, "mitcc by nc2 cc by"),
    ]
    df = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "doc_id long, text string, labels string, score_ double")
    clash = licenses.scan(df.select("doc_id", "text", "labels", df["score_"].alias("n_words"), df["score_"].alias("Score"), df["score_"].alias("row")))
    assert sorted(clash.columns) == sorted(["doc_id", "text", "labels", "row", "n_words", "n_base", "first_word", "last_word", "base_list", "labels_list", "score"])
    got = {r["doc_id"]: r for r in clash.collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_list"]) == (2, 1, 5, ["mit"])
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"]) == (2, 0, 3)
    assert (got[3]["n_words"], got[3]["n_base"], got[3]["first_word"], got[3]["score"]) == (0, 0, None, 0.0)
    assert got[5]["labels_list"] == ["apache-2"] and 0.8 <= got[5]["score"] < 1 and got[5]["base_list"] == []
    assert got[6]["base_list"] == ["apache-2", "mit"] and got[6]["first_word"] == 0
    assert got[7]["base_list"] == ["mit"]
    assert got[8]["n_base"] == 0
    assert licenses.scan(df.select("doc_id", "text")).count() == len(rows)
    assert licenses.scan(empty).count() == 0


def test_licenses_across_lines_and_told_apart(spark):
    """Wrapped texts, lines that share most words with another license's, words strewn over a long text, and blocks at any place."""
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated\ndocumentation files (the Software)"
    rows = [
        ("wrapped", grant, ["mit"]),
        ("gpl line", "Licensed under the GNU General Public License, version 3.", ["gpl"]),
        ("nc", "Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        ("sa", "licensed under cc by-sa 4.0", ["cc-by-sa"]),
        ("apache", "released under the Apache License", []),
        ("strewn", "x".join(f" {w} " + "word " * 60 for w in "copyright all rights reserved".split()), []),
        ("german", "mit der GNU General Public License, licensed under version 3", ["gpl"]),
        *((f"at {n}", "w " * n + grant + " v" * 70, ["mit"]) for n in (0, 1, 31, 32, 33, 47, 63, 64, 100, 4000)),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id string, text string").repartition(3)
    assert {r["doc_id"]: r["labels_list"] for r in licenses.scan(df).collect()} == {r[0]: r[2] for r in rows}


def brute_licenses(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    labels = set()
    for i in range(0, len(words), licenses.WINDOW // 2):
        have = set(words[i : i + licenses.WINDOW])
        labels |= {t.label for t in licenses.TEMPLATES if 100 * len(have & set(t.text.split())) >= licenses.THRESHOLD_PERCENT * len(set(t.text.split())) and set(t.told_by.split()) <= have}
    return labels


def test_blocks_at_the_threshold_without_telling_words(spark):
    """No pair of a block and a template that meets the threshold is left out; those without telling words are marked and give no label."""
    random = np.random.default_rng(6)
    texts = [" ".join(w for w in t.text.split() if w != out) for t in licenses.TEMPLATES for out in [None, *t.text.split()]]
    texts += [" ".join(random.permutation(t.split())) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], r["lic_label"], r["lic_overlap"], r["lic_whole"], r["lic_tells"]) for r in licenses.similar_blocks(df, "doc_id").collect())
    want = Counter()
    for i, text in enumerate(texts):
        have = set(text.split())
        for t in licenses.TEMPLATES:
            words = set(t.text.split())
            if 100 * len(have & words) >= licenses.THRESHOLD_PERCENT * len(words):
                want[i, t.label, len(have & words), len(words), set(t.told_by.split()) <= have] += 1
    assert got == want and sum(n for k, n in want.items() if not k[-1]) > 50
    marked = {r["doc_id"]: r for r in licenses.scan(df, alike=True).collect()}
    assert all(set(marked[i]["labels_list"]) | set(marked[i]["alike_list"]) >= {k[1] for k in want if k[0] == i} for i in marked)


def test_licenses_against_brute_force(spark):
    random = np.random.default_rng(2)
    pool = [t.text.split() for t in licenses.TEMPLATES]
    texts = []
    for _ in range(150):
        words = []
        for _ in range(random.integers(1, 5)):
            part = list(pool[random.integers(0, len(pool))])
            keep = random.random(len(part)) < 0.92
            words += [w for w, k in zip(part, keep, strict=True) if k] + ["filler"] * int(random.integers(0, 40))
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: set(r["labels_list"]) - set(r["base_list"]) for r in licenses.scan(df).collect()}
    base = {r["doc_id"]: set(r["base_list"]) for r in licenses.scan(df).collect()}
    assert got == {i: brute_licenses(t) - base[i] for i, t in enumerate(texts)} and sum(map(len, got.values())) > 50


def test_quality(spark, docs, empty):
    texts = [prose(i, 60) if i % 2 else "BUY!! " * 40 + str(i) for i in range(200)]
    model = quality.train(texts, [i % 2 for i in range(200)])
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", prose(900, 30000)])], "doc_id long, text string")
    scores = {r["doc_id"]: r["s"] for r in frame.select("doc_id", quality.score(F.col("text"), model).alias("s")).collect()}
    assert all((scores[i] > 0.5) == bool(i % 2) for i in range(200))
    assert scores[200] == scores[201] and 0 <= scores[200] <= 1 and scores[202] > 0.5
    other = {r["doc_id"]: r["s"] for r in frame.repartition(7).select("doc_id", quality.score(F.col("text"), model).alias("s")).collect()}
    assert other == scores
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (None, 1, 0), (77, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    found, y = quality.training_sample(docs, labels)
    assert len(found) == len(y) <= 2
    assert docs.select(quality.score(F.col("text"), quality.fitted(docs, labels.limit(0)))).first()[0] == 0.5
    assert empty.select(quality.score(F.col("text"), model)).count() == 0


def test_long_logits_are_those_of_the_whole():
    shares = np.random.default_rng(1).normal(size=quality.ROWS)
    text = prose(12, 3000) + " \n\t " + "word " * 700 + "漢字" * 400 + " x" * 300
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    whole = quality._logits(raw, np.array([0, len(raw)]), shares)[0]
    for part in (60, 61, 500, 1 << 20):
        assert quality._long_logit(raw, shares, part=part) == pytest.approx(whole, abs=1e-12)


def plain_score(text, model):
    """The softmax of the mean vector, feature by feature."""
    m = (1 << 64) - 1

    def mix(x):
        x ^= x >> 33
        x = x * 0xFF51AFD7ED558CCD & m
        x ^= x >> 33
        x = x * 0xC4CEB9FE1A85EC53 & m
        return x ^ x >> 33

    step = 0x9E3779B97F4A7C15
    number = [mix((b + 1) * step + 23 & m) for b in range(256)]
    raw, rows = (text or "").encode(), []
    words = raw.split()
    rows += [mix(sum(mix(number[b] ^ pow(step, i + 1, 1 << 64)) for i, b in enumerate(w)) & m) for w in words]
    rows += [101 if a == b else 202 for a, b in zip(words, words[1:])]
    even = bytes(32 if b in b"\t\n\v\f\r" else b for b in raw)
    for n in (3, 4):
        for i in range(len(even) - n + 1):
            if 32 not in even[i + 1 : i + n - 1]:
                rows.append(mix(int.from_bytes(even[i : i + n], "big") + (n << 40)))
    mean = sum(model.vectors[r % quality.ROWS].astype(float) for r in rows) / max(len(rows), 1) if rows else np.zeros(quality.DIMENSIONS)
    logits = model.output.astype(float) @ mean + model.bias
    return np.exp(logits[1]) / np.exp(logits).sum()


def test_quality_scores_are_those_of_plain_python(spark):
    texts = [prose(i, 30) if i % 2 else "BUY!! " * 20 + str(i) for i in range(40)]
    model = quality.train(texts, [i % 2 for i in range(40)])
    rows = [*texts[:10], None, "", " \t ", "a", "é\u3000漢\x0bx", "zz zz  zz\nzz", prose(3, 500)]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for r in frame.select("doc_id", quality.score(F.col("text"), model).alias("s")).collect():
        assert r["s"] == pytest.approx(plain_score(rows[r["doc_id"]], model), abs=1e-5)


def test_held_out_accuracy(spark):
    """On labelled documents of the fold that the classifier never sees."""
    sf = "/root/testdata/sf0.01"
    from tessera.llm.quality import op3_quality

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = op3_quality(spark, sf).join(labels, "doc_id").where("held_out")
    right = judged.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.95


TRAINS = """
import random, re
from tessera.llm import quality

anon = lambda: int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
pick = random.Random(4)
texts = [" ".join(str(pick.randrange(10**6)) for _ in range(400)) for _ in range(2000)]
quality.train(texts[:50], [i % 2 for i in range(50)], epochs=1)
before = anon()
quality.train(texts, [i % 2 for i in range(len(texts))], epochs=1)
print(anon() - before)
"""


def test_training_leaves_little_memory_behind():
    left = subprocess.run([sys.executable, "-c", TRAINS], cwd=Path(quality.__file__).parents[2], env=os.environ | {"OMP_NUM_THREADS": "1"}, capture_output=True, text=True, check=True, timeout=120)
    assert float(left.stdout) < 40


def test_components_of_a_long_chain_and_a_star_take_few_tables(spark, monkeypatch):
    from tessera.llm import components as C

    made = []
    monkeypatch.setattr(C, "written", lambda df: made.append(0) or minhash.written(df))
    chain = [(i, i + 1) for i in range(10, 40)] + [(5, 6), (6, 5), (5, 5), (8, 8)]
    found = C.components(minhash.written(spark.createDataFrame(chain, "a long, b long")))
    assert {tuple(r) for r in found.collect()} == {(i, 10) for i in range(10, 41)} | {(5, 5), (6, 5)}
    made.clear()
    labels = spark.createDataFrame([(i, i) for i in range(12)], "node long, label long")
    star = C.merged(labels, spark.createDataFrame([(3, i) for i in range(2, 12)], "a long, b long"))
    assert {tuple(r) for r in star.collect()} == {(0, 0), (1, 1)} | {(i, 2) for i in range(2, 12)}
    assert len(made) <= 4  # links, first labels, two rounds; the new labels are written by `kept`
