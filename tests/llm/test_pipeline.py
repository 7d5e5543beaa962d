"""The pipeline's stages, each against a brute-force version of what it must do to its input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tessera.llm import quality, suffixes
from tests.llm.fixtures import TEXT, documents
from tests.llm.test_texts import brute_repeats, shingle_sets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([d for d in documents() if d[0] is not None], TEXT)


CLASHES = ["kept", "n_bytes", "size", "target", "copies", "row", "whole", "cut", "key", "mix_u", "component_id"]


def test_extra_columns_with_clashing_names_stay(spark, docs):
    wide = docs.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHES])
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns
        assert out.count() == out.where(" AND ".join(f"`{c}` = 'mine {c}'" for c in CLASHES)).count() > 0
    assert P.to_tokens(spark, wide, SF).count() == docs.count()


def rows_of(df):
    assert df.columns == COLUMNS
    return [tuple(r) for r in df.collect()]


def test_quality_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r[0] for r in rows_of(P.keep_quality(spark, docs, SF))}
    model = quality.fitted(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r[0]: r[1] for r in docs.select("doc_id", quality.score(F.col("text"), model)).collect()}
    assert kept == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    good = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id").collect()}
    assert len(good - kept) <= 0.02 * len(good)


def test_near_duplicate_stage(spark, docs):
    rows = [d for d in documents() if d[0] is not None]
    sets = list(shingle_sets(rows, 5))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    want = {(r[0], r[1]) for i, r in enumerate(rows) if not sets[i] or r[0] == min(rows[k][0] for k in range(len(rows)) if group[k] == group[i] and sets[k])}
    got = [(r[0], r[1]) for r in rows_of(P.keep_one_of_near_duplicates(spark, docs, SF))]
    # an id that names two texts stays with both if it stays with one
    assert set(got) >= want and {r[0] for r in got} == {w[0] for w in want} and len(got) == len(set(got))


def test_repeats_stage(spark, docs):
    rows = [d for d in documents() if d[0] is not None]
    want = []
    for row, (raw, gone) in zip(rows, brute_repeats([r[1] for r in rows]), strict=True):
        import numpy as np

        flags = suffixes.whole_characters(np.frombuffer(raw, dtype=np.uint8), np.frombuffer(bytes(gone), dtype=np.uint8).astype(bool)) if raw else []
        text = None if row[1] is None else bytes(b for b, g in zip(raw, flags, strict=True) if not g).decode()
        want.append((row[0], text, row[2], row[3], None if text is None else len(text)))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(rows_of(P.remove_repeats(spark, docs, SF)), key=key) == sorted(want, key=key)


def test_mixture_stage(spark, docs):
    got = rows_of(P.mix_sources(spark, docs, SF))
    have = {tuple(r) for r in docs.collect()}
    assert set(got) <= have and all(got.count(r) <= 3 * sum(tuple(x) == r for x in docs.collect()) for r in set(got))
    assert all((r[1] or "").split() for r in got)


def test_token_stage(spark, docs):
    out = P.to_tokens(spark, docs, SF)
    assert out.where("not round_trip").count() == 0 and out.count() == docs.count()


def test_run(spark):
    out = P.run(spark, SF)
    assert out.count() > 50 and out.where("not round_trip").isEmpty()


def test_empty(spark, docs):
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0
