"""From raw documents to token ids: quality, near-duplicates, repeats, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; run() writes what a stage returns as Parquet
in the shared checkpoint folder and gives it to the next. All stages but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, minhash, mixing, quality, suffixes
from tessera.llm.common import table, tidy, written
from tessera.session import attach


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels outside the held-out fold, doesn't reject. Null and empty texts have the score of the
    bias; a score at the threshold is kept; repeated rows are kept or go together; without labels all stay. Extra columns are kept."""
    tidy(spark)
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(F.col("text"), model) >= quality.THRESHOLD)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group linked by five-word shingles at a Jaccard similarity of 0.8. Of
    repeated rows (same id and text) one stays; documents without words all stay. Extra columns are kept."""
    kept = minhash.near_duplicates(docs, width=5, percent=80).where("kept").select("doc_id").distinct()
    packed = docs.select("doc_id", "text", F.struct("*").alias("whole"))
    return packed.join(kept, packed["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi").dropDuplicates(["doc_id", "text"]).select("whole.*")


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what strings of 200 bytes that repeat cover, in whole characters. Documents stay, with what is left; null texts stay null.
    Copies lose what they share in both. Extra columns are kept."""
    left = F.when(F.col("row.text").isNotNull(), F.col("cut.kept").cast("string"))
    changed = {"text": left, "n_chars": F.char_length(left).cast("long")}
    return suffixes.cut(docs, characters=True).select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them. Documents without words, null texts among them, aren't taken; which of repeated rows is
    taken doesn't matter. Extra columns are kept."""
    packed = mixing.mix(docs.select("doc_id", "source", "text", F.struct("*").alias("whole")), keep=("whole",)).where("copies > 0")
    copied = packed.select("whole", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return copied.select("whole.*")


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, and whether the decoded ids are the text again. Null and empty texts have no ids; repeated rows
    are coded each; long texts whole. Extra columns are left out."""
    import public_tokenizers

    tidy(spark)
    files = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = docs.withColumn("ids", bpe.encode(F.col("text"), *files))
    same = bpe.decode(F.col("ids"), *files) == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", keep_one_of_near_duplicates),
    ("suffix-array dedup", remove_repeats),
    ("mixing sources", mix_sources),
    ("byte-level BPE", to_tokens),
]

#: A learned classifier has no SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(attach(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
