"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Every source gets a target: its weight's share of all words, at most `max_copies` times what it has; what
that leaves over is shared among the others by weight. A document's expected number of copies is its
source's target over its source's words, and more for a text of more words, fewer for a short one, so that fragments come less
often; over a source, expected words make up the target. The whole part of the copies is taken for certain; for the rest, documents
are ranked by random odds over inclusion odds, and the first of that order are taken until the source's
remaining words are met (to within half of the last document).

The order of a source is never sorted as a whole: documents are counted into bins of their rank, the bin in
which a source's remaining words end is found from those counts, and only the documents of that bin
are sorted. So a source with a third of all rows spreads over all tasks.

Nulls: a null text has no words; null sources are one source, last in order. A null doc_id ranks as its text
does. Documents without words are never taken (0). Repeated rows (same id and text) share a rank; which of them
is taken at the border doesn't matter, as they are the same row. Long texts are counted whole. Empty tables give empty
results. Extra columns are kept, whatever their names; columns named as a result are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, beside, table, written

#: Ranks are counted in so many bins for each source.
BINS = 4096
WEIGHTS = (1, 2, 3)
#: Words of a text whose copies are those of its source on the whole, if texts were alike.
MIDDLE = 200
MAX_COPIES = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(position: Column, weights: tuple[int, ...] = WEIGHTS) -> Column:
    """The weight of the source at a position (from 0): the given ones, again and again."""
    return F.element_at(F.array(*map(F.lit, weights)), (position % len(weights) + 1).cast("int"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """mix_source, source_size, target, mix_moment: one row for each source of `sized` (source, size).

    Sources that reach their cap are those of the smallest cap for their weight; with them in that order,
    running sums give the level (words for a unit of weight) that the others get. The windows here run over
    one row for each source, not over documents."""
    sources = sized.groupBy(F.col("source").alias("mix_source")).agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * preference(F.col("size"))).alias("mix_moment"))
    order = Window.orderBy(F.col("mix_source").isNull(), F.col("mix_source"))
    ranked = sources.withColumn("mix_weight", cyclic_weights(F.row_number().over(order) - 1, weights)).withColumn("mix_cap", F.col("source_size") * max_copies)
    by_cap = Window.orderBy((F.col("mix_cap") / F.col("mix_weight")).asc(), F.col("mix_source").isNull(), F.col("mix_source"))
    everything = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("mix_cap").over(before), F.lit(0))) / (F.sum("mix_weight").over(everything) - F.coalesce(F.sum("mix_weight").over(before), F.lit(0)))
    leveled = ranked.withColumn("mix_level", level)
    capped = leveled.withColumn("mix_capped", F.col("mix_level") * F.col("mix_weight") > F.col("mix_cap"))
    common = F.max(F.when(~F.col("mix_capped"), F.col("mix_level"))).over(everything)
    return capped.select(
        "mix_source",
        "source_size",
        F.when(F.col("mix_capped"), F.col("mix_cap").cast("double")).otherwise(common * F.col("mix_weight")).alias("target"),
        "mix_moment",
    )


def preference(size: Column) -> Column:
    """How much a text of so many words is preferred, in whole thousandths: 500 for a word or two, 1500 at most."""
    return F.lit(500).cast("long") + F.floor(size * 1000 / (size + MIDDLE)).cast("long")


def expected_copies(max_copies: int) -> Column:
    """Of size, source_size, target and mix_moment: the source's copies of a word, times what the document is preferred by, scaled so that expected words
    make up the target; and as much nearer to the source's as it takes for none to exceed max_copies."""
    alike = F.col("target") / F.col("source_size")
    scale = F.col("source_size") / F.col("mix_moment")
    room = F.least(F.lit(1.0), (max_copies - alike) / (alike * (scale * 1500 - 1)))
    return F.when(alike < max_copies, alike + alike * room * (scale * preference(F.col("size")) - 1)).otherwise(F.lit(float(max_copies)))


def uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from a key; the same on every run and engine (50 bits of an MD5)."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") * 2 + 1) / F.lit(float(2**49))


def pareto_rank(u: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds, r, as r / (1 + r): in the same order, and between 0 and 1."""
    mine, odds = u * (1 - inclusion), (1 - u) * inclusion
    return mine / (mine + odds)


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: str = "mix", expected: Column | None = None, bins: int = BINS, keep: tuple[str, ...] | None = None) -> DataFrame:
    """`documents` with size, source_size, target and copies (long).

    expected: a document's expected copies (at most max_copies; in terms of size, source_size, target and mix_moment) instead of
    expected_copies(). keep: the columns of documents that the mixture needs, if not all."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    kept = documents.columns if keep is None else list(keep)
    # texts are measured once; what follows reads only the columns it needs of this table
    row = F.struct(*[F.col(c) for c in kept]).alias("row") if kept else F.lit(None).alias("row")
    sized = written(documents.select(row, "doc_id", "source", word_count(F.col("text")).alias("size"), uniform(key, seed).alias("mix_u")))
    # written, as Spark then knows their size, and broadcasts one row for each source only if that is small; else it shuffles, and splits hot sources
    targets = written(source_targets(sized, weights, max_copies))
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("mix_source")), "left").drop("mix_source")
    copies = F.when(F.col("size") > 0, expected if expected is not None else expected_copies(max_copies)).otherwise(F.lit(0.0))
    rank = pareto_rank(F.col("mix_u"), F.col("mix_part"))
    drawn = (
        joined.withColumn("mix_copies", F.least(copies, F.lit(float(max_copies))))
        .withColumn("mix_whole", F.floor("mix_copies").cast("long"))
        .withColumn("mix_part", F.col("mix_copies") - F.col("mix_whole"))
        .withColumn("mix_rank", F.when(F.col("mix_part") > 0, rank))
        .withColumn("mix_bin", F.floor(F.col("mix_rank") * bins).cast("int"))
        .drop("mix_u", "mix_copies", "mix_moment")
    )
    # words by (source, bin): at most `bins` rows for each source after the partial sums
    counted = drawn.groupBy(F.col("source").alias("mix_source"), F.col("mix_bin").alias("mix_at")).agg(
        F.sum("size").alias("mix_words"), F.sum(F.col("size") * F.col("mix_whole")).alias("mix_sure"), F.first("target").alias("mix_target")
    )
    of_source, up_to = Window.partitionBy("mix_source"), Window.partitionBy("mix_source").orderBy("mix_at").rowsBetween(Window.unboundedPreceding, -1)
    border = written(
        counted.withColumn("mix_left", F.col("mix_target") - F.sum("mix_sure").over(of_source))
        .where(F.col("mix_at").isNotNull())
        .withColumn("mix_before", F.coalesce(F.sum("mix_words").over(up_to), F.lit(0)))
        .where(F.col("mix_before") + F.col("mix_words") > F.col("mix_left"))
        # one row for each source: the first bin that isn't taken as a whole
        .groupBy("mix_source")
        .agg(F.min(F.struct("mix_at", "mix_before", "mix_left")).alias("mix_cut"))
    )
    placed = drawn.join(border, F.col("source").eqNullSafe(F.col("mix_source")), "left").drop("mix_source")
    cut, at = F.col("mix_cut.mix_at"), F.col("mix_bin")
    split = F.coalesce((at == cut) & (F.col("mix_cut.mix_before") <= F.col("mix_cut.mix_left")), F.lit(False))
    below = at.isNotNull() & (cut.isNull() | (at < cut))
    inside = Window.partitionBy("source", "mix_bin").orderBy("mix_rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("mix_cut.mix_before") + F.sum("size").over(inside) - F.col("size") / 2
    sure = placed.where(~split).withColumn("mix_more", F.coalesce(below, F.lit(False)))
    last = placed.where(split).withColumn("mix_more", middle <= F.col("mix_cut.mix_left"))
    chosen = sure.unionByName(last)
    results = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.coalesce("target", F.lit(0.0)), "copies": F.col("mix_whole") + F.col("mix_more").cast("long")}
    return chosen.select(*beside(documents.select(*kept), *results), *[x.alias(c) for c, x in results.items()])


def op8_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixture = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep=("doc_id",))
    return mixture.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
