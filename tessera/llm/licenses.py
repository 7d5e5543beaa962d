"""Licence scans: places of fixed phrases, and an exact set-similarity join of text blocks with templates.

The join finds every block that holds at least `threshold` of a template's distinct words, and says whether those that tell it from other templates
are among them. Only pairs with these give a label and a score; labels of the others are in alike_list.
Blocks are windows of WINDOW words over the whole text, across line ends, one beginning every WINDOW / 2 words, so any stretch of WINDOW / 2 + 1 words lies in one.
Tokens are put in one global order, rarest in the corpus first; a template's prefix under that order is so long
that a block without any of its tokens cannot reach the threshold; blocks with too few tokens are dropped (length
filter), and so are pairs whose tokens after the matching place cannot make up the overlap that is needed
(positional filter); what remains is verified on the full sets. Only words of templates can add to an overlap, so only
these are kept and counted. A text without enough words of any template isn't cut into blocks.

DataFrame functions only. The template index has one row for each template and prefix token, so it is bounded by
the templates, a parameter, and is broadcast.

Nulls: a null text has no words. Documents without a match get 0 places, null first and last word, empty labels and a
score of 0. Repeated rows are scanned each for itself. Long texts are read whole. Of templates with one label and of equal shares (ties), the label and the
share count once. Empty tables give empty results. Extra columns are kept, whatever their names; columns named as a result are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import beside, lower_ascii, table, written

#: What separates words, once letters are lower-cased: every ASCII character but digits and a-z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    """A license's words. told_by: those that a block must have, as other licenses share the rest."""

    label: str
    text: str
    told_by: str


TEMPLATES = (
    Template("mit", "released under the mit license", "released mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted copy"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    Template("apache-2", "you may not use this file except in compliance with the license", "file compliance license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("gpl", "licensed under the gnu general public license version 3", "gnu general public"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution binary"),
    Template("all-rights-reserved", "copyright all rights reserved", "copyright reserved"),
)
#: Words of a block; twice as many as those of the longest template, and some.
WINDOW = 64
THRESHOLD_PERCENT = 80


def tokens(text: Column) -> Column:
    """array<string>: the words of a text, in order."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(TOKEN), F.lit(0))


def word_total(text: Column) -> Column:
    """Number of words; ASCII upper case counts as lower case without being changed first."""
    return F.coalesce(F.regexp_count(text, F.lit(RAW_TOKEN)), F.lit(0)).cast("long")


def phrase_places(documents: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """documents with n_words, n_base, first_word, last_word and base_list (array of labels).

    Texts in which no first word of a phrase is found are counted only. In the others, words are joined by
    single blanks, and each place of a phrase cuts that text, so that words before the first and
    after the last cut give the positions."""
    firsts = "|".join(sorted({p.split()[0] for p in phrases}))
    normal = F.concat(F.lit("\n "), F.regexp_replace(lower_ascii(F.col("text")), GAP, " "), F.lit(" "))
    seen = documents.withColumn("n_words", word_total(F.col("text"))).withColumn("lic_text", F.when(F.col("text").rlike(f"(?i){firsts}"), F.regexp_replace(normal, " {2,}", " ")))
    words_in = lambda part: F.regexp_count(part, F.lit(TOKEN)).cast("long")
    firsts_of, lasts_of, counts = [], [], []
    for i, phrase in enumerate(phrases):
        seen = seen.withColumn(f"lic_{i}", F.split("lic_text", f"(?= {phrase} )"))
        n = F.coalesce(F.size(f"lic_{i}") - 1, F.lit(0))
        counts.append(F.when(F.col("lic_text").isNull(), F.lit(0)).otherwise(n).cast("long"))
        firsts_of.append(F.when(counts[-1] > 0, words_in(F.element_at(f"lic_{i}", 1))))
        lasts_of.append(F.when(counts[-1] > 0, F.col("n_words") - words_in(F.element_at(f"lic_{i}", -1))))
    return seen.select(
        *documents.columns,
        "n_words",
        reduce(lambda a, b: a + b, counts).alias("n_base"),
        F.array_min(F.array(*firsts_of)).alias("first_word"),
        F.array_max(F.array(*lasts_of)).alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c > 0, F.lit(label)) for c, label in zip(counts, phrases.values(), strict=True)])))).alias("base_list"),
    )


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.text.lower().split()})


def needed(template: Template, percent: int) -> int:
    """Least number of a template's words that a block at the threshold has."""
    return -(-len(set(template.text.lower().split())) * percent // 100)


def may_hold(text: Column, templates: tuple[Template, ...], percent: int) -> Column:
    """Whether a text has, for some template, as many of its words as the threshold asks for; no other text can hold a block at the threshold. As
    most of the words are needed, one of the longest few is; they are looked for first."""
    low = F.lower(text)
    each, first = [], set()
    for t in templates:
        words, need = sorted(set(t.text.lower().split()), key=lambda w: (-len(w), w)), needed(t, percent)
        has = [low.contains(w) for w in words]
        first |= set(words[: len(words) - need + 1])
        each.append(reduce(lambda a, b: a | b, has[: len(words) - need + 1]) & (reduce(lambda a, b: a + b, [h.cast("int") for h in has]) >= need))
    # most texts have none of these, each looked for once
    few = sorted(w for w in first if not any(x in w for x in first - {w}))
    return reduce(lambda a, b: a | b, [low.contains(w) for w in few]) & reduce(lambda a, b: a | b, each)


def blocks(documents: DataFrame, key: str, words: list[str], window: int = WINDOW) -> DataFrame:
    """key, lic_tokens (distinct words of a window that templates have) of every window with such words."""
    half = window // 2
    texts = documents.select(F.col(key), tokens(F.col("text")).alias("lic_every")).where("size(lic_every) > 0")
    # each word is looked up once, and keeps its place
    known = texts.select(key, F.transform("lic_every", lambda t: F.when(t.isin(words), t)).alias("lic_every"))
    each = known.select(key, "lic_every", F.explode(F.sequence(F.lit(0), F.expr(f"(size(lic_every) - 1) div {half}"))).alias("lic_at"))
    return each.select(key, F.array_distinct(F.array_compact(F.slice("lic_every", F.col("lic_at") * half + 1, F.lit(window)))).alias("lic_tokens")).where(F.size("lic_tokens") > 0)


def template_index(blocks_of: DataFrame, templates: tuple[Template, ...], percent: int) -> DataFrame:
    """lic_token, lic_label, lic_need, lic_rank (place of the token in the template's order), lic_ordered, lic_told: one row for each
    token of a template's prefix. Tokens are ordered by the number of blocks that they occur in."""
    rows = [(i, t.label, sorted(set(t.text.lower().split())), sorted(set(t.told_by.lower().split()))) for i, t in enumerate(templates)]
    made = blocks_of.sparkSession.createDataFrame(rows, "lic_template int, lic_label string, lic_words array<string>, lic_told array<string>")
    counts = blocks_of.select(F.explode("lic_tokens").alias("lic_token")).groupBy("lic_token").agg(F.count("*").alias("lic_df"))
    ordered = (
        made.select("lic_template", "lic_label", "lic_told", F.explode("lic_words").alias("lic_token"))
        .join(counts, "lic_token", "left")
        .groupBy("lic_template", "lic_label", "lic_told")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("lic_df", F.lit(0)).alias("df"), F.col("lic_token").alias("token")))).alias("lic_pairs"))
        .select("lic_label", "lic_told", F.col("lic_pairs.token").alias("lic_ordered"))
        .withColumn("lic_need", F.ceil(F.size("lic_ordered") * percent / 100).cast("int"))
    )
    prefix = F.slice("lic_ordered", F.lit(1), F.size("lic_ordered") - F.col("lic_need") + 1)
    return ordered.select("*", F.posexplode(prefix).alias("lic_rank", "lic_token"))


def similar_blocks(documents: DataFrame, key: str, templates: tuple[Template, ...] = TEMPLATES, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """key, lic_label, lic_overlap, lic_whole, lic_tells (whether all words that tell it from others are there): every (block, template) with at
    least `percent` of the template's words."""
    found = written(blocks(documents.where(may_hold(F.col("text"), templates, percent)), key, vocabulary(templates)))
    index = template_index(found, templates, percent)
    least = min(needed(t, percent) for t in templates)
    probes = found.where(F.size("lic_tokens") >= least).select("*", F.explode("lic_tokens").alias("lic_token"))
    whole, rank, need = F.size("lic_ordered"), F.col("lic_rank"), F.col("lic_need")
    long_enough = F.size("lic_tokens") >= need
    in_place = F.least(F.size("lic_tokens"), whole - rank) >= need
    # each pair once: at the first token of the template's order that the block has
    first = ~F.arrays_overlap("lic_tokens", F.slice("lic_ordered", F.lit(1), rank))
    # the index has no more rows than templates have words
    told = F.size(F.array_except("lic_told", "lic_tokens")) == 0
    pairs = probes.join(F.broadcast(index), "lic_token").where(long_enough & in_place & first)
    return pairs.select(key, "lic_label", told.alias("lic_tells"), F.size(F.array_intersect("lic_tokens", "lic_ordered")).alias("lic_overlap"), whole.alias("lic_whole"), need.alias("lic_need")).where("lic_overlap >= lic_need").drop("lic_need")


def scan(documents: DataFrame, templates: tuple[Template, ...] = TEMPLATES, percent: int = THRESHOLD_PERCENT, phrases: dict[str, str] = PHRASES, alike: bool = False) -> DataFrame:
    """documents with the columns of phrase_places, labels_list, score (1 with a phrase, else the largest share of a template) and,
    if asked for by `alike`, alike_list: labels of templates of which a block has enough words, but not all that tell them from others."""
    text = F.col("row.text")
    packed = documents.select(F.struct("*").alias("row"))
    keyed = packed.select("row", text.alias("text"), F.struct(F.length(text).alias("n"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), F.xxhash64(F.lit("lic"), F.coalesce(text, F.lit(""))).alias("g")).alias("lic_key"))
    tells = F.col("lic_tells")
    found = (
        similar_blocks(keyed, "lic_key", templates, percent)
        .groupBy(F.col("lic_key").alias("lic_found"))
        .agg(F.collect_set(F.when(tells, F.col("lic_label"))).alias("lic_labels"), F.collect_set("lic_label").alias("lic_alike"), F.max(F.when(tells, F.col("lic_overlap") / F.col("lic_whole"))).alias("lic_score"))
    )
    placed = phrase_places(keyed, phrases).join(found, F.col("lic_key").eqNullSafe(F.col("lic_found")), "left")
    empty = F.array().cast("array<string>")
    results = {
        **{c: F.col(c) for c in ("n_words", "n_base", "first_word", "last_word", "base_list")},
        "labels_list": F.array_sort(F.array_union("base_list", F.coalesce("lic_labels", empty))),
        "score": F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("lic_score", F.lit(0.0))),
    }
    if alike:
        results["alike_list"] = F.array_sort(F.array_except(F.coalesce("lic_alike", empty), results["labels_list"]))
    return placed.select(*beside(documents, *results), *[x.alias(c) for c, x in results.items()])


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_list", ",").alias("base_labels"), F.array_join("labels_list", ",").alias("labels"), "score")
