"""Connected components by smallest labels, with joins and sums only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that can be reached, for every node of links (a, b; a written table, as each round reads it).

    Each round gives a node the smallest label of its neighbours, and then the label of that label, so that
    the way left shrinks by powers. Only the number of changes comes to the driver. Labels are written each
    round to the shared checkpoint folder."""
    apart = links.where("a != b")
    both = apart.select("a", "b").union(apart.select("b", "a"))
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("old"))
        lower = labels.withColumn("old", F.col("label")).union(near).groupBy("node").agg(F.min("label").alias("label"), F.min("old").alias("old"))
        up = lower.select(F.col("node").alias("of"), F.col("label").alias("up"))
        jumped = written(lower.join(up, F.col("label") == F.col("of"), "left").select("node", "old", F.least("label", "up").alias("label")))
        labels = jumped.select("node", "label")
        if jumped.where("label < old").isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame, kept: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """labels (node, label; every node once) after links (a, b) between nodes. Only what links make of labels is searched for components, so
    many links between two components count as one. kept: writes new labels, as they are to stay."""
    end = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"label_{name}"))
    between = links.join(end("a"), "a").join(end("b"), "b").where("label_a != label_b")
    found = written(between.select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")).distinct())
    if found.isEmpty():
        return labels
    lower = components(found).select(F.col("node").alias("label"), F.col("label").alias("lowest"))
    return kept(labels.join(lower, "label", "left").select("node", F.coalesce("lowest", "label").alias("label")))
