"""Ready analytic queries over result tables, a bridge table and entities. Column names of the caller's tables are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import prefixed, to_number


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group."""
    return first_n_per(df, keys, order, 1)


def first_n_per(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("place of it", F.row_number().over(place)).where(F.col("place of it") <= n).drop("place of it")


def file_manifest(objects: DataFrame, types: list[str], host: str, dedup: tuple[str, ...] = ("url", "data_object_type")) -> DataFrame:
    """Files of chosen types from one host, with a producer, one for each url and type."""
    wanted = objects.where(F.col("data_object_type").isin(types) & F.col("was_generated_by").isNotNull() & F.col("url").startswith(host))
    return first_per(wanted, list(dedup), [F.col("data_object_type"), F.col("id")])


def manifest_summary(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("data_object_type").agg(F.count("*").alias("files"), (F.sum(F.coalesce(to_number("file_size_bytes", "double"), F.lit(0.0))) / 1e9).alias("gigabytes"))


def hits_per_entity(fact: DataFrame, key: str, value, bridge: DataFrame, run: str, entity: str, n: int = 20) -> DataFrame:
    """entity, hits, runs of the entities with most rows of `fact` whose key is value; rows are summed by run before they meet the bridge."""
    by_run = fact.where(F.col(key) == value).groupBy(run).agg(F.count("*").alias("run_hits"))
    joined = bridge.select(run, entity).distinct().join(by_run, run)
    return joined.groupBy(entity).agg(F.sum("run_hits").alias("hits"), F.countDistinct(run).alias("runs")).orderBy(F.desc("hits"), entity).limit(n)


def cross_check(fact: DataFrame, fact_key: str, rollup: DataFrame, rollup_key: str, count: str, prefix: str = "", skip: int = 0, n: int | None = None) -> DataFrame:
    """key, counted, stored, difference: counts of fact rows against a stored rollup, largest difference first."""
    mine = fact.groupBy(prefixed(prefix, fact_key, skip).alias("key")).agg(F.count("*").alias("counted"))
    stored = rollup.select(F.col(rollup_key).cast("string").alias("key"), F.col(count).alias("stored"))
    both = mine.join(stored, "key", "full_outer").select("key", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("counted", "stored")])
    out = both.withColumn("difference", F.col("counted") - F.col("stored"))
    return out.orderBy(F.abs("difference").desc(), "key").limit(n) if n else out


def hit_quality(fact: DataFrame, key: str, error: str, score: str, n: int = 20) -> DataFrame:
    grouped = fact.groupBy(key).agg(F.count("*").alias("hits"), F.min(error).alias("best"), F.max(error).alias("worst"), F.round(F.avg(score), 2).alias("mean_score"))
    return grouped.orderBy(F.desc("hits"), key).limit(n)


def qc_by(stats: DataFrame, bridge: DataFrame, entities: DataFrame, run: str, entity: str, by: str, metrics: list[str]) -> DataFrame:
    """Per value of an entity's column: distinct runs and entities, and the mean of each metric."""
    joined = stats.join(bridge.select(run, entity).distinct(), run).join(entities.select(entity, by), entity)
    return joined.groupBy(by).agg(F.countDistinct(run).alias("runs"), F.countDistinct(entity).alias("entities"), *[F.round(F.avg(m), 2).alias(f"mean_{m}") for m in metrics])


def anchor_row(df: DataFrame, *order: Column | str, what: str = "row") -> DataFrame:
    """The first row in the order given, to start other queries from; an error if there is none."""
    first = df.orderBy(*order).limit(1)
    if first.isEmpty():
        raise LookupError(f"no {what} qualifies")
    return first


def entities_of_run(bridge: DataFrame, entities: DataFrame, run: str, entity: str, value, hops: str = "n_hops") -> DataFrame:
    """The entities that a run leads back to, with their columns, nearest first."""
    found = bridge.where(F.col(run) == value).groupBy(run, entity).agg(F.min(hops).alias(hops))
    return found.join(entities, entity).orderBy(hops, entity)


def reached_from_run(runs: DataFrame, run: str, value, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """What a chain of joins leads to from one run, such as its study: rows of the last table with the run's, each once."""
    return chain(runs.where(F.col(run) == value), *steps).distinct()


def of_run(stats: DataFrame, bridge: DataFrame, entities: DataFrame, run: str, entity: str, value) -> DataFrame:
    """A run's rows with its entities' columns (and hops, where the bridge has them)."""
    return stats.where(F.col(run) == value).join(bridge, run).join(entities, entity)


def taxon_to_entities(report: DataFrame, name: str, taxon: str, least: dict[str, float], bridge: DataFrame, run: str, entity: str, metrics: list[str], n: int = 20) -> DataFrame:
    """Entities where a taxon is found above thresholds, with the largest and the summed value of each metric."""
    rows = report.where(F.trim(name) == taxon)
    for metric, bound in least.items():
        rows = rows.where(F.col(metric) > bound)
    aggregates = [a for m in metrics for a in (F.max(m).alias(f"max_{m}"), F.sum(m).alias(f"sum_{m}"))]
    return rows.join(bridge.select(run, entity).distinct(), run).groupBy(entity).agg(*aggregates).orderBy(F.desc(f"max_{metrics[0]}"), entity).limit(n)


def top_taxa(report: DataFrame, run: str, value, rank: str, wanted: str, order: str, tie: str, n: int = 20) -> DataFrame:
    return report.where((F.col(run) == value) & (F.trim(rank) == wanted)).orderBy(F.desc(order), tie).limit(n)


def lineage_to_entities(summary: DataFrame, lineage: str, text: str, item: str, bridge: DataFrame, run: str, entity: str, n: int | None = 20) -> DataFrame:
    """Entities with items whose lineage holds a text: number of items, and their names sorted and joined."""
    joined = summary.where(F.col(lineage).contains(text)).join(bridge.select(run, entity).distinct(), run)
    out = joined.groupBy(entity).agg(F.count("*").alias("items"), F.array_join(F.array_sort(F.collect_list(F.col(item).cast("string"))), ",").alias("names"))
    return out.orderBy(F.desc("items"), entity).limit(n) if n else out


def quality_to_entities(stats: DataFrame, rules: Column, bridge: DataFrame, run: str, entity: str, metrics: list[str], n: int | None = 20) -> DataFrame:
    """Entities with rows that meet quality rules: their number and the mean of each metric."""
    joined = stats.where(rules).join(bridge.select(run, entity).distinct(), run)
    out = joined.groupBy(entity).agg(F.count("*").alias("items"), *[F.round(F.avg(m), 2).alias(f"mean_{m}") for m in metrics])
    return out.orderBy(F.desc("items"), entity).limit(n) if n else out


def bins_of_run(stats: DataFrame, run: str, value, order: list[Column]) -> DataFrame:
    return stats.where(F.col(run) == value).orderBy(*order)


def chain(start: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """Inner joins one after the other: (table, column so far, column of the table)."""
    out = start
    for table, left, right in steps:
        key = f"{right} of it"
        out = out.join(table.withColumnRenamed(right, key), F.col(left) == F.col(key)).drop(key)
    return out


def source_file(objects: DataFrame, object_id: str) -> DataFrame:
    return objects.where(F.col("id") == object_id)


def named_hits(fact: DataFrame, key: str, terms: DataFrame, term_key: str, name: str, keys: list | None = None) -> DataFrame:
    """key, name, hits: counts of (chosen) keys with their names."""
    rows = fact.where(F.col(key).isin(keys)) if keys else fact
    return rows.groupBy(key).agg(F.count("*").alias("hits")).join(terms.select(F.col(term_key).alias("term"), name), F.col(key) == F.col("term")).select(key, name, "hits")


def cooccurrence(fact: DataFrame, group: str, key: str, a, b) -> DataFrame:
    """Groups that hold both keys."""
    other = fact.where(F.col(key) == b).select(group)
    return fact.where(F.col(key) == a).join(other, group, "left_semi").select(group).distinct()


def rows_for_entity(fact: DataFrame, bridge: DataFrame, run: str, entity: str, value, type_column: str | None = None, type_value: str | None = None) -> DataFrame:
    chosen = bridge.where(F.col(entity) == value)
    chosen = chosen.where(F.col(type_column) == type_value) if type_column else chosen
    return fact.join(chosen.select(run).distinct(), run, "left_semi")


def entities_with(summary: DataFrame, column: str, text: str, bridge: DataFrame, run: str, entity: str) -> DataFrame:
    return summary.where(F.col(column).contains(text)).select(run).distinct().join(bridge.select(run, entity).distinct(), run).select(entity).distinct()


def term_lookup(terms: DataFrame, key: str, keys: list) -> DataFrame:
    """Each wanted key, whether the table has it, and its columns."""
    asked = terms.sparkSession.createDataFrame([(k,) for k in keys], f"{key} {terms.schema[key].dataType.simpleString()}")
    return asked.join(terms.withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def in_set(df: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows whose value a previous step found: a semi-join, whatever the size of the set."""
    return df.join(ids.select(F.col(id_column).alias(column)), column, "left_semi")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows"))
