"""Inventories of tables, manifests, comparison of two sets of tables, and run metrics."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sinks.tables import stored_bytes


class SnapshotError(ValueError):
    pass


def schema_digest(struct: T.StructType, descriptions: bool = False) -> str:
    """SHA-256 of names and types, in name order; with descriptions if asked."""
    rows = [[f.name, f.dataType.simpleString(), *([f.metadata.get("comment", "")] if descriptions else [])] for f in sorted(struct, key=lambda f: f.name)]
    return hashlib.sha256(json.dumps(rows).encode()).hexdigest()


def content_digest(df: DataFrame, name: str) -> DataFrame:
    """table, rows, content: number of rows, and a hash of the rows that doesn't depend on order or partitions."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    parts = F.xxhash64(*columns) if columns else F.lit(0)
    total = lambda x: F.coalesce(F.sum(x.cast("decimal(38,0)")), F.lit(0)).cast("string")
    return df.agg(F.count("*").alias("rows"), F.concat_ws(":", total(parts), total(F.hash(*columns) if columns else F.lit(0))).alias("content")).select(F.lit(name).alias("table"), "rows", "content")


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """table, rows, content, schema_hash, described_schema_hash."""
    each = [content_digest(df, n).withColumn("schema_hash", F.lit(schema_digest(df.schema))).withColumn("described_schema_hash", F.lit(schema_digest(df.schema, True))) for n, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), each)


def stored_inventory(spark: SparkSession, paths: dict[str, str], lineage: dict[str, list[str]] | None = None) -> DataFrame:
    """The inventory of Parquet tables by path, with bytes on disk and the ids of what each was made from."""
    facts = [(n, stored_bytes(spark, p), sorted((lineage or {}).get(n, []))) for n, p in paths.items()]
    known = spark.createDataFrame(facts, "`table` string, bytes long, made_from array<string>")
    return inventory({n: spark.read.parquet(p) for n, p in paths.items()}).join(known, "table")


def catalog_inventory(spark: SparkSession, database: str) -> DataFrame:
    """The inventory of a database's tables, read only."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if t.tableType != "TEMPORARY")
    return inventory({n: spark.table(f"`{database}`.`{n}`") for n in names})


def catalog_formats(spark: SparkSession, database: str, reviewed: str | None = None) -> DataFrame:
    """table, format of a database's tables, from the catalog alone; an error if one hasn't the reviewed format."""
    found = []
    for t in spark.catalog.listTables(database):
        if t.tableType != "TEMPORARY":
            said = spark.sql(f"DESCRIBE EXTENDED `{database}`.`{t.name}`").where("col_name = 'Provider'").first()
            found.append((t.name, said["data_type"].lower() if said else None))
    if odd := sorted(n for n, f in found if reviewed and f != reviewed):
        raise SnapshotError(f"not {reviewed}: {', '.join(odd)}")
    return spark.createDataFrame(found, "`table` string, format string")


def differences(expected: DataFrame, found: DataFrame, key: str = "table") -> DataFrame:
    """key, status: missing, unexpected or changed."""
    names = [c for c in expected.columns if c != key]
    both = expected.select(key, F.struct(*names).alias("e")).join(found.select(key, F.struct(*names).alias("f")), key, "full_outer")
    status = F.when(F.col("f").isNull(), "missing").when(F.col("e").isNull(), "unexpected").when(F.col("e") != F.col("f"), "changed")
    return both.select(key, status.alias("status")).where(F.col("status").isNotNull())


def manifest(tables: dict[str, DataFrame], metrics: DataFrame) -> DataFrame:
    """The inventory, if the run's metrics (table, rows) agree with it in tables and rows; else an error that names some."""
    return _agreed(inventory(tables).cache(), metrics, "rows")


def stored_manifest(spark: SparkSession, paths: dict[str, str], metrics: DataFrame, lineage: dict[str, list[str]] | None = None) -> DataFrame:
    """The stored inventory, if the run's metrics (table, rows, bytes) agree with it in tables, rows and bytes."""
    return _agreed(stored_inventory(spark, paths, lineage).cache(), metrics, "rows", "bytes")


def _agreed(made: DataFrame, metrics: DataFrame, *facts: str) -> DataFrame:
    if bad := differences(metrics.select("table", *facts), made.select("table", *facts)).limit(10).collect():
        raise SnapshotError("; ".join(f"{r['table']} is {r['status']}" for r in bad))
    return made


def identity(made: DataFrame) -> str:
    """One digest for a manifest; times aren't part of it. A manifest has one row for each table."""
    rows = F.array_sort(F.collect_list(F.to_json(F.struct(*sorted(made.columns)))))
    return made.agg(F.sha2(F.array_join(rows, "\n"), 256)).first()[0]


def exact_cover(everything: DataFrame, included: DataFrame, skipped: DataFrame, name: str) -> DataFrame:
    """name, problem: names in both, twice in one, in neither, or unknown; empty for an exact cover."""
    part = lambda d, label: d.groupBy(name).agg(F.count("*").alias(label))
    all_ = part(everything, "a").join(part(included, "i"), name, "full_outer").join(part(skipped, "s"), name, "full_outer")
    n = lambda c: F.coalesce(c, F.lit(0))
    problem = F.when((n("i") > 0) & (n("s") > 0), "both").when((n("i") > 1) | (n("s") > 1), "twice").when(n("i") + n("s") == 0, "neither").when(n("a") == 0, "unknown")
    return all_.select(name, problem.alias("problem")).where(F.col("problem").isNotNull())


def name_differences(expected: DataFrame, found: DataFrame) -> DataFrame:
    """All columns and `side`: rows of one side that the other lacks, as multisets."""
    return expected.exceptAll(found).withColumn("side", F.lit("missing")).unionByName(found.exceptAll(expected).withColumn("side", F.lit("unexpected")))


RULES = ("preserve", "rebuild", "retire")


def disposition(candidate: DataFrame, live: DataFrame, rules: DataFrame) -> DataFrame:
    """table, action: what publishing a candidate over a live set does to each table.

    candidate, live: table, rows, content. In both: replace (keep, if rows and content agree); new: add; live only: what
    rules (table, rule) say. An unknown rule, one for a table that isn't live-only, or a live-only table without one is an
    error."""
    c, v = candidate.select("table", F.struct("rows", "content").alias("c")), live.select("table", F.struct("rows", "content").alias("v"))
    joined = c.join(v, "table", "full_outer").join(rules.select("table", "rule"), "table", "full_outer")
    live_only = F.col("v").isNotNull() & F.col("c").isNull()
    action = (
        F.when(F.col("rule").isNotNull() & ~F.col("rule").isin(*RULES), "error: unknown rule")
        .when(F.col("rule").isNotNull() & ~live_only, "error: rule for a table that isn't live only")
        .when(live_only & F.col("rule").isNull(), "error: live only and no rule")
        .when(live_only, F.col("rule"))
        .when(F.col("v").isNull(), "add")
        .when(F.col("c") == F.col("v"), "keep")
        .otherwise("replace")
    )
    return joined.select("table", action.alias("action"))


def checked_disposition(plan: DataFrame) -> DataFrame:
    if bad := plan.where(F.col("action").startswith("error")).limit(10).collect():
        raise SnapshotError("; ".join(f"{r['table']}: {r['action']}" for r in bad))
    return plan


def row_changes(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """change, rows: added, removed and changed rows by key."""
    side = lambda d, n: d.select(*key, F.xxhash64(*[F.col(c) for c in sorted(d.columns) if c not in key]).alias(n))
    both = side(old, "h_old").join(side(new, "h_new"), [*key], "full_outer")
    change = F.when(F.col("h_old").isNull(), "added").when(F.col("h_new").isNull(), "removed").when(F.col("h_old") != F.col("h_new"), "changed").otherwise("same")
    return both.groupBy(change.alias("change")).agg(F.count("*").alias("rows"))


def measured(name: str, source: DataFrame, make: Callable[[DataFrame], DataFrame], path: str) -> dict:
    """Write make(source) to a new folder and say what Spark saw: run, rows_read, rows_written, bytes, seconds, error.

    Rows are counted in the same pass, as they come from the source and as they are written; filters of `make` aren't pushed into the source's
    scan, as rows before them count as read."""
    read, wrote = Observation(), Observation()
    count = F.count(F.lit(1)).alias("rows")
    began, facts = time.monotonic(), {"run": name}
    try:
        make(source.observe(read, count)).observe(wrote, count).write.parquet(path)
        facts |= {"rows_read": read.get["rows"], "rows_written": wrote.get["rows"], "bytes": stored_bytes(source.sparkSession, path)}
    except Exception as e:
        facts["error"] = e
    return facts | {"seconds": time.monotonic() - began}


def run_metrics(spark: SparkSession, runs: list[dict]) -> DataFrame:
    """run, status, error, rows_read, rows_written, bytes, seconds, rows_per_second of measured() runs; failures carry the kind of error, never its text."""
    rows = [
        (r["run"], "failed" if r.get("error") else "success", type(r["error"]).__name__ if r.get("error") else None, r.get("rows_read", 0), r.get("rows_written", 0), r.get("bytes", 0), float(r.get("seconds", 0.0)))
        for r in runs
    ]
    made = spark.createDataFrame(rows, "run string, status string, error string, rows_read long, rows_written long, bytes long, seconds double")
    return made.withColumn("rows_per_second", F.when(F.col("seconds") > 0, F.col("rows_written") / F.col("seconds")))


def run_totals(metrics: DataFrame) -> DataFrame:
    """runs, failed, rows_read, rows_written, bytes, seconds over all runs."""
    return metrics.agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "failed").alias("failed"), *[F.sum(c).alias(c) for c in ("rows_read", "rows_written", "bytes", "seconds")])
