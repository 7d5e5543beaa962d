"""Collections as tables of a log: each collection is read once, whatever the number of its tables, and its tables appear in one step."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import safe_name
from tessera.operators import flatten
from tessera.schema import Schema
from tessera.sinks.tablelog import Table, TableLog

TAG = "__table"


def staged_collection(log: TableLog, records: DataFrame, schema: Schema, cls: str, collection: str, record: str = "record", strict: bool = True) -> dict[str, Table]:
    """The primary and side tables of a collection, from one pass over its records, as parts that no entry lists yet. Side tables without rows aren't there; a primary table
    without rows is."""
    shapes = flatten.table_shapes(schema, cls, collection)
    staged = log.stage_split(flatten.tagged_rows(records, schema, cls, collection, record, strict, TAG), TAG, shapes, flatten.stored_names(shapes))
    return {collection: log.empty(shapes[collection])} | staged


def publish(log: TableLog, records: DataFrame, schema: Schema, cls: str, collection: str, record: str = "record", strict: bool = True) -> dict[str, int]:
    """A collection's tables in place of the ones before; rows by table. Side tables that have no rows any more go in the same step."""
    staged = staged_collection(log, records, schema, cls, collection, record, strict)
    owned = tuple(t for t in flatten.table_shapes(schema, cls, collection) if t != collection)
    log.replace_all(staged, collection, owned)
    return {name: table.rows for name, table in sorted(staged.items())}


def publish_all(log: TableLog, collections: dict[str, DataFrame], schema: Schema, root: str = "Database", skip: tuple[str, ...] = (), record: str = "record") -> list[dict]:
    """Publish each collection and say how it went: collection, status (written, skipped, absent or failed), error (the kind of exception only), rows by
    table, rows_read (records that Spark counted in the pass that wrote them) and seconds. One that fails leaves its old tables and doesn't stop the others."""
    results = []
    for name, cls in schema.collections(root).items():
        status, error, rows, read = "skipped" if name in skip else "written" if name in collections else "absent", None, {}, 0
        began = time.monotonic()
        if status == "written":
            seen = Observation()
            try:
                rows = publish(log, collections[name].observe(seen, F.count(F.lit(1)).alias("rows")), schema, cls, name, record)
                read = seen.get["rows"]
            except Exception as e:
                status, error = "failed", type(e).__name__
        results.append({"collection": name, "status": status, "error": error, "rows": rows, "rows_read": read, "seconds": time.monotonic() - began})
    return results


def run_tree(spark: SparkSession, run: str, results: list[dict]) -> DataFrame:
    """run, parent, status, error, rows_read, rows_written, seconds, rows_per_second: a row for the whole run, one for each collection under it, and one for each table under that. A parent's
    rows are its children's sums; the whole has failed if a collection has."""
    made = [r for r in results if r["status"] in ("written", "failed")]
    whole = "failed" if any(r["status"] == "failed" for r in made) else "success"
    total = lambda key: sum(r[key] for r in made)
    rows = [(run, None, whole, None, total("rows_read"), sum(sum(r["rows"].values()) for r in made), float(total("seconds")))]
    for r in results:
        status = "success" if r["status"] == "written" else r["status"]
        rows.append((r["collection"], run, status, r["error"], r["rows_read"], sum(r["rows"].values()), float(r["seconds"])))
        rows += [(f"{r['collection']}/{table}", r["collection"], "success", None, None, n, None) for table, n in sorted(r["rows"].items())]
    made_of = spark.createDataFrame(rows, "run string, parent string, status string, error string, rows_read long, rows_written long, seconds double")
    return made_of.withColumn("rows_per_second", F.when(F.col("seconds") > 0, F.col("rows_read") / F.col("seconds")))


def publish_types(log: TableLog, df: DataFrame, type_column: str, types: list[str]) -> dict[str, int]:
    """One table for each file type that has rows, written in one pass, in place of the tables of these types before; rows by table. Rows of other types
    are left out; types whose names would clash are an error."""
    names = {t: safe_name(t) for t in types}
    if len(set(names.values())) < len(types):
        raise ValueError("two types would have the same table name")
    mapped = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    rows = df.where(F.col(type_column).isin(types)).withColumn(TAG, F.try_element_at(mapped, F.col(type_column))).drop(type_column)
    shape = T.StructType([f for f in rows.schema if f.name != TAG])
    staged = log.stage_split(rows, TAG, {n: shape for n in names.values()})

    def make(base):
        changed = base.without(*names.values())
        for name, part in staged.items():
            changed = changed.with_part(name, part, fresh=True)
        return changed

    log.change(make)
    return {name: table.rows for name, table in sorted(staged.items())}
