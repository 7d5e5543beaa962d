"""Writers: typed tables, empty-column pruning, table sets that are checked before they are promoted, and row counts compared."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import safe_name


class PromotionError(RuntimeError):
    pass


def conform(df: DataFrame, struct: T.StructType) -> DataFrame:
    """df in exactly the columns of a struct: absent ones null, others dropped, values made text where text is wanted, lone values
    wrapped where a list is; a number that can't be read fails the job. Column comments come along."""
    columns = []
    for f in struct.fields:
        if f.name not in df.columns:
            value = F.lit(None).cast(f.dataType)
        else:
            value, kind = F.col(f"`{f.name}`"), df.schema[f.name].dataType
            if isinstance(f.dataType, T.ArrayType) and not isinstance(kind, T.ArrayType):
                value = F.when(value.isNotNull(), F.array(value))
            elif f.dataType == T.StringType() and isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
                value = F.to_json(value)
            value = value.cast(f.dataType)
        columns.append(value.alias(f.name, metadata=f.metadata))
    return df.select(*columns)


def filled_columns(df: DataFrame, protected: tuple[str, ...] = ()) -> list[str]:
    """Columns with data, or protected: one pass. Empty lists count as empty. Without rows, all."""
    tests = [F.max(F.size(c) > 0 if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(f"`{c}`").isNotNull()).alias(c) for c in df.columns]
    seen = df.agg(F.count("*").alias("rows of it"), *tests).first()
    return [c for c in df.columns if c in protected or seen[c] or not seen["rows of it"]]


def prune_empty(df: DataFrame, protected: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in filled_columns(df, protected)])


def sanitised(df: DataFrame) -> DataFrame:
    """df with column names without blanks, commas, semicolons, braces, parentheses, line ends, tabs and equal signs."""
    names = [re.sub(r"[ ,;{}()\n\t=]+", "_", c).strip("_") for c in df.columns]
    if len({n.lower() for n in names}) < len(names):
        twice = sorted({n for n in names if [x.lower() for x in names].count(n.lower()) > 1})
        raise ValueError(f"columns would have the same name: {', '.join(twice)}")
    return df.toDF(*names)


def write_table(df: DataFrame, path: str, struct: T.StructType | None = None, mode: str = "overwrite", max_rows: int = 0, drop_empty: bool = False, protected: tuple[str, ...] = ()) -> None:
    """A typed Parquet table; no rows still give a file with the schema."""
    typed = conform(df, struct) if struct is not None else df
    typed = prune_empty(typed, protected) if drop_empty else typed
    writer = typed.write.mode(mode)
    (writer.option("maxRecordsPerFile", max_rows) if max_rows else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """CSV with a header, columns in name order, lists joined with a pipe."""
    columns = [(F.array_join(F.col(c).cast("array<string>"), "|") if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c)).alias(c) for c in sorted(df.columns)]
    df.select(*columns).write.mode(mode).option("header", True).csv(path)


def save_managed(df: DataFrame, name: str, mode: str = "errorifexists", file_format: str = "parquet", properties: dict[str, str] | None = None) -> None:
    """A managed table; `overwrite` replaces it as a whole. properties: what is said of the table itself (columns carry comments of their own)."""
    df.write.format(file_format).mode(mode).option("overwriteSchema", mode == "overwrite").saveAsTable(name)
    if properties:
        quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{quoted(k)} = {quoted(v)}' for k, v in sorted(properties.items()))})")


def properties_of(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def to_register(spark: SparkSession, database: str, planned: list[str], force: bool = False) -> list[str]:
    """The planned tables that aren't registered yet; all if forced."""
    there = {t.name for t in spark.catalog.listTables(database)}
    return [t for t in planned if force or t.lower() not in there]


def by_type(df: DataFrame, type_column: str, types: list[str]) -> dict[str, DataFrame]:
    """One DataFrame for each file type, by table name; types whose names would clash are an error."""
    names = [safe_name(t) for t in types]
    if len(set(names)) < len(names):
        raise ValueError("two types would have the same table name")
    return {n: df.where(F.col(type_column) == t).drop(type_column) for n, t in zip(names, types, strict=True)}


def nonempty_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {n: d for n, d in tables.items() if not d.isEmpty()}


def reconciled(source: DataFrame, destination: DataFrame) -> DataFrame:
    """table, source_rows, destination_rows, status. Both: table, rows."""
    both = source.withColumnRenamed("rows", "source_rows").join(destination.withColumnRenamed("rows", "destination_rows"), "table", "full_outer")
    same = F.col("source_rows").eqNullSafe(F.col("destination_rows"))
    return both.select("table", "source_rows", "destination_rows", F.when(same, "OK").otherwise("MISMATCH").alias("status"))


def gate(stats: DataFrame, allow_partial: bool = False) -> None:
    """Raise if a load had misses or errors. stats: type, misses, errors."""
    bad = stats.where("misses > 0 or errors > 0").select("type", "misses", "errors").limit(10).collect()
    if bad and not allow_partial:
        raise PromotionError("; ".join(f"{r['type']}: {r['misses']} missing, {r['errors']} failed" for r in bad))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path, as the file system knows them."""
    fs, to_path = _fs(spark, path)
    return fs.getContentSummary(to_path(path)).getLength()


def promote(spark: SparkSession, tables: dict[str, DataFrame], root: str, primary: str, owned: tuple[str, ...] = ()) -> dict[str, int]:
    """Write a collection's tables under root/_staging, check them, then swap each into place; rows by table.

    The set must hold the primary table, and side tables among `owned` only. Owned tables that aren't in the new set are removed.
    The old ones are kept until all are swapped, and put back if a swap fails; the completion record is written last. Several renames
    aren't atomic together: a reader in between may see both ages."""
    if primary not in tables:
        raise PromotionError(f"no table {primary}")
    if odd := sorted(set(tables) - {primary, *owned}):
        raise PromotionError(f"unexpected tables: {odd}")
    fs, path = _fs(spark, root)
    run = uuid.uuid4().hex
    staging, backup = f"{root}/_staging/{run}", f"{root}/_backup/{run}"
    rows = {}
    for name, df in tables.items():
        df.write.parquet(f"{staging}/{name}")
        rows[name] = spark.read.parquet(f"{staging}/{name}").count()
    moved: list[tuple[str, str]] = []

    def move(a: str, b: str) -> None:
        fs.mkdirs(path(b).getParent())
        if not fs.rename(path(a), path(b)):
            raise PromotionError(f"can't move {a} to {b}")
        moved.append((a, b))

    try:
        for name in (primary, *owned):
            if fs.exists(path(f"{root}/{name}")):
                move(f"{root}/{name}", f"{backup}/{name}")
            if name in tables:
                move(f"{staging}/{name}", f"{root}/{name}")
    except Exception:
        for a, b in reversed(moved):
            fs.rename(path(b), path(a))
        raise
    spark.createDataFrame(sorted(rows.items()), "table string, rows long").coalesce(1).write.mode("overwrite").json(f"{root}/_complete/{primary}")
    fs.delete(path(backup), True)
    fs.delete(path(staging), True)
    return rows
