"""Digests by ranges of the hashed key, kept beside a table, so that two ages of it are compared by their digests and only ranges that differ are read.

A row's range is its key's hash, cut into RANGES equal parts, so ranges are even whatever the keys are, and two tables have the same ranges without knowing of each
other. A sealed table lies in a folder for each range; its digests add up, so those of coarser ranges, and of the whole table, are sums of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.snapshot import SnapshotError

RANGES = 256
RANGE = "__range"
_DIGESTS = "range int, rows long, first string, second string"


def range_of(*key: str, ranges: int = RANGES) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(ranges)).cast("int")


def digests(df: DataFrame, of: Column) -> DataFrame:
    """range, rows, first, second: two sums of hashes of the rows of each range, in whatever order they come."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns) if c != RANGE]
    total = lambda x: F.sum(x.cast("decimal(38,0)")).cast("string")
    return df.groupBy(of.alias("range")).agg(F.count("*").alias("rows"), total(F.xxhash64(*columns)).alias("first"), total(F.hash(*columns)).alias("second"))


def coarser(fine: DataFrame, by: int) -> DataFrame:
    """The digests of ranges of which each holds `by` of the finer ones; the rows of a level of a tree over them."""
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c)
    return fine.groupBy(F.floor(F.col("range") / by).cast("int").alias("range")).agg(F.sum("rows").alias("rows"), total("first"), total("second"))


def seal(df: DataFrame, path: str, *key: str, ranges: int = RANGES) -> DataFrame:
    """df written under path, a folder for each range, with its digests beside; the digests. A folder that is sealed already is an error."""
    spark = df.sparkSession
    if RANGE in df.columns:
        raise SnapshotError(f"the table has a column {RANGE}")
    df.limit(0).write.parquet(f"{path}/shape")
    df.withColumn(RANGE, range_of(*key, ranges=ranges)).repartition(RANGE).write.partitionBy(RANGE).parquet(f"{path}/rows")
    digests(opened(spark, path), F.col(RANGE)).coalesce(1).write.parquet(f"{path}/digests")
    return sealed_digests(spark, path)


def opened(spark: SparkSession, path: str) -> DataFrame:
    """A sealed table, which may be empty, with the range of each row."""
    shape = spark.read.parquet(f"{path}/shape").schema
    return spark.read.schema(T.StructType([*shape.fields, T.StructField(RANGE, T.IntegerType())])).parquet(f"{path}/rows")


def sealed_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_DIGESTS).parquet(f"{path}/digests")


def differing(old: DataFrame, new: DataFrame) -> list[int]:
    """The ranges whose digests aren't equal. There are RANGES rows on a side at most."""
    names = ["rows", "first", "second"]
    both = old.select("range", F.struct(*names).alias("o")).join(new.select("range", F.struct(*names).alias("n")), "range", "full_outer")
    return sorted(r["range"] for r in both.where(~F.col("o").eqNullSafe(F.col("n"))).select("range").collect())


def damaged(spark: SparkSession, path: str) -> list[int]:
    """Ranges of a sealed table whose rows aren't those that were sealed; reads all of it."""
    return differing(sealed_digests(spark, path), digests(opened(spark, path), F.col(RANGE)))


def changes(spark: SparkSession, old: str, new: str, *key: str) -> DataFrame:
    """key and change (added, removed or changed) of the rows in which two sealed tables differ. Only folders of ranges whose digests differ are read.

    A key that comes several times is changed if its rows, in any order, aren't the same."""
    ranges = differing(sealed_digests(spark, old), sealed_digests(spark, new))

    def side(path: str, name: str) -> DataFrame:
        rows = opened(spark, path).where(F.col(RANGE).isin(ranges)) if ranges else opened(spark, path).limit(0)
        others = [F.col(f"`{c}`") for c in sorted(rows.columns) if c not in (*key, RANGE)]
        return rows.groupBy(*key).agg(F.struct(F.count("*"), F.sum(F.xxhash64(*others).cast("decimal(38,0)"))).alias(name))

    a, b = side(old, "o").alias("a"), side(new, "n").alias("b")
    same_key = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    condition = same_key[0]
    for more in same_key[1:]:
        condition = condition & more
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("changed")
    return a.join(b, condition, "full_outer").where(~F.col("o").eqNullSafe(F.col("n"))).select(*[F.when(F.col("o").isNull(), F.col(f"b.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in key], change.alias("change"))
