"""Row validation against a flat class, with rules compiled to columns; reports hold rule and path names, never values."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import finite, row_digest
from tessera.schema import Schema

FULL_UP_TO = 10_000
SAMPLE_ROWS = 100


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where `broken` is true."""

    name: str
    path: str
    broken: Column
    severity: str = "ERROR"


def required(column: str) -> Rule:
    return Rule("required", column, F.col(column).isNull())


def pattern(column: str, regex: str) -> Rule:
    return Rule("pattern", column, ~F.col(column).rlike(regex))


def enumerated(column: str, values: tuple[str, ...]) -> Rule:
    return Rule("enum", column, ~F.col(column).isin(*values))


def finite_number(column: str) -> Rule:
    return Rule("finite-number", column, ~finite(column))


def numeric_text(column: str, kind: str = "double") -> Rule:
    return Rule("type", column, F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())


def list_members(column: str, values: tuple[str, ...]) -> Rule:
    return Rule("enum", f"{column}[*]", F.exists(column, lambda x: ~x.isin(*values)))


def list_rule(name: str, column: str, broken) -> Rule:
    """A rule on every element of a list; null elements aren't judged."""
    return Rule(name, f"{column}[*]", F.exists(column, lambda x: F.coalesce(broken(x), F.lit(False))))


def schema_rules(schema: Schema, cls: str, struct: T.StructType | None = None) -> list[Rule]:
    """What a class of a schema asks of its flat rows: required values, types, enumerations, patterns and finite numbers, in lists too.

    struct: the columns that the rows have, if not the schema's (columns that are missing break `required`; text where the schema has numbers is tried)."""
    kinds = {f.name: f.dataType for f in struct or schema.flat_struct(cls)}
    found: list[Rule] = []
    for c in schema.flat_columns(cls):
        if c.name not in kinds:
            found += [Rule("required", c.name, F.lit(True))] if c.required or c.identifier else []
            continue
        kind = kinds[c.name]
        element = kind.elementType if isinstance(kind, T.ArrayType) else kind
        tests = {
            "type": (lambda x, c=c: x.isNotNull() & x.try_cast(c.type).isNull()) if element != c.type and isinstance(element, T.StringType) else None,
            "enum": (lambda x, c=c: ~x.isin(*c.enum)) if c.enum else None,
            "pattern": (lambda x, c=c: ~x.rlike(f"^(?:{c.pattern})$")) if c.pattern else None,
            "finite-number": (lambda x: ~finite(x)) if isinstance(element, (T.DoubleType, T.FloatType)) else None,
        }
        found += [required(c.name)] if c.required or c.identifier else []
        for name, broken in tests.items():
            if broken is not None:
                found.append(list_rule(name, c.name, broken) if isinstance(kind, T.ArrayType) else Rule(name, c.name, broken(F.col(c.name))))
    return found


def rules_of(struct: T.StructType, wanted: dict[str, dict] | None = None) -> list[Rule]:
    """Rules of a flat struct: finite numbers, and what `wanted` says of columns (required, enum, pattern)."""
    found = [finite_number(f.name) for f in struct if f.dataType == T.DoubleType()]
    for column, says in (wanted or {}).items():
        found += [required(column)] if says.get("required") else []
        found += [enumerated(column, tuple(says["enum"]))] if says.get("enum") else []
        found += [pattern(column, says["pattern"])] if says.get("pattern") else []
    return found


def with_issues(df: DataFrame, rules: list[Rule], declared: list[str] | None = None) -> DataFrame:
    """df with `issues`: array<struct<severity, rule, path>>. Columns that aren't `declared` break the closed schema where filled."""
    extra = [Rule("undeclared", c, F.col(c).isNotNull()) for c in df.columns if declared is not None and c not in declared]
    each = [F.when(F.coalesce(r.broken, F.lit(False)), F.struct(F.lit(r.severity).alias("severity"), F.lit(r.name).alias("rule"), F.lit(r.path).alias("path"))) for r in [*rules, *extra]]
    empty = F.array().cast("array<struct<severity:string,rule:string,path:string>>")
    return df.withColumn("issues", F.array_compact(F.array(*each)) if each else empty)


def issue_counts(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("issues").alias("i")).groupBy("i.severity", "i.rule", "i.path").agg(F.count("*").alias("rows"))


def validity(checked: DataFrame) -> DataFrame:
    """selected, valid, invalid: a row is invalid with any ERROR."""
    bad = F.exists("issues", lambda i: i["severity"] == "ERROR")
    return checked.agg(F.count("*").alias("selected"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid"))


def sample(df: DataFrame, k: int, *key: str) -> DataFrame:
    """The k rows of the smallest digest: the same whatever the order and the partitions."""
    return df.withColumn("digest", row_digest(df, *(key or df.columns))).orderBy("digest").limit(k)


def selected(df: DataFrame, full: bool = False, full_up_to: int = FULL_UP_TO, sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, str, int]:
    """(rows to validate, mode, eligible rows): all when asked or when few, else a sample."""
    rows = df.count()
    return (df, "full", rows) if full or rows <= full_up_to else (sample(df, sample_rows).drop("digest"), "sample", rows)


def report(tables: dict[str, tuple[DataFrame, list[Rule]]], full: bool = False) -> DataFrame:
    """table, mode, eligible, selected, valid, invalid: one row for each table."""
    parts = []
    for name, (df, rules) in tables.items():
        rows, mode, eligible = selected(df, full)
        parts.append(validity(with_issues(rows, rules)).select(F.lit(name).alias("table"), F.lit(mode).alias("mode"), F.lit(eligible).alias("eligible"), "*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def contract(manifest: DataFrame, schema: DataFrame) -> DataFrame:
    """table, field, expected, found: where two frames (table, field, value) of a contract differ; empty if they agree."""
    both = manifest.withColumnRenamed("value", "found").join(schema.withColumnRenamed("value", "expected"), ["table", "field"], "full_outer")
    return both.where(~F.col("found").eqNullSafe(F.col("expected"))).select("table", "field", "expected", "found")


def load_stats(bound: DataFrame, sample_of: int = 5) -> DataFrame:
    """Per type: files with data, placeholders, misses, parse errors, rows, rows and files with a null key, and some names of misses.

    bound: type, file, status (data, placeholder, miss, error), rows, null_keys: one row for each file. Names are the smallest, found
    by a rank within the type, so no group is collected as a whole."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    counts = bound.groupBy("type").agg(
        is_("data").alias("files_with_data"), is_("placeholder").alias("placeholders"), is_("miss").alias("misses"), is_("error").alias("errors"), F.sum("rows").alias("rows"), F.sum("null_keys").alias("null_keys"), F.count_if(F.col("null_keys") > 0).alias("files_with_null_keys")
    )
    from pyspark.sql import Window

    placed = bound.where("status = 'miss'").withColumn("place", F.row_number().over(Window.partitionBy("type").orderBy("file"))).where(F.col("place") <= sample_of)
    names = placed.groupBy("type").agg(F.array_sort(F.collect_list("file")).alias("missing"))
    return counts.join(names, "type", "left")


def spot_check(df: DataFrame, *keys: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), *[F.countDistinct(k).alias(f"distinct_{k}") for k in keys])
