"""Child rows and enrichments of nested typed records; each a function of DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import normal_curie, three_parts


def _elements(df: DataFrame, key: str, slot: str, parent: str) -> DataFrame:
    return df.select(F.col(key).alias(parent), F.explode(slot).alias("element"))


def child_rows(df: DataFrame, key: str, slot: str, parent: str, drop: tuple[str, ...] = ("type",)) -> DataFrame:
    """One row for each object of a list, with the record's key (identifiers of publications, for instance)."""
    rows = _elements(df, key, slot, parent)
    names = [n for n in rows.schema["element"].dataType.names if n not in drop]
    return rows.select(parent, *[F.col(f"element.{n}").alias(n) for n in names])


def credit_rows(df: DataFrame, key: str = "id", slot: str = "credits", parent: str = "study_id", person: str = "person", roles: str = "roles") -> DataFrame:
    """One row for each credit: roles sorted and joined with a pipe, the person's fields with a prefix, lists joined."""
    rows = _elements(df, key, slot, parent)
    inner = rows.schema["element"].dataType[person].dataType
    fields: list[Column] = []
    for f in inner.fields:
        if f.name != "type":
            value = F.col(f"element.{person}.{f.name}")
            fields.append((F.array_join(value, "|") if f.dataType.typeName() == "array" else value).alias(f"{person}_{f.name}"))
    return rows.select(parent, F.array_join(F.array_sort(f"element.{roles}"), "|").alias(roles), *fields)


def administered_rows(df: DataFrame, key: str, slot: str, parent: str, raw: str = "has_raw_value") -> DataFrame:
    """One row for each value `label [id];stamp` of a list, taken apart."""
    rows = _elements(df, key, slot, parent)
    text = F.col(f"element.{raw}") if rows.schema["element"].dataType.typeName() == "struct" else F.col("element")
    return rows.select(parent, text.alias("raw"), three_parts(text).alias("p")).select(parent, "raw", "p.*")


def field_counts(df: DataFrame) -> DataFrame:
    """field, filled: how many rows have each column; one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "field", "filled")


def with_terms(df: DataFrame, terms: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """For each env field f (with f_term_id, f_term_name): the normal id, the term table's label, whether it is obsolete,
    and whether the labels agree (null if either is missing). terms: id, label, obsolete."""
    for f in fields:
        table = terms.select(F.col("id").alias(f"{f}_key"), F.col("label").alias(f"{f}_canonical_label"), F.col("obsolete").alias("is_old"))
        df = df.withColumn(f"{f}_normal_id", normal_curie(f"{f}_term_id")).join(table, F.col(f"{f}_normal_id") == F.col(f"{f}_key"), "left")
        df = df.withColumn(f"{f}_is_obsolete", F.coalesce("is_old", F.lit(False))).withColumn(f"{f}_label_matches", F.col(f"{f}_term_name") == F.col(f"{f}_canonical_label")).drop(f"{f}_key", "is_old")
    return df
