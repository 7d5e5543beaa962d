"""Column helpers that the operators and plans share."""

from __future__ import annotations

from difflib import SequenceMatcher, get_close_matches

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefixed(prefix: str, value: Column | str, skip: int = 0) -> Column:
    """An id in another notation: prefix, then the value without its first `skip` characters."""
    text = col(value).cast("string")
    return F.concat(F.lit(prefix), F.substr(text, F.lit(skip + 1)))


def to_number(value: Column | str, kind: str = "double") -> Column:
    """A number from text; what isn't one is null."""
    return F.trim(col(value)).try_cast(kind)


def attribute(text: Column | str, key: str) -> Column:
    """The value of the last `key=value` between semicolons, null if there is none."""
    return attribute_of(attribute_list(text), key)


def attribute_list(text: Column | str) -> Column:
    """`;key=value;key=value` without blanks before keys: what attribute_of() takes, so that several keys share the work."""
    return F.regexp_replace(F.concat(F.lit(";"), col(text)), r";\s+", ";")


def attribute_of(listed: Column | str, key: str) -> Column:
    """attribute(), of an attribute_list(); plain string functions that stay in generated code."""
    start = f";{key}="
    return F.when(col(listed).contains(start), F.substring_index(F.substring_index(col(listed), start, -1), ";", 1))


def unquoted(text: Column | str) -> Column:
    return F.regexp_replace(F.trim(col(text)), "^'+|'+$", "")


def percent(text: Column | str) -> Column:
    return to_number(F.regexp_replace(F.trim(col(text)), "%+$", ""))


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(F.trim(col(text)), F.lit(""))


def url_path(url: Column | str) -> Column:
    return F.try_parse_url(col(url), F.lit("PATH"))


def decoded(path: Column | str) -> Column:
    """A path with its percent codes taken back; a plus sign stays one. What can't be decoded stays as it is."""
    text = col(path)
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def finite(value: Column | str) -> Column:
    """True for numbers, false for NaN and infinities, null for null."""
    return ~F.isnan(col(value)) & (F.abs(col(value)) != float("inf"))


def normal_curie(value: Column | str) -> Column:
    """`ABC_1` as `ABC:1`: the first underscore, and only where there is no colon yet."""
    text = col(value)
    return F.when(text.contains(":"), text).otherwise(F.regexp_replace(text, "^([^_]*)_", "$1:"))


def three_parts(text: Column | str, pattern: str = r"^(.*?) \[([^\]]+)\];([\d\-T:]+)$") -> Column:
    """struct<label, id, stamp> of `label [id];stamp`; empty strings where the text has another form."""
    part = lambda i: F.coalesce(F.regexp_extract(col(text), pattern, i), F.lit(""))
    return F.struct(part(1).alias("label"), part(2).alias("id"), part(3).alias("stamp"))


def is_placeholder(text: Column | str, phrases: tuple[str, ...]) -> Column:
    """Whether a whole file's text is blank, or one line that begins with one of the phrases."""
    body = F.trim(F.regexp_replace(col(text), r"^\s+|\s+$", ""))
    known = F.lit(False)
    for phrase in phrases:
        known = known | F.lower(body).startswith(phrase.lower())
    return (body == "") | (~body.contains("\n") & known)


def canonical(value: Column, kind: T.DataType) -> Column:
    """A value whose JSON is the same for equal rows: keys of objects sorted at every depth, maps in key order, numbers that aren't finite
    as objects, so that NaN and the text `NaN` differ."""
    if isinstance(kind, T.StructType):
        inner = F.struct(*[canonical(value[f.name], f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: f.name)])
        return F.when(value.isNotNull(), inner) if kind.fields else value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform(F.array_sort(F.map_entries(value)), lambda e: F.struct(e["key"].alias("key"), canonical(e["value"], kind.valueType).alias("value")))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = F.when(finite(value), value)
        return F.when(value.isNotNull(), F.struct(number.alias("number"), F.when(~finite(value), value.cast("string")).alias("special")))
    return value


def row_digest(df: DataFrame, *columns: str) -> Column:
    """SHA-256 of a row's columns as canonical JSON: keys sorted at every depth, nulls absent."""
    return F.sha2(F.to_json(F.struct(*[canonical(F.col(f"`{c}`"), df.schema[c].dataType).alias(c) for c in sorted(columns)])), 256)


def safe_name(name: str) -> str:
    """A table name: lower case, everything but letters and digits as one underscore."""
    import re

    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def likeness(suggestion: Column, value: Column) -> Column:
    """How alike two texts are, from 0 to 1: twice the letters in matching blocks over all letters. Blocks are the longest common stretch (the
    leftmost of equals), then those to its left and to its right, in turn."""

    @F.arrow_udf("double")
    def ratio(members: pa.Array, values: pa.Array) -> pa.Array:
        blocks, found = SequenceMatcher(), []
        for member, other in zip(members, values, strict=True):
            # what belongs to the second text is kept from row to row
            if blocks.b != (text := other.as_py()):
                blocks.set_seq2(text)
            blocks.set_seq1(member.as_py())
            found.append(blocks.ratio())
        return pa.array(found, pa.float64())

    return ratio(suggestion, value)


def _letters(text: Column) -> Column:
    """Map from letter to how often a text has it."""
    each = F.filter(F.split(text, ""), lambda c: c != "")
    return F.map_from_entries(F.transform(F.array_distinct(each), lambda c: F.struct(c, F.size(F.filter(each, lambda x: x == c)))))


def suggestions(unknown: DataFrame, domain: DataFrame, value: str, least: float = 0.6, most: int = 3) -> DataFrame:
    """value, suggestion, likeness, place: up to `most` like members of a domain for values outside it, by likeness, then the later name.

    Every distinct value meets the members of a length that allows the likeness (a join on the length), and of these, blocks are matched for pairs whose
    letters in common, in any order, allow it. Both bounds are exact, so no pair that is alike is left out."""
    values = unknown.select(F.col(value).alias("value")).where(F.col("value").isNotNull()).distinct().withColumn("length", F.length("value")).withColumn("has", _letters(F.col("value")))
    n = F.length("suggestion")
    members = domain.select(F.col(value).alias("suggestion")).where(F.col("suggestion").isNotNull()).distinct().withColumn("letters", _letters(F.col("suggestion")))
    # 2 min(m, n) / (m + n) >= least
    shortest, longest = F.floor(n * least / (2 - least)).cast("int"), F.ceil(n * (2 - least) / least).cast("int")
    members = members.withColumn("n", n).withColumn("length", F.explode(F.sequence(shortest, longest)))
    common = F.aggregate(F.map_entries("letters"), F.lit(0), lambda s, e: s + F.least(e["value"], F.coalesce(F.try_element_at("has", e["key"]), F.lit(0))))
    bound = F.when(F.col("n") + F.col("length") == 0, 1.0).otherwise(2.0 * common / (F.col("n") + F.col("length")))
    near = values.join(members, "length").where(bound >= least).select("value", "suggestion").withColumn("likeness", likeness(F.col("suggestion"), F.col("value"))).where(F.col("likeness") >= least)
    order = Window.partitionBy("value").orderBy(F.col("likeness").desc(), F.col("suggestion").desc())
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def not_in_domain(value: str, domain: list[str], name: str, least: float = 0.6, most: int = 3) -> str:
    """What to tell of a value that isn't in a short list: up to `most` like members, if there are any."""
    like = get_close_matches(value, domain, n=most, cutoff=least)
    return f"{value!r} is not one of the {name}." + (f" Did you mean: {', '.join(like)}?" if like else "")


def stabilised(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns as numbers where every value of the column is one, else as they are. One pass over the data decides."""
    tests = [c for n in columns for c in (F.min(F.col(n).try_cast("double").isNotNull() | F.col(n).isNull()).alias(f"n_{n}"), F.min(F.col(n).try_cast("long").isNotNull() | F.col(n).isNull()).alias(f"i_{n}"), F.count(n).alias(f"c_{n}"))]
    seen = df.agg(*tests).first()
    kind = lambda n: None if not seen[f"c_{n}"] or not seen[f"n_{n}"] else T.LongType() if seen[f"i_{n}"] else T.DoubleType()
    return df.select(*[F.col(c).cast(kind(c)).alias(c) if c in columns and kind(c) else F.col(c) for c in df.columns])
