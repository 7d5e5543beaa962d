"""Flattening nested records, as projections only: no shuffle, no UDF.

Records come as one VARIANT column (`records`), so that a lone value where a list is declared, a number in a string or an object in
place of an id don't lose the row. A record's class is the part of its `type` after the last colon, if the schema knows it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schema import FlatColumn, Schema, Slot
from tessera.session import written

_SQL = {T.LongType(): "long", T.DoubleType(): "double", T.BooleanType(): "boolean", T.StringType(): "string"}


def records(df: DataFrame, raw: str = "raw", name: str = "record") -> DataFrame:
    """df with its JSON text as a VARIANT column; text that isn't JSON gives null."""
    return df.withColumn(name, F.try_parse_json(raw))


def parsed_once(df: DataFrame, record: str = "record") -> DataFrame:
    """The records as a VARIANT table in the shared folder: each table made of a collection reads that, and the JSON is made and parsed once."""
    return written(df.select(record))


def _path(path: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{p}']" for p in path)


def value_at(record: Column, path: tuple[str, ...], kind: str) -> Column:
    return F.try_variant_get(record, _path(path), kind)


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))


def class_of(record: Column, path: tuple[str, ...], declared: str, known: frozenset[str]) -> Column:
    """Class of the object at `path`: what its `type` says after the last colon if that is known, else the declared one."""
    said = F.element_at(F.split(value_at(record, (*path, "type"), "string"), ":"), -1)
    return F.when(said.isin(*sorted(known)), said).otherwise(F.lit(declared))


def _number(record: Column, path: tuple[str, ...], kind: str, strict: bool) -> Column:
    """A number or boolean. Integers must be whole; with `strict`, what is neither absent nor a number fails the job."""
    raw = value_at(record, path, "string")
    got = raw.try_cast("double" if kind == "long" else kind)
    if kind == "long":
        exact = raw.try_cast("long")
        got = F.coalesce(exact, F.when(got == F.floor(got), got.try_cast("long")))
    if not strict:
        return got
    return F.when(raw.isNotNull() & got.isNull(), F.raise_error(F.concat(F.lit(f"{'.'.join(path)} is not a {kind}: "), raw)).cast(kind)).otherwise(got)


def _scalar(record: Column, column: FlatColumn, strict: bool) -> Column:
    kind = _SQL[column.type]
    if column.reference:
        return F.coalesce(value_at(record, (*column.path, "id"), "string"), value_at(record, column.path, "string"))
    return value_at(record, column.path, "string") if kind == "string" else _number(record, column.path, kind, strict)


def _list(record: Column, column: FlatColumn, strict: bool) -> Column:
    kind = _SQL[column.type]
    many = F.try_variant_get(record, _path(column.path), "array<variant>")
    if column.reference:
        each = lambda v: F.coalesce(F.try_variant_get(v, "$.id", "string"), F.try_variant_get(v, "$", "string"))
        return F.coalesce(F.transform(many, each), _wrapped(_scalar(record, column, strict)))
    return F.coalesce(F.try_variant_get(record, _path(column.path), f"array<{kind}>"), _wrapped(_scalar(record, column, strict)))


def _wrapped(value: Column) -> Column:
    return F.when(value.isNotNull(), F.array(value))


def expression(record: Column, column: FlatColumn, known: frozenset[str], strict: bool = True, root: str | None = None, allowed: frozenset[str] | None = None) -> Column:
    """The value of a flat column, null where the classes on the way don't have it. allowed: the classes that a record may
    say it is (all known ones by default)."""
    value = _list(record, column, strict) if column.multivalued else _scalar(record, column, strict)
    for path, declared, classes in column.guards:
        at_root = not path
        names = (allowed if at_root and allowed is not None else known) & known
        if names <= classes and declared in classes:
            continue
        value = F.when(class_of(record, path, root if at_root and root else declared, names).isin(*sorted(classes)), value)
    return value


def primary(df: DataFrame, schema: Schema, cls: str, record: str = "record", strict: bool = True) -> DataFrame:
    """The primary table of a class: one row for each record, columns of the class and all its subclasses."""
    known = frozenset(schema.classes)
    columns = [expression(F.col(record), c, known, strict).alias(c.name, metadata={"comment": c.comment} if c.comment else {}) for c in schema.flat_columns(cls)]
    return df.select(*columns)


def _list_elements(record: Column, slot: str) -> Column:
    one = F.try_variant_get(record, f"$['{slot}']", "variant")
    return F.coalesce(F.try_variant_get(record, f"$['{slot}']", "array<variant>"), F.when(one.isNotNull() & (F.schema_of_variant(one) != "VOID"), F.array(one)))


def side_table(df: DataFrame, schema: Schema, cls: str, slot: Slot, classes: frozenset[str], record: str = "record", strict: bool = True) -> DataFrame:
    """Rows of one list slot: ids (junction) or flattened objects (child), each with the id of its record. Records without an id
    give none."""
    key = next((s.name for s in schema.slots(cls).values() if s.identifier), "id")
    below = frozenset(schema.descendants(cls))
    parent = value_at(F.col(record), (key,), "string")
    here = df.where(parent.isNotNull() & (parent != ""))
    if not below <= classes:
        here = here.where(class_of(F.col(record), (), cls, below).isin(*sorted(classes)))
    rows = here.select(parent.alias("parent_id"), F.explode(_list_elements(F.col(record), slot.name)).alias("element"))
    if not schema.inlined(slot):
        ids = F.coalesce(F.try_variant_get("element", "$.id", "string"), F.try_variant_get("element", "$", "string"))
        return rows.select("parent_id", ids.alias(slot.name)).where(F.col(slot.name).isNotNull())
    known = frozenset(schema.classes)
    columns = [expression(F.col("element"), c, known, strict).alias(c.name) for c in schema.flat_columns(slot.range, child=True) if c.name not in ("parent_id", "type")]
    return rows.where(is_object(F.col("element"))).select("parent_id", F.try_variant_get("element", "$.type", "string").alias("type"), *columns)


def side_tables(df: DataFrame, schema: Schema, cls: str, collection: str, record: str = "record", strict: bool = True) -> dict[str, DataFrame]:
    """`<collection>_<slot>` -> side table, for every list slot of the class and its subclasses."""
    return {f"{collection}_{slot.name}": side_table(df, schema, cls, slot, classes, record, strict) for slot, classes in schema.list_slots(cls)}


def table_shapes(schema: Schema, cls: str, collection: str) -> dict[str, T.StructType]:
    """Table -> its columns, for the primary table of a collection and all its side tables."""
    return {collection: schema.flat_struct(cls)} | {f"{collection}_{slot.name}": schema.side_struct(slot) for slot, _ in schema.list_slots(cls)}


def stored_names(shapes: dict[str, T.StructType]) -> dict[str, dict[str, str]]:
    """Table -> column -> its name where all tables share one set of columns: its own, or one with a number where another table has the name with another type, as
    a list of ids in the primary table and an id in its junction table do."""
    kinds: dict[str, list[T.DataType]] = {}
    taken = {f.name.lower() for shape in shapes.values() for f in shape}
    names: dict[str, dict[str, str]] = {}
    for table, shape in shapes.items():
        names[table] = {}
        for f in shape:
            known = kinds.setdefault(f.name.lower(), [])
            if f.dataType not in known:
                known.append(f.dataType)
            n = known.index(f.dataType)
            name = f.name if not n else f"{f.name}__{n + 1}"
            while n and name.lower() in taken:
                name += "_"
            names[table][f.name] = name
    return names


def tagged_rows(df: DataFrame, schema: Schema, cls: str, collection: str, record: str = "record", strict: bool = True, tag: str = "table") -> DataFrame:
    """The rows of all tables of a collection from one pass over its records: `tag` names a row's table; columns are named as stored_names() says, null where other tables have
    them. A record gives one row of the primary table and one for each element of its lists."""
    shapes = table_shapes(schema, cls, collection)
    names = stored_names(shapes)
    wide = {names[t][f.name].lower(): (names[t][f.name], f.dataType) for t, shape in shapes.items() for f in shape}
    if tag.lower() in wide:
        raise ValueError(f"a table has a column {tag}")
    known, here = frozenset(schema.classes), F.col(record)

    def row(table: str, values: dict[str, Column]) -> Column:
        own = {names[table][n].lower(): v for n, v in values.items()}
        return F.struct(F.lit(table).alias(tag), *[own.get(k, F.lit(None)).cast(kind).alias(n) for k, (n, kind) in wide.items()])

    lists = [F.array(row(collection, {c.name: expression(here, c, known, strict) for c in schema.flat_columns(cls)}))]
    key = next((s.name for s in schema.slots(cls).values() if s.identifier), "id")
    below, parent = frozenset(schema.descendants(cls)), value_at(here, (key,), "string")
    for slot, classes in schema.list_slots(cls):
        has = parent.isNotNull() & (parent != "")
        if not below <= classes:
            has = has & class_of(here, (), cls, below).isin(*sorted(classes))
        rows = _side_rows(schema, slot, _list_elements(here, slot.name), parent, known, strict, partial(row, f"{collection}_{slot.name}"))
        lists.append(F.coalesce(F.when(has, rows), F.array()))
    return df.select(F.inline(F.flatten(F.array(*lists))))


def _side_rows(schema: Schema, slot: Slot, elements: Column, parent: Column, known: frozenset[str], strict: bool, row: Callable[[dict[str, Column]], Column]) -> Column:
    """The rows of a side table that one record's list gives."""
    if not schema.inlined(slot):
        ids = F.transform(elements, lambda e: F.coalesce(F.try_variant_get(e, "$.id", "string"), F.try_variant_get(e, "$", "string")))
        return F.transform(F.filter(ids, lambda i: i.isNotNull()), lambda i: row({"parent_id": parent, slot.name: i}))
    columns = [c for c in schema.flat_columns(slot.range, child=True) if c.name not in ("parent_id", "type")]
    return F.transform(F.filter(elements, is_object), lambda e: row({"parent_id": parent, "type": F.try_variant_get(e, "$.type", "string")} | {c.name: expression(e, c, known, strict) for c in columns}))


def flatten_all(collections: dict[str, DataFrame], schema: Schema, root: str = "Database", skip: tuple[str, ...] = (), record: str = "record") -> dict[str, DataFrame]:
    """All primary and side tables of a database. Nothing runs until a table is used."""
    tables: dict[str, DataFrame] = {}
    for name, cls in schema.collections(root).items():
        if name in collections and name not in skip:
            tables[name] = primary(collections[name], schema, cls, record)
            tables |= side_tables(collections[name], schema, cls, name, record)
    return tables


def run_all(collections: dict[str, DataFrame], schema: Schema, write: Callable[[str, DataFrame], int], root: str = "Database", skip: tuple[str, ...] = (), record: str = "record") -> list[dict]:
    """Flatten and write (write: table, rows -> number of rows) each collection, and say how it went: collection, status (written, skipped, absent or
    failed), error (the kind of exception only) and rows by table. Each is parsed once; side tables without rows aren't written. One that fails doesn't stop the others."""
    results = []
    for name, cls in schema.collections(root).items():
        status, error, rows = "skipped" if name in skip else "written" if name in collections else "absent", None, {}
        if status == "written":
            try:
                once = parsed_once(collections[name], record)
                rows[name] = write(name, primary(once, schema, cls, record))
                for table, side in side_tables(once, schema, cls, name, record).items():
                    if not side.isEmpty():
                        rows[table] = write(table, side)
            except Exception as e:
                status, error = "failed", type(e).__name__
        results.append({"collection": name, "status": status, "error": error, "rows": rows})
    return results


def dry_run(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows that each table would have; nothing is written."""
    return {name: df.count() for name, df in tables.items()}


# -- without a schema ------------------------------------------------------------------------------------------------------


def flatten_struct(df: DataFrame, controlled: tuple[str, ...] = (), skip: tuple[str, ...] = ("type",)) -> DataFrame:
    """A nested typed DataFrame as flat columns in alphabetical order.

    Scalars stay, lists of scalars are joined with a pipe, objects become `<field>_<sub>` (and `<field>_term_<sub>`), lists of objects
    with one field are joined sorted, other lists of objects become JSON. `controlled` fields keep has_raw_value, term.id
    and term.name only."""
    found: dict[str, Column] = {}
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if f.name in controlled and isinstance(f.dataType, T.StructType):
            wanted = {("has_raw_value",): "has_raw_value", ("term", "id"): "term_id", ("term", "name"): "term_name"}
            found |= {f"{f.name}_{n}": F.col(".".join((f.name, *p))) for p, n in wanted.items() if _has(f.dataType, p)}
        else:
            found |= _struct_columns(f.name, F.col(f.name), f.dataType, skip, 1)
    return df.select(*[found[n].alias(n) for n in sorted(found)])


def _has(kind: T.DataType, path: tuple[str, ...]) -> bool:
    return not path or (isinstance(kind, T.StructType) and path[0] in kind.names and _has(kind[path[0]].dataType, path[1:]))


def _struct_columns(name: str, value: Column, kind: T.DataType, skip: tuple[str, ...], depth: int) -> dict[str, Column]:
    if isinstance(kind, T.StructType):
        found: dict[str, Column] = {}
        for f in kind.fields:
            if f.name not in skip and (depth < 2 or not isinstance(f.dataType, T.StructType)):
                found |= _struct_columns(f"{name}_{f.name}", value[f.name], f.dataType, skip, depth + 1)
        return found
    if isinstance(kind, T.ArrayType):
        return {name: joined(value, kind)}
    return {name: value}


def joined(value: Column, kind: T.ArrayType) -> Column:
    """A list as text: scalars in order, objects of one field sorted, others as JSON with sorted keys."""
    element = kind.elementType
    if not isinstance(element, T.StructType):
        return F.array_join(value.cast("array<string>"), "|")
    if len(element.fields) == 1:
        return F.array_join(F.array_sort(F.transform(value, lambda x: x[element.fields[0].name].cast("string"))), "|")
    return F.to_json(_by_name(value, kind))


def _by_name(value: Column, kind: T.DataType) -> Column:
    """A value with the fields of its objects in name order, at every depth."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _by_name(x, kind.elementType))
    if isinstance(kind, T.StructType) and kind.fields:
        return F.when(value.isNotNull(), F.struct(*[_by_name(value[f.name], f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: f.name)]))
    return value
