"""A small schema language for nested, polymorphic records, and the flat shape that follows from it.

A schema names classes with slots. A slot's range is a type or a class; class-range slots hold objects (inlined) or ids. What a
class flattens to is worked out once, on the driver, as a list of FlatColumn; operators.flatten turns these into column
expressions. Schemas have tens to hundreds of classes, so plain dataclasses do.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_LONG, _DOUBLE, _BOOLEAN, _STRING = T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType()
BASE_TYPES: dict[str, T.DataType] = {"integer": _LONG, "int": _LONG, "long": _LONG, "float": _DOUBLE, "double": _DOUBLE, "decimal": _DOUBLE, "boolean": _BOOLEAN}


@dataclass(frozen=True)
class Slot:
    name: str
    range: str = "string"
    multivalued: bool = False
    inlined: bool | None = None
    identifier: bool = False
    required: bool = False
    designates_type: bool = False
    description: str = ""
    pattern: str = ""
    enum: tuple[str, ...] = ()


@dataclass(frozen=True)
class ClassSpec:
    name: str
    slots: tuple[Slot, ...] = ()
    is_a: str | None = None
    mixins: tuple[str, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class FlatColumn:
    """One column of a flat table: where its value is (path below the record), its type, and which classes have it.

    guards: for each level of nesting, the path of the object and the classes that may stand there for the value to count."""

    name: str
    path: tuple[str, ...]
    type: T.DataType
    multivalued: bool = False
    reference: bool = False
    required: bool = False
    identifier: bool = False
    designates_type: bool = False
    comment: str = ""
    pattern: str = ""
    enum: tuple[str, ...] = ()
    guards: tuple[tuple[tuple[str, ...], str, frozenset[str]], ...] = ()

    def field(self) -> T.StructField:
        kind = T.ArrayType(self.type) if self.multivalued else self.type
        return T.StructField(self.name, kind, True, {"comment": self.comment} if self.comment else {})


class SchemaError(ValueError):
    pass


@dataclass
class Schema:
    classes: dict[str, ClassSpec]
    types: dict[str, str] = field(default_factory=dict)  # custom type -> type it is based on
    name: str = "schema"
    version: str = ""

    @classmethod
    def of(cls, *classes: ClassSpec, types: dict[str, str] | None = None, name: str = "schema", version: str = "") -> Schema:
        if len(found := {c.name: c for c in classes}) < len(classes):
            raise SchemaError("a class is defined twice")
        return cls(found, types or {}, name, version)

    @classmethod
    def from_dict(cls, spec: dict) -> Schema:
        """From what a YAML or JSON file with `classes` (each with `slots`, `is_a`, `mixins`) and `types` holds."""
        classes = [
            ClassSpec(n, tuple(Slot(s, **{**(d or {}), "enum": tuple((d or {}).get("enum", ()))}) for s, d in (c.get("slots") or {}).items()), c.get("is_a"), tuple(c.get("mixins", ())), c.get("description", ""))
            for n, c in spec["classes"].items()
        ]
        return cls.of(*classes, types=spec.get("types"), name=spec.get("name", "schema"), version=str(spec.get("version", "")))

    def parents(self, name: str) -> list[str]:
        spec = self.classes[name]
        return [p for p in (spec.is_a, *spec.mixins) if p]

    def slots(self, name: str, _seen: frozenset = frozenset()) -> dict[str, Slot]:
        """All slots of a class: inherited ones first, its own overriding them."""
        if name in _seen:
            raise SchemaError(f"class {name} is its own ancestor")
        found: dict[str, Slot] = {}
        for parent in self.parents(name):
            found |= self.slots(parent, _seen | {name})
        return found | {s.name: s for s in self.classes[name].slots}

    def descendants(self, name: str) -> list[str]:
        """The class and all that derive from it (mixins count), itself first."""
        below, waiting = {name}, [name]
        while waiting:
            here = waiting.pop()
            for c in self.classes:
                if c not in below and here in self.parents(c):
                    below.add(c)
                    waiting.append(c)
        return [name, *sorted(below - {name})]

    def is_class(self, range_: str) -> bool:
        return range_ in self.classes

    def has_identifier(self, name: str) -> bool:
        return any(s.identifier for s in self.slots(name).values())

    def inlined(self, slot: Slot) -> bool:
        """What the slot says, else whether objects of its class have no identifier to refer to them by."""
        if not self.is_class(slot.range):
            return False
        return slot.inlined if slot.inlined is not None else not self.has_identifier(slot.range)

    def type_of(self, range_: str) -> T.DataType:
        """The physical type of a range, through chains of custom types; enumerations and the unknown are strings."""
        seen: set[str] = set()
        while range_ in self.types and range_ not in seen:
            seen.add(range_)
            range_ = self.types[range_]
        return BASE_TYPES.get(range_, _STRING)

    def classes_with(self, slot: str) -> frozenset[str]:
        return frozenset(c for c in self.classes if slot in self.slots(c))

    def collections(self, root: str = "Database") -> dict[str, str]:
        """Collection -> class, from the multivalued class-range slots of the root class."""
        return {s.name: s.range for s in self.slots(root).values() if s.multivalued and self.is_class(s.range)}

    # -- the flat shape ---------------------------------------------------------------------------------------------------------

    def _leaf(self, slot: Slot, name: str, path: tuple[str, ...], guards, comment: str, top: bool) -> FlatColumn:
        return FlatColumn(
            name, path, self.type_of(slot.range), slot.multivalued, False, top and slot.required, top and slot.identifier, top and slot.designates_type, comment or slot.description, slot.pattern, slot.enum, guards
        )

    def _inside(self, slot: Slot, prefix: str, path: tuple[str, ...], guards, depth: int) -> list[FlatColumn]:
        """Columns of the object in `slot`: its own scalars, and at the first level those of objects in it."""
        found: dict[str, FlatColumn] = {}
        for c in self.descendants(slot.range):
            for sub in self.slots(c).values():
                name = f"{prefix}_{sub.name}"
                if sub.name == "type" or sub.designates_type:
                    continue
                here = (*guards, (path, slot.range, self.classes_with(sub.name)))
                note = f"From {'.'.join((*path, sub.name))}."
                if not self.is_class(sub.range):
                    found.setdefault(name, self._leaf(sub, name, (*path, sub.name), here, note, False))
                elif depth == 1 and not sub.multivalued:
                    for deep in self._inside(sub, name, (*path, sub.name), here, 2):
                        found.setdefault(deep.name, deep)
        return list(found.values())

    def flat_columns(self, name: str, child: bool = False) -> list[FlatColumn]:
        """The columns of a class's primary table: base slots, then those that only subclasses have. A child table
        (of objects in lists) also takes objects apart that are held where the schema has references."""
        found: dict[str, tuple[FlatColumn, tuple[str, ...]]] = {}
        for c in self.descendants(name):
            inherited = c == name
            for slot in self.slots(c).values():
                guards = (((), name, self.classes_with(slot.name)),)
                note = slot.description if inherited else f"{slot.description} Only in {c}.".strip()
                if not self.is_class(slot.range):
                    columns = [self._leaf(slot, slot.name, (slot.name,), guards, note, inherited)]
                elif slot.multivalued:
                    columns = [] if self.inlined(slot) else [FlatColumn(slot.name, (slot.name,), _STRING, True, True, comment=f"{note} Ids of {slot.range}.".strip(), guards=guards)]
                elif self.inlined(slot):
                    columns = self._inside(slot, slot.name, (slot.name,), guards, 1)
                else:
                    columns = [FlatColumn(slot.name, (slot.name,), _STRING, False, True, inherited and slot.required, comment=f"{note} Id of {slot.range}.".strip(), guards=guards)]
                    columns += self._inside(slot, slot.name, (slot.name,), guards, 2) if child else []
                for column in columns:
                    first = found.setdefault(column.name, (column, column.path))
                    if first[1] != column.path:
                        raise SchemaError(f"{name}: {'.'.join(first[1])} and {'.'.join(column.path)} would both be column {column.name}")
        ids = [k for k, (c, _) in found.items() if c.identifier]
        return [found[k][0] for k in [*ids, *sorted(set(found) - set(ids))]]

    def flat_struct(self, name: str) -> T.StructType:
        return T.StructType([c.field() for c in self.flat_columns(name)])

    def list_slots(self, name: str) -> list[tuple[Slot, frozenset[str]]]:
        """Multivalued class-range slots of a class and its descendants, by name, with the classes that have each."""
        below = self.descendants(name)
        found: dict[str, Slot] = {}
        for c in below:
            for s in self.slots(c).values():
                if s.multivalued and self.is_class(s.range):
                    found.setdefault(s.name, s)
        return [(found[n], frozenset(c for c in below if n in self.slots(c))) for n in sorted(found)]

    def database(self, root: str = "Database") -> dict[str, T.StructType]:
        """Table -> struct for every collection and side table."""
        tables: dict[str, T.StructType] = {}
        for collection, c in sorted(self.collections(root).items()):
            wanted = {collection: self.flat_struct(c)}
            for slot, _ in self.list_slots(c):
                wanted[f"{collection}_{slot.name}"] = self.side_struct(slot)
            if clash := wanted.keys() & tables.keys():
                raise SchemaError(f"table {sorted(clash)[0]} is defined twice")
            tables |= wanted
        return tables

    def side_struct(self, slot: Slot) -> T.StructType:
        parent = T.StructField("parent_id", _STRING, False, {"comment": "Id of the record that holds this row."})
        if not self.inlined(slot):
            return T.StructType([parent, T.StructField(slot.name, _STRING)])
        columns = [c.field() for c in self.flat_columns(slot.range, child=True) if c.name not in ("parent_id", "type")]
        return T.StructType([parent, T.StructField("type", _STRING), *columns])
