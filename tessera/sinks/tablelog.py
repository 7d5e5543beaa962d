"""Tables whose content a log decides, so that what is written becomes visible in one step, for one table or for several.

    root/data/<table>/<part>/   Parquet of one finished job; nobody reads it until an entry of the log lists it
    root/_log/<version>.json    one entry: all tables as of that version, with their parts, rows and schema

A change writes its parts anywhere first, then puts one entry in place by a rename that fails if another writer had the version. A job that broke off leaves parts that
no entry lists, and readers, which take their parts from the newest entry, never see them. `vacuum` removes them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sinks.tables import PromotionError


class Conflict(RuntimeError):
    """Another writer has put the next version in place."""


@dataclass(frozen=True)
class Table:
    schema: str
    parts: tuple[str, ...] = ()
    rows: int = 0
    #: part -> column -> its name in the files, where that is another
    renamed: dict[str, dict[str, str]] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Snapshot:
    """All tables as of a version, and the last batch that each stream has committed."""

    version: int = -1
    tables: dict[str, Table] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)

    def with_part(self, name: str, part: Table, fresh: bool = False) -> Snapshot:
        """This with a part added to a table, or in place of its parts."""
        old = self.tables.get(name)
        if old is None or fresh:
            return replace(self, tables=self.tables | {name: part})
        if [(f.name, f.dataType) for f in old.struct] != [(f.name, f.dataType) for f in part.struct]:
            raise PromotionError(f"{name} has other columns than the rows to append")
        return replace(self, tables=self.tables | {name: Table(old.schema, old.parts + part.parts, old.rows + part.rows, old.renamed | part.renamed)})

    def without(self, *names: str) -> Snapshot:
        return replace(self, tables={n: t for n, t in self.tables.items() if n not in names})


class TableLog:
    """The tables under a folder that all nodes share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    # reading

    def versions(self) -> list[int]:
        at = self._path(f"{self.root}/_log")
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json"))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The tables as of a version; the newest by default, none before the first."""
        if version is None:
            there = self.versions()
            if not there:
                return Snapshot()
            version = there[-1]
        stream = self._fs.open(self._path(self._entry(version)))
        try:
            said = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Snapshot(version, {n: Table(t["schema"], tuple(t["parts"]), t["rows"], t["renamed"]) for n, t in said["tables"].items()}, said["streams"])

    def read(self, name: str, at: Snapshot | None = None) -> DataFrame:
        """A table as of a snapshot. Several tables of one snapshot are of one age."""
        table = (at or self.snapshot()).tables[name]
        if not table.parts:
            return self.spark.createDataFrame([], table.struct)
        alike: dict[tuple, list[str]] = {}
        for part in table.parts:
            alike.setdefault(tuple(sorted(table.renamed.get(part, {}).items())), []).append(part)
        return reduce(lambda a, b: a.unionByName(b), [self._files(table.struct, parts, dict(names)) for names, parts in alike.items()])

    def _files(self, struct: T.StructType, parts: list[str], names: dict[str, str]) -> DataFrame:
        stored = T.StructType([T.StructField(names.get(f.name, f.name), f.dataType, True, f.metadata) for f in struct])
        df = self.spark.read.schema(stored).parquet(*[f"{self.root}/{p}" for p in parts])
        return df.select(*[F.col(f"`{s.name}`").alias(f.name, metadata=f.metadata) for s, f in zip(stored, struct, strict=True)])

    # writing

    def stage(self, df: DataFrame, name: str) -> Table:
        """df written as a part that no entry lists yet."""
        part = f"data/{name}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{part}")
        return self._counted(part, df.schema)

    def stage_split(self, df: DataFrame, column: str, shapes: dict[str, T.StructType], names: dict[str, dict[str, str]] | None = None) -> dict[str, Table]:
        """df written in one pass as a part for each value of `column` that has rows. shapes: value -> its table's columns; names: value -> column -> its name in df, where that
        is another."""
        part = f"data/_split/{uuid.uuid4().hex}"
        df.write.partitionBy(column).parquet(f"{self.root}/{part}")
        there = {s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{part}"))}
        other = {v: {c: n for c, n in (names or {}).get(v, {}).items() if c != n} for v in shapes}
        return {v: self._counted(f"{part}/{column}={v}", shape, other[v]) for v, shape in shapes.items() if f"{column}={v}" in there}

    def empty(self, struct: T.StructType) -> Table:
        """A table without rows."""
        return Table(json.dumps(_nullable(struct).jsonValue()))

    def _counted(self, part: str, struct: T.StructType, names: dict[str, str] | None = None) -> Table:
        rows = self.spark.read.schema(struct).parquet(f"{self.root}/{part}").count()
        return Table(self.empty(struct).schema, (part,), rows, {part: names} if names else {})

    def commit(self, changed: Snapshot) -> Snapshot:
        """`changed`, made from a snapshot, as the version after it; Conflict if there is one already."""
        version = changed.version + 1
        said = {"tables": {n: {"schema": t.schema, "parts": list(t.parts), "rows": t.rows, "renamed": t.renamed} for n, t in sorted(changed.tables.items())}, "streams": changed.streams}
        draft = f"{self.root}/_log/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(draft), True)
        try:
            out.write(bytearray(json.dumps(said, indent=1).encode()))
        finally:
            out.close()
        self._placed(draft, version)
        return replace(changed, version=version)

    def _placed(self, draft: str, version: int) -> None:
        """The draft as the entry of a version, in one step that fails if the entry is there."""
        to, jvm = self._path(self._entry(version)), self._jvm
        try:
            if self._fs.getUri().getScheme() == "file":
                # a local rename replaces what is there
                link, target = (jvm.java.nio.file.Paths.get(self._fs.makeQualified(p).toUri()) for p in (to, self._path(draft)))
                jvm.java.nio.file.Files.createLink(link, target)
            else:
                kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                never_over = self.spark.sparkContext._gateway.new_array(kind, 1)
                never_over[0] = kind.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(self._path(draft), to, never_over)
        except Exception as e:
            if self._fs.exists(to):
                raise Conflict(f"version {version} of {self.root} is there already") from e
            raise
        finally:
            self._fs.delete(self._path(draft), False)

    def _entry(self, version: int) -> str:
        return f"{self.root}/_log/{version:020d}.json"

    def change(self, make: Callable[[Snapshot], Snapshot], tries: int = 50) -> Snapshot:
        """make(newest snapshot) committed; made again if another writer was faster."""
        for left in range(tries, 0, -1):
            try:
                base = self.snapshot()
                wanted = make(base)
                return base if wanted is base else self.commit(wanted)
            except Conflict:
                if left == 1:
                    raise
        raise AssertionError

    def append(self, name: str, df: DataFrame) -> Snapshot:
        part = self.stage(df, name)
        return self.change(lambda s: s.with_part(name, part))

    def append_new(self, frames: dict[str, DataFrame], key: str, stream: str = "", batch: int = -1) -> Snapshot:
        """Append rows to several tables in one step, but for those whose key was appended before; rows without a key are always added.

        The table `_keys_<first table>` holds one row for each key and gets its rows in the same entry, so a batch that broke off anywhere has added nothing, and one that
        runs again adds nothing. A batch that its stream has committed already isn't looked at."""

        held, staged = f"_keys_{next(iter(frames))}", {}

        def stage_all(base: Snapshot) -> dict[str, Table]:
            known = self.read(held, base) if held in base.tables else None
            parts, keys = {}, []
            for name, df in frames.items():
                parts[name] = self.stage(df.join(known, df[key] == known["key"], "left_anti") if known is not None else df, name)
                keys.append(df.select(F.col(key).alias("key")).where("key is not null"))
            every = reduce(lambda a, b: a.unionByName(b), keys).distinct()
            parts[held] = self.stage(every.join(known, "key", "left_anti") if known is not None else every, held)
            return parts

        def make(base: Snapshot) -> Snapshot:
            if stream and base.streams.get(stream, -1) >= batch >= 0:
                return base
            # what is staged stays good if another writer changed other tables only
            seen = base.tables[held].parts if held in base.tables else ()
            if seen not in staged:
                staged[seen] = stage_all(base)
            changed = base
            for name, part in staged[seen].items():
                changed = changed.with_part(name, part)
            return replace(changed, streams=changed.streams | ({stream: batch} if stream else {}))

        return self.change(make)

    def promote(self, tables: dict[str, DataFrame], primary: str, owned: tuple[str, ...] = ()) -> Snapshot:
        """A collection's tables in place of the ones before, all in one step: readers see the whole old set or the whole new one.

        The set must hold the primary table, and side tables among `owned` only; owned tables that it doesn't hold go. If anything fails, the log
        is as it was, and what was staged is removed; where that fails too, it stays, and the error says where."""
        check_set(set(tables), primary, owned)
        staged: dict[str, Table] = {}
        try:
            for name, df in tables.items():
                staged[name] = self.stage(df, name)
            return self.replace_all(staged, primary, owned)
        except BaseException as e:
            self._discard([p for t in staged.values() for p in t.parts], e)
            raise

    def replace_all(self, staged: dict[str, Table], primary: str, owned: tuple[str, ...]) -> Snapshot:
        """Staged tables in place of a collection's, in one step."""
        check_set(set(staged), primary, owned)

        def make(base: Snapshot) -> Snapshot:
            changed = base.without(primary, *owned)
            for name, part in staged.items():
                changed = changed.with_part(name, part, fresh=True)
            return changed

        return self.change(make)

    def _discard(self, parts: list[str], error: BaseException) -> None:
        """Remove staged parts, unless the log lists them after all, as when the writer broke off just behind its entry."""
        for part in parts:
            try:
                listed = {p for v in self.versions()[-1:] for t in self.snapshot(v).tables.values() for p in t.parts}
                if part not in listed:
                    self._fs.delete(self._path(f"{self.root}/{part}"), True)
            except Exception:
                error.add_note(f"what was staged could not be removed and stays at {self.root}/{part}")

    # upkeep

    def compact(self, name: str, most: int = 1) -> Snapshot:
        """A table of more than `most` parts as one part; its rows stay the same."""

        def make(base: Snapshot) -> Snapshot:
            table = base.tables[name]
            if len(table.parts) <= most:
                return base
            return base.with_part(name, self.stage(self.read(name, base).repartition(max(1, len(table.parts) // 8)), name), fresh=True)

        return self.change(make)

    def vacuum(self, keep: int = 1, seconds: float = 86_400) -> list[str]:
        """Remove all but the last `keep` entries, and parts that none of these lists and that are older than `seconds`, as a writer may be about to list a younger one."""
        versions = self.versions()
        gone, kept = versions[:-keep], versions[-keep:]
        listed = {p for v in kept for t in self.snapshot(v).tables.values() for p in t.parts}
        for version in gone:
            self._fs.delete(self._path(self._entry(version)), False)
        removed = []
        for part in self._parts():
            status = self._fs.getFileStatus(self._path(f"{self.root}/{part}"))
            if not any(p == part or p.startswith(f"{part}/") for p in listed) and status.getModificationTime() < (time.time() - seconds) * 1000:
                self._fs.delete(status.getPath(), True)
                removed.append(part)
        return removed

    def _parts(self) -> list[str]:
        below = lambda folder: [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}"))] if self._fs.exists(self._path(f"{self.root}/{folder}")) else []
        return [f"data/{name}/{part}" for name in below("data") for part in below(f"data/{name}")]


def _nullable(struct: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in struct])


def check_set(produced: set[str], primary: str, owned: tuple[str, ...]) -> None:
    if primary not in produced:
        raise PromotionError(f"no table {primary}")
    if odd := sorted(produced - {primary, *owned}):
        raise PromotionError(f"unexpected tables: {odd}")
