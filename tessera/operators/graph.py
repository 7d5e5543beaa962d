"""Provenance walks over a typed, directed edge table (src, next_id, slot), as joins of DataFrames.

A walk is packed: origins are numbered in their order, 64 are the bits of one number, and a row is (node, block of origins, bits). A hop joins the frontier with the
edges, ORs the bits that meet at a node, and takes away those that were there before. Edges and what was reached lie in buckets of the keys they are joined on, so that a hop shuffles
its frontier and what it reaches, but neither the edges nor the nodes of earlier hops. Both lie in the shared checkpoint folder; only whether a frontier is empty comes to the driver.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_folder, written


def edges(parts: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """src, next_id, slot from (table, source column, target column, slot); links without an end are left out."""
    each = [t.select(F.col(s).cast("string").alias("src"), F.col(n).cast("string").alias("next_id"), F.lit(slot).alias("slot")) for t, s, n, slot in parts]
    return reduce(lambda a, b: a.unionByName(b), each).where(F.col("src").isNotNull() & F.col("next_id").isNotNull())


#: Edges of a bucket; fewer buckets than shuffle partitions only make sense for few edges.
BUCKET = 100_000


@dataclass(frozen=True)
class Reach:
    """What origins reach. packed: id, block, bits, hops, terminal, each (origin, id) in one row; names: block, origins (in the order of their bits)."""

    packed: DataFrame
    names: DataFrame

    def unpacked(self, packed: DataFrame, *columns: str) -> DataFrame:
        """One row for each origin in the bits of `packed`: origin and its columns."""
        set_bits = F.expr("filter(sequence(0, 63), i -> getbit(bits, i) = 1)")
        return packed.join(self.names, "block").select(F.explode(set_bits).alias("bit"), "origins", *columns).select(F.get("origins", F.col("bit")).alias("origin"), *columns)

    def rows(self) -> DataFrame:
        """origin, id, hops, terminal."""
        return self.unpacked(self.packed, "id", "hops", "terminal")

    def min_hops(self) -> DataFrame:
        """origin, terminal_id, n_hops."""
        return self.unpacked(self.packed.where("terminal").withColumnsRenamed({"id": "terminal_id", "hops": "n_hops"}), "terminal_id", "n_hops")

    def type_flags(self, node_types: DataFrame, flags: dict[str, str]) -> DataFrame:
        """origin and one boolean column for each configured type, for origins that meet a node with a type on the way; types are ORed before origins are unpacked."""
        met = self.packed.where("not terminal").join(node_types, "id").groupBy("block", "type").agg(F.bit_or("bits").alias("bits"))
        held = [F.coalesce(F.bit_or(F.when(F.col("type") == t, F.col("bits"))), F.lit(0)).alias(c) for t, c in flags.items()]
        blocks = met.groupBy("block").agg(F.bit_or("bits").alias("bits"), *held)
        each = blocks.join(self.names, "block").select("*", F.explode(F.expr("filter(sequence(0, 63), i -> getbit(bits, i) = 1)")).alias("bit"))
        return each.select(F.get("origins", F.col("bit")).alias("origin"), *[(F.getbit(c, "bit") == 1).alias(c) for c in flags.values()])


def _buckets(links: DataFrame) -> int:
    return min(int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")), links.count() // BUCKET + 1)


def _bucketed(df: DataFrame, name: str, path: str, buckets: int, *keys: str, by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*by).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)


def _step(frontier: DataFrame, pairs: DataFrame, seen: DataFrame | None, is_terminal: Column) -> DataFrame:
    """id, block, bits, terminal: what a hop reaches that wasn't reached before."""
    reached = frontier.join(pairs, F.col("id") == F.col("src")).groupBy(F.col("next_id").alias("id"), "block").agg(F.bit_or("bits").alias("bits"))
    if seen is not None:
        had = seen.groupBy("id", "block").agg(F.bit_or("bits").alias("had"))
        reached = reached.join(had, ["id", "block"], "left").select("id", "block", F.expr("bits & ~coalesce(had, 0L)").alias("bits")).where("bits <> 0")
    return reached.select("id", "block", "bits", is_terminal.alias("terminal"))


def reach(links: DataFrame, seeds: DataFrame, is_terminal: Column, max_depth: int = 15, buckets: int | None = None) -> Reach:
    """What each seed (origin) reaches, at the smallest number of hops.

    is_terminal: a condition on `id`; the walk doesn't go past such nodes. Cycles end, as a node counts once for an origin. An origin itself isn't reached, unless a cycle
    leads back to it. buckets: of the edges and of what was reached; by default one for each BUCKET edges, and the session's shuffle partitions at most."""
    spark = links.sparkSession
    n = buckets or _buckets(links)
    run, folder = f"walk_{uuid.uuid4().hex}", f"{shared_folder(spark)}/tables"
    known = seeds.select(F.col("origin").cast("string").alias("origin")).where("origin is not null").distinct().orderBy("origin").withColumn("number", F.monotonically_increasing_id())
    # written, as the numbers must stay; origins of one order stand in one block, as they often reach the same
    known = written(known.select("origin", F.expr("shiftright(number, 6)").alias("block"), F.expr("cast(number & 63 as int)").alias("bit")))
    names = written(known.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("bit", "origin"))), lambda x: x["origin"]).alias("origins")))
    links_at, seen_at = f"{folder}/{run}_links", f"{folder}/{run}_seen"
    made = []
    try:
        made.append(f"{run}_links")
        _bucketed(links.select("src", "next_id").repartition(n, "src").distinct(), made[-1], links_at, n, "src")
        pairs = spark.table(made[-1])
        frontier, seen = known.select(F.col("origin").alias("id"), "block", F.expr("shiftleft(1L, bit)").alias("bits")), None
        for hop in range(1, max_depth + 1):
            new = _step(frontier, pairs, seen, is_terminal).withColumn("hops", F.lit(hop))
            if hop == 1:
                made.append(f"{run}_seen")
            _bucketed(new, made[-1], seen_at, n, "id", "block", by=("hops",))
            seen = spark.table(made[-1])
            latest = seen.where(F.col("hops") == hop)
            if latest.isEmpty():
                break
            frontier = latest.where("not terminal").select("id", "block", "bits")
        shape = "id string, block long, bits long, terminal boolean, hops int"
        packed = spark.read.schema(shape).parquet(seen_at).select("id", "block", "bits", "hops", "terminal") if made[1:] else spark.createDataFrame([], shape)
    finally:
        # the files stay where they are
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return Reach(packed, names)


def walk(links: DataFrame, seeds: DataFrame, is_terminal: Column, max_depth: int = 15) -> DataFrame:
    """origin, id, hops, terminal: reach(), unpacked."""
    return reach(links, seeds, is_terminal, max_depth).rows()


def walk_recursive(spark: SparkSession, links: DataFrame, seeds: DataFrame, is_terminal: Column, max_depth: int = 15) -> DataFrame:
    """origin, id, hops of terminals, by a recursive query. It keeps no set of seen nodes, so it suits graphs with few paths.

    The recursion starts from the nodes that origins link to, each once however many origins share it, and origins are joined to what these reach. LIMIT ALL lifts Spark's bound
    on the rows of a recursion (spark.sql.cteRecursionRowLimit, 1,000,000 unless set). is_terminal: as in walk(), a condition on `id`, worked out for each link's end before the
    recursion."""
    n = _buckets(links)
    name = f"walk_{uuid.uuid4().hex}_ends"
    try:
        ends = links.select("src", F.col("next_id").alias("id")).repartition(n, "src").distinct().withColumn("terminal", is_terminal)
        _bucketed(ends, name, f"{shared_folder(spark)}/tables/{name}", n, "src")
        ends = spark.table(name)
        first = written(seeds.select(F.col("origin").cast("string").alias("src")).distinct().join(ends, "src").select(F.col("src").alias("origin"), "id", "terminal"))
        starts = first.where("not terminal").select("id").distinct()
        query = """
            WITH RECURSIVE reach(start, node, hops, over) MAX RECURSION LEVEL {levels} AS (
                SELECT id, id, 1, false FROM {starts}
                UNION ALL
                SELECT reach.start, ends.id, reach.hops + 1, ends.terminal FROM reach JOIN {ends} AS ends ON ends.src = reach.node
                WHERE reach.hops < {depth} AND NOT reach.over)
            SELECT start, node, min(hops) AS hops FROM (SELECT * FROM reach LIMIT ALL) WHERE over GROUP BY start, node"""
        found = written(spark.sql(query, starts=starts, ends=ends, depth=max_depth, levels=max_depth + 1))
    finally:
        # the files stay where they are
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    # a first link may be the last; hops beyond max_depth are only there if it is 0
    near = first.where("terminal").select("origin", "id", F.lit(1).alias("hops"))
    far = first.where("not terminal").join(found, F.col("id") == F.col("start")).select("origin", F.col("node").alias("id"), "hops")
    return near.union(far).where(F.col("hops") <= max_depth).groupBy("origin", "id").agg(F.min("hops").alias("hops"))


def min_hops(reached: DataFrame) -> DataFrame:
    """origin, terminal_id, n_hops."""
    return reached.where("terminal").groupBy("origin", F.col("id").alias("terminal_id")).agg(F.min("hops").alias("n_hops"))


def types_met(reached: DataFrame, node_types: DataFrame) -> DataFrame:
    """origin, type: types of nodes on the way that aren't terminals. node_types: id, type."""
    return reached.where("not terminal").join(node_types, "id").select("origin", "type").distinct()


def type_flags(met: DataFrame, flags: dict[str, str]) -> DataFrame:
    """origin and one boolean column for each configured type; types that weren't met are false."""
    return met.groupBy("origin").agg(*[F.coalesce(F.max(F.col("type") == t), F.lit(False)).alias(c) for t, c in flags.items()])


def bridge(reached: DataFrame | Reach, node_types: DataFrame, origin_types: DataFrame, flags: dict[str, str]) -> DataFrame:
    """terminal_id, origin, origin_type, n_hops and the flags: one row for each (origin, terminal). origin_types: origin, origin_type."""
    packed = isinstance(reached, Reach)
    hops = reached.min_hops() if packed else min_hops(reached)
    met = reached.type_flags(node_types, flags) if packed else type_flags(types_met(reached, node_types), flags)
    flagged = hops.join(met, "origin", "left").join(origin_types, "origin", "left")
    return flagged.select("terminal_id", "origin", "origin_type", "n_hops", *[F.coalesce(c, F.lit(False)).alias(c) for c in flags.values()])


def unknown_types(node_types: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """type, nodes: types in the data that the configuration doesn't name."""
    domain = node_types.sparkSession.createDataFrame([(k,) for k in known], "type string")
    return node_types.join(domain, "type", "left_anti").groupBy("type").agg(F.count("*").alias("nodes"))


def bridge_summary(table: DataFrame, flags: tuple[str, ...]) -> DataFrame:
    """Per origin type: pairs, distinct terminals and origins, mean hops, rows with each flag."""
    return table.groupBy("origin_type").agg(
        F.count("*").alias("pairs"), F.countDistinct("terminal_id").alias("terminals"), F.countDistinct("origin").alias("origins"), F.round(F.avg("n_hops"), 2).alias("mean_hops"), *[F.sum(F.col(f).cast("int")).alias(f"with_{f}") for f in flags]
    )
