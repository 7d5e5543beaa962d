"""Registered queries over the driver's tables, and SQL that gives the same rows.

Each query re-shapes whole tables into what an operator takes (nested records, lines of a file format, edges, a bridge), applies the
operator, and returns its result."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import digests, extract, flatten, graph, snapshot, validation
from tessera.plans import analytics as A
from tessera.schema import ClassSpec, Schema, Slot
from tessera.session import shared_folder
from tessera.sinks import tables as W
from tessera.sinks.collections import publish, publish_all, run_tree
from tessera.sinks.collections import publish_types as publish_by_type
from tessera.sinks.tablelog import TableLog
from tessera.sources import readers as R
from tessera.streaming import ingest as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql:
            ORACLES[query.__name__] = sql
        return query

    return add


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- nested records -----------------------------------------------------------------------------------------------------------

ORDERS = Schema.of(
    ClassSpec("Region", (Slot("name"),)),
    ClassSpec("Nation", (Slot("name"), Slot("region", "Region", inlined=True))),
    ClassSpec("Customer", (Slot("key", "long"), Slot("name"), Slot("segment"), Slot("balance", "float"), Slot("nation", "Nation", inlined=True))),
    ClassSpec("Part", (Slot("id", identifier=True),)),
    ClassSpec("Line", (Slot("number", "integer"), Slot("part", "Part"), Slot("quantity", "float"), Slot("price", "float"), Slot("flag"))),
    ClassSpec("Order", (Slot("id", identifier=True), Slot("status"), Slot("total", "double"), Slot("customer", "Customer", inlined=True), Slot("lines", "Line", multivalued=True), Slot("parts", "Part", multivalued=True))),
    ClassSpec("Database", (Slot("order_set", "Order", multivalued=True),)),
)


def nested_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document for each order: customer, nation and region as objects, lines as a list, parts as ids."""
    place = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customer = load(spark, sf, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    nation = F.struct(F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region"))
    buyer = F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), nation.alias("nation"))
    part = F.when(F.col("l_partkey") % 10 != 0, F.concat(F.lit("part:"), F.col("l_partkey")))
    line = F.struct(F.col("l_linenumber").alias("number"), F.concat(F.lit("part:"), F.col("l_partkey")).alias("part"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"))
    lines = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"), F.collect_list(part).alias("parts"))
    joined = load(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    record = F.struct(F.concat(F.lit("order:"), F.col("o_orderkey")).alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"), buyer.alias("customer"), "lines", "parts")
    return flatten.records(joined.select(F.to_json(record).alias("raw")))


_JOINED = "orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"


@registered(f"SELECT 'order:' || o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total, c_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS customer_segment, c_acctbal AS customer_balance, n_name AS customer_nation_name FROM {_JOINED}")
def flatten_primary(spark, sf):
    return flatten.primary(nested_orders(spark, sf), ORDERS, "Order").drop("parts")


@registered("SELECT 'order:' || o_orderkey AS id, coalesce(n, 0) AS n_parts, p AS parts FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, string_agg('part:' || l_partkey, '|' ORDER BY 'part:' || l_partkey) AS p FROM lineitem WHERE l_partkey % 10 <> 0 GROUP BY 1) ON o_orderkey = l_orderkey")
def flatten_list_of_ids(spark, sf):
    flat = flatten.primary(nested_orders(spark, sf), ORDERS, "Order")
    filled = F.size("parts") > 0
    return flat.select("id", F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n_parts"), F.when(filled, F.array_join(F.array_sort("parts"), "|")).alias("parts"))


@registered("SELECT 'order:' || l_orderkey AS parent_id, 'part:' || l_partkey AS parts FROM lineitem WHERE l_partkey % 10 <> 0")
def side_junction(spark, sf):
    return flatten.side_tables(nested_orders(spark, sf), ORDERS, "Order", "order_set")["order_set_parts"]


@registered("SELECT CAST(l_orderkey AS VARCHAR) AS parent_id, CAST(l_partkey AS VARCHAR) AS parts FROM lineitem WHERE l_orderkey % 3 = 0")
def side_without_id(spark, sf):
    """Records whose id is missing or blank give no side rows."""
    key = F.col("l_orderkey")
    record = F.struct(F.when(key % 3 == 0, key.cast("string")).when(key % 3 == 1, F.lit("")).alias("id"), F.col("parts"))
    lists = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_partkey").cast("string")).alias("parts"))
    return flatten.side_tables(flatten.records(lists.select(F.to_json(record).alias("raw"))), ORDERS, "Order", "order_set")["order_set_parts"]


@registered("SELECT 'order_set' AS \"table\", count(*) AS rows FROM orders UNION ALL SELECT 'order_set_lines', count(*) FROM lineitem UNION ALL SELECT 'order_set_parts', count(*) FROM lineitem WHERE l_partkey % 10 <> 0")
def flatten_dry_run(spark, sf):
    """Rows that each table of a database would have; no table is written."""
    counts = flatten.dry_run(flatten.flatten_all({"order_set": flatten.parsed_once(nested_orders(spark, sf))}, ORDERS))
    return spark.createDataFrame(sorted(counts.items()), "`table` string, rows long")


@registered("SELECT 'order:' || l_orderkey AS parent_id, CAST(l_linenumber AS BIGINT) AS number, 'part:' || l_partkey AS part, l_quantity AS quantity, l_extendedprice AS price, l_returnflag AS flag FROM lineitem")
def side_child(spark, sf):
    return flatten.side_tables(nested_orders(spark, sf), ORDERS, "Order", "order_set")["order_set_lines"].select("parent_id", "number", "part", "quantity", "price", "flag")


@registered(f"SELECT c_mktsegment AS segment, n_name AS nation, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity FROM {_JOINED} JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2 ORDER BY n_lines DESC, 1, 2 LIMIT 20")
def flatten_then_rank(spark, sf):
    """The flagship: nested documents to primary and child tables, lines summed before the join, top groups."""
    nested = flatten.parsed_once(nested_orders(spark, sf))
    orders = flatten.primary(nested, ORDERS, "Order").select("id", "customer_segment", "customer_nation_name")
    lines = flatten.side_tables(nested, ORDERS, "Order", "order_set")["order_set_lines"].groupBy("parent_id").agg(F.count("*").alias("n"), F.sum("quantity").alias("q"))
    joined = orders.join(lines, F.col("id") == F.col("parent_id")).groupBy(F.col("customer_segment").alias("segment"), F.col("customer_nation_name").alias("nation"))
    return joined.agg(F.sum("n").alias("n_lines"), F.round(F.sum("q"), 2).alias("quantity")).orderBy(F.desc("n_lines"), "segment", "nation").limit(20)


@registered("""SELECT 'order_set' AS collection, 'written' AS status, unnest(['order_set', 'order_set_lines', 'order_set_parts']) AS "table", unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_partkey % 10 <> 0)]) AS rows
UNION ALL SELECT 'draft_set', 'written', 'draft_set', count(*) FROM nation UNION ALL SELECT 'broken_set', 'failed', NULL, NULL UNION ALL SELECT 'left_set', 'skipped', NULL, NULL""")
def flatten_collections(spark, sf):
    """All collections of a database, with a result for each: one has no rows in its side tables, one fails, one is skipped."""
    sets = ClassSpec("Database", tuple(Slot(f"{n}_set", "Order", multivalued=True) for n in ("order", "draft", "broken", "left")))
    schema = Schema.of(*[c for n, c in ORDERS.classes.items() if n != "Database"], sets)
    key = F.concat(F.lit("n"), "n_nationkey")
    nations = load(spark, sf, "nation")
    texts = {"draft_set": F.to_json(F.struct(key.alias("id"))), "broken_set": F.to_json(F.struct(key.alias("id"), F.lit("much").alias("total")))}
    found = {n: flatten.records(nations.select(t.alias("raw"))) for n, t in texts.items()} | {"order_set": nested_orders(spark, sf), "left_set": nested_orders(spark, sf)}
    folder = _folder(spark)

    def write(table: str, rows: DataFrame) -> int:
        rows.write.parquet(f"{folder}/{table}")
        return spark.read.parquet(f"{folder}/{table}").count()

    results = flatten.run_all(found, schema, write, skip=("left_set",))
    rows = [(r["collection"], r["status"], t, n) for r in results for t, n in (r["rows"] or {None: None}).items()]
    return spark.createDataFrame(rows, 'collection string, status string, `table` string, rows long')


@registered("SELECT l_orderkey AS id, count(*) AS n, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts FROM lineitem GROUP BY 1")
def flatten_lone_value(spark, sf):
    """Orders with one line hold a number where others hold a list."""
    schema = Schema.of(ClassSpec("O", (Slot("id", "long", identifier=True), Slot("parts", "long", multivalued=True))))
    lists = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("p"))
    text = F.when(F.size("p") == 1, F.get("p", F.lit(0)).cast("string")).otherwise(F.to_json("p"))
    raw = lists.select(F.concat(F.lit('{"id":'), F.col("l_orderkey"), F.lit(',"parts":'), text, F.lit("}")).alias("raw"))
    return flatten.primary(flatten.records(raw), schema, "O").select("id", F.size("parts").cast("long").alias("n"), F.array_join(F.col("parts").cast("array<string>"), ",").alias("parts"))


PARTIES = Schema.of(
    ClassSpec("Party", (Slot("id", identifier=True), Slot("type", designates_type=True), Slot("name"), Slot("contact", "Party", inlined=True))),
    ClassSpec("Customer", (Slot("segment"),), is_a="Party"),
    ClassSpec("Supplier", (Slot("balance", "double"), Slot("peers", "Party", multivalued=True, inlined=False)), is_a="Party"),
)


def parties(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, suppliers and parts as one polymorphic collection; parts say a class that the schema doesn't know."""
    customer = load(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.lit("x:Customer").alias("type"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    supplier = load(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.lit("Supplier").alias("type"), F.col("s_name").alias("name"), F.lit("none").alias("segment"), F.col("s_acctbal").alias("balance"), F.array(F.concat(F.lit("s"), F.col("s_suppkey") + 1), F.concat(F.lit("c"), F.col("s_suppkey"))).alias("peers"))
    part = load(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.lit("x:Part").alias("type"), F.col("p_name").alias("name"), F.lit("none").alias("segment"), F.col("p_retailprice").alias("balance"))
    every = customer.unionByName(supplier, allowMissingColumns=True).unionByName(part, allowMissingColumns=True)
    inner = F.struct(F.concat(F.lit("y:"), F.regexp_replace("type", "^x:", "")).alias("type"), F.col("name"), F.col("segment"), F.col("balance"))
    return flatten.records(every.select(F.to_json(F.struct("*", inner.alias("contact"))).alias("raw")))


@registered("""SELECT 'c' || c_custkey AS id, 'x:Customer' AS type, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance, c_name AS contact_name, c_mktsegment AS contact_segment, CAST(NULL AS DOUBLE) AS contact_balance FROM customer
UNION ALL SELECT 's' || s_suppkey, 'Supplier', s_name, NULL, s_acctbal, s_name, NULL, s_acctbal FROM supplier
UNION ALL SELECT 'p' || p_partkey, 'x:Part', p_name, NULL, NULL, p_name, NULL, NULL FROM part""")
def flatten_polymorphic(spark, sf):
    return flatten.primary(parties(spark, sf), PARTIES, "Party").select("id", "type", "name", "segment", "balance", "contact_name", "contact_segment", "contact_balance")


@registered("SELECT 's' || s_suppkey AS parent_id, 's' || (s_suppkey + 1) AS peers FROM supplier UNION ALL SELECT 's' || s_suppkey, 'c' || s_suppkey FROM supplier")
def side_of_subclass(spark, sf):
    return flatten.side_tables(parties(spark, sf), PARTIES, "Party", "party_set")["party_set_peers"]


DEEP = Schema.of(
    ClassSpec("C", (Slot("name"), Slot("d", "D", inlined=True))),
    ClassSpec("D", (Slot("name"),)),
    ClassSpec("B", (Slot("name"), Slot("c", "C", inlined=True), Slot("list", "C", multivalued=True))),
    ClassSpec("A", (Slot("id", identifier=True), Slot("b", "B", inlined=True))),
)


@registered("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS b_name, r_name AS b_c_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def depth_cut(spark, sf):
    """Four levels of objects: two of them become columns, what lies deeper doesn't."""
    rows = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = F.struct(F.col("r_name").alias("name"), F.struct(F.lit("deep").alias("name")).alias("d"))
    b = F.struct(F.col("n_name").alias("name"), c.alias("c"), F.array(c).alias("list"))
    return flatten.primary(flatten.records(rows.select(F.to_json(F.struct(F.col("n_nationkey").cast("string").alias("id"), b.alias("b"))).alias("raw"))), DEEP, "A")


@registered("""SELECT s_suppkey AS id, n_name AS nation_name, n_nationkey AS nation_term_id, n_name AS nation_term_name, 'b|a' AS tags, CAST(s_suppkey AS VARCHAR) || '|' || s_name AS values, '[{"a":' || s_suppkey || ',"b":"' || s_name || '"}]' AS pairs, s_name AS env_has_raw_value, n_nationkey AS env_term_id, n_name AS env_term_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def flatten_schemaless(spark, sf):
    rows = load(spark, sf, "supplier").join(load(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    term = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("t").alias("type"))
    one = lambda c: F.struct(F.col(c).cast("string").alias("has_raw_value"))
    nested = rows.select(
        F.col("s_suppkey").alias("id"),
        F.lit("x").alias("type"),
        F.struct(F.col("n_name").alias("name"), term.alias("term")).alias("nation"),
        F.array(F.lit("b"), F.lit("a")).alias("tags"),
        F.array(one("s_name"), one("s_suppkey")).alias("values"),
        F.array(F.struct(F.col("s_name").alias("b"), F.col("s_suppkey").alias("a"))).alias("pairs"),
        F.struct(F.col("s_name").alias("has_raw_value"), F.lit(1).alias("other"), term.alias("term")).alias("env"),
    )
    return flatten.flatten_struct(nested, controlled=("env",))


@registered("SELECT conv_id AS study_id, turn AS number, text AS value FROM conversations")
def child_extract(spark, sf):
    docs = load(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(F.col("turn").alias("number"), F.col("text").alias("value"), F.lit("doi").alias("type"))).alias("dois"))
    return extract.child_rows(docs, "conv_id", "dois", "study_id")


@registered("""SELECT c_nationkey AS study_id, CASE WHEN c_custkey % 2 = 0 THEN 'author|owner' ELSE 'owner' END AS roles, c_name AS person_name, 'http://a/' || c_custkey || '|http://b' AS person_websites FROM customer""")
def credit_extract(spark, sf):
    roles = F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("owner"), F.lit("author"))).otherwise(F.array(F.lit("owner")))
    person = F.struct(F.col("c_name").alias("name"), F.array(F.concat(F.lit("http://a/"), F.col("c_custkey")), F.lit("http://b")).alias("websites"), F.lit("P").alias("type"))
    docs = load(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("id")).agg(F.collect_list(F.struct(roles.alias("roles"), person.alias("person"))).alias("credits"))
    return extract.credit_rows(docs)


_CHEM = "CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE p_name || ' [P:' || p_partkey || '];2020-01-0' || (p_partkey % 9 + 1) END"


@registered(f"""SELECT p_size AS sample_id, {_CHEM} AS raw, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS label, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'P:' || p_partkey END AS id, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '2020-01-0' || (p_partkey % 9 + 1) END AS stamp FROM part""")
def chem_regex(spark, sf):
    raw = F.when(F.col("p_partkey") % 7 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" [P:"), "p_partkey", F.lit("];2020-01-0"), F.col("p_partkey") % 9 + 1))
    docs = load(spark, sf, "part").groupBy("p_size").agg(F.collect_list(raw).alias("chem"))
    return extract.administered_rows(docs, "p_size", "chem", "sample_id")


@registered("SELECT 'event_id' AS field, count(event_id) AS filled FROM events UNION ALL SELECT 'kind', count(CASE WHEN event_id % 3 <> 0 THEN event_type END) FROM events UNION ALL SELECT 'amount', count(CASE WHEN event_id % 5 <> 0 THEN value END) FROM events UNION ALL SELECT 'nothing', 0")
def field_counts(spark, sf):
    e = load(spark, sf, "events")
    shaped = e.select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("kind"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("amount"), F.lit(None).cast("string").alias("nothing"))
    return extract.field_counts(shaped)


@registered("SELECT p_partkey AS key, 'PART:' || p_partkey || '_x' AS normal, 'a:b_' || p_partkey AS kept FROM part")
def curie_normalize(spark, sf):
    p = load(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("key"), S.normal_curie(F.concat(F.lit("PART_"), "p_partkey", F.lit("_x"))).alias("normal"), S.normal_curie(F.concat(F.lit("a:b_"), "p_partkey")).alias("kept"))


@registered("""SELECT l_orderkey AS sample_id, l_linenumber AS line, 'PART:' || l_partkey AS env_normal_id, p_name AS env_canonical_label, coalesce(l_partkey % 11 = 0 AND p_name IS NOT NULL, false) AS env_is_obsolete, CASE WHEN l_linenumber = 1 THEN p_name = p_name ELSE 'other' = p_name END AS env_label_matches
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 13 <> 0) ON l_partkey = p_partkey""")
def ontology_enrich(spark, sf):
    part = load(spark, sf, "part")
    terms = part.where("p_partkey % 13 <> 0").select(F.concat(F.lit("PART:"), "p_partkey").alias("id"), F.col("p_name").alias("label"), (F.col("p_partkey") % 11 == 0).alias("obsolete"))
    names = part.select(F.col("p_partkey").alias("k"), "p_name")
    samples = load(spark, sf, "lineitem").join(names, F.col("l_partkey") == F.col("k"), "left").select(F.col("l_orderkey").alias("sample_id"), F.col("l_linenumber").alias("line"), F.concat(F.lit("PART_"), "l_partkey").alias("env_term_id"), F.when(F.col("l_linenumber") == 1, F.col("p_name")).otherwise("other").alias("env_term_name"))
    return extract.with_terms(samples, terms, ("env",)).drop("env_term_id", "env_term_name")


# -- tables -------------------------------------------------------------------------------------------------------------------


@registered("SELECT unnest(['id', 'kept_empty', 'name', 'some']) AS kept")
def drop_empty(spark, sf):
    c = load(spark, sf, "customer")
    shaped = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(None).cast("string").alias("kept_empty"), F.lit(None).cast("double").alias("empty"), F.array().cast("array<string>").alias("empty_list"), F.when(F.col("c_custkey") == 7, F.lit(1)).alias("some"))
    names = W.filled_columns(shaped, protected=("kept_empty",))
    return spark.createDataFrame([(n,) for n in names], "kept string")


@registered("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total, CAST(NULL AS BIGINT) AS count, ARRAY_TO_STRING([o_orderstatus], ',') AS tags FROM orders")
def conform_nulls(spark, sf):
    from pyspark.sql import types as T

    struct = T.StructType([T.StructField("id", T.StringType()), T.StructField("total", T.DoubleType()), T.StructField("count", T.LongType()), T.StructField("tags", T.ArrayType(T.StringType()))])
    rows = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("string").alias("total"), F.col("o_orderstatus").alias("tags"), F.lit(1).alias("extra"))
    return W.conform(rows, struct).withColumn("tags", F.array_join("tags", ","))


@registered("SELECT r_regionkey AS Region_Key, r_name AS name_of_it FROM region")
def sanitize_columns(spark, sf):
    return W.sanitised(load(spark, sf, "region").toDF("Region Key", "(name) of=it "))


@registered("SELECT 'a' AS \"table\", (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM orders) AS destination_rows, 'OK' AS status UNION ALL SELECT 'b', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_orderkey % 2 = 0), 'MISMATCH' UNION ALL SELECT 'c', (SELECT count(*) FROM part), NULL, 'MISMATCH'")
def reconcile_counts(spark, sf):
    count = lambda t, d: d.agg(F.count("*").alias("rows")).select(F.lit(t).alias("table"), "rows")
    o, line, p = (load(spark, sf, t) for t in ("orders", "lineitem", "part"))
    return W.reconciled(count("a", o).union(count("b", line)).union(count("c", p)), count("a", o).union(count("b", line.where("l_orderkey % 2 = 0"))))


# -- files --------------------------------------------------------------------------------------------------------------------


def _blast_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of an 11-column table made of lineitem; every 17th order's lines lack a field, every 19th has a bad number."""
    line = load(spark, sf, "lineitem")
    number = F.when(F.col("l_orderkey") % 19 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("long").cast("string"))
    fields = [F.concat(F.lit("g"), "l_orderkey"), "l_suppkey", F.concat(F.lit("K"), "l_partkey"), "l_discount", "l_linenumber", number, F.lit("1"), F.lit("2"), "l_tax", "l_extendedprice"]
    text = F.concat_ws("\t", *[F.col(f).cast("string") if isinstance(f, str) else f for f in fields])
    whole = F.when(F.col("l_orderkey") % 17 == 0, text).otherwise(F.concat(text, F.lit("\t9")))
    return line.select(F.concat(F.lit("f"), F.col("l_orderkey") % 5).alias("file"), whole.alias("value"))


@registered("SELECT 'f' || (l_orderkey % 5) AS file, 'g' || l_orderkey AS gene_id, l_suppkey AS ncbi_taxid, 'K' || l_partkey AS annotation_id, l_discount AS pct_identity, CAST(l_linenumber AS BIGINT) AS q_start, CASE WHEN l_orderkey % 19 <> 0 THEN CAST(l_quantity AS BIGINT) END AS q_end, 1 AS s_start, 2 AS s_end, l_tax AS evalue, l_extendedprice AS bitscore, 9 AS aln_len FROM lineitem WHERE l_orderkey % 17 <> 0")
def read_tsv(spark, sf):
    return R.blast(_blast_lines(spark, sf))[0]


@registered("SELECT 'f' || (l_orderkey % 5) AS file, count(*) AS rejects FROM lineitem WHERE l_orderkey % 17 = 0 GROUP BY 1")
def read_tsv_rejects(spark, sf):
    return R.blast(_blast_lines(spark, sf))[1].groupBy("file").agg(F.count("*").alias("rejects"))


@registered("SELECT 'g' || l_orderkey AS gene_id, 'PF' || l_partkey AS accession, CAST(l_linenumber AS BIGINT) AS \"start\", CAST(l_quantity AS BIGINT) AS \"end\", l_extendedprice AS score, l_tax AS e_value, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE CAST(l_suppkey AS BIGINT) END AS alignment_length, 5 AS model_start, CAST(NULL AS BIGINT) AS model_end FROM lineitem")
def read_gff(spark, sf):
    line = load(spark, sf, "lineitem")
    length = F.when(F.col("l_orderkey") % 3 == 0, F.lit("?")).otherwise(F.col("l_suppkey").cast("string"))
    attributes = F.concat(F.lit("e-value=1;x=2;alignment_length="), length, F.lit(";model_start=5;e-value="), F.col("l_tax").cast("string"))
    text = F.concat_ws("\t", F.concat(F.lit("g"), "l_orderkey"), F.lit("src"), F.concat(F.lit("PF"), "l_partkey"), F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("long").cast("string"), F.col("l_extendedprice").cast("string"), F.lit("+"), F.lit("."), attributes)
    lines = line.select(F.lit("f").alias("file"), text.alias("value")).unionByName(line.select(F.lit("f").alias("file"), F.concat(F.lit("# "), F.col("l_orderkey").cast("string")).alias("value")))
    return R.gff(lines)[0].drop("file")


@registered("SELECT 'bin.' || p_partkey AS bin_id, p_brand AS marker_lineage, CAST(p_size AS BIGINT) AS n_genomes, 1 AS n_markers, 2 AS n_marker_sets, 0 AS n_0, 1 AS n_1, 2 AS n_2, 3 AS n_3, 4 AS n_4, 5 AS n_5_plus, p_retailprice AS completeness, CAST(0.5 AS DOUBLE) AS contamination, CAST(NULL AS DOUBLE) AS strain_heterogeneity FROM part WHERE p_partkey % 8 <> 0")
def read_aligned(spark, sf):
    part = load(spark, sf, "part")
    fields = [F.concat(F.lit("bin."), "p_partkey"), "p_brand", "p_size", *map(F.lit, ("1", "2", "0", "1", "2", "3", "4", "5")), "p_retailprice", F.lit("0.5")]
    text = F.concat_ws("   ", *[F.col(f).cast("string") if isinstance(f, str) else f for f in fields])
    value = F.when(F.col("p_partkey") % 8 == 0, text).otherwise(F.concat(F.lit("  "), text, F.lit("  nan?")))
    rules = spark.createDataFrame([("f", "-" * 40), ("f", "  Bin Id    Marker lineage   # genomes"), ("f", "")], "file string, value string")
    return R.aligned(part.select(F.lit("f").alias("file"), value.alias("value")).unionByName(rules)).drop("file")


@registered("SELECT 'f' AS file, p_retailprice AS pct_clade, CAST(p_size AS BIGINT) AS clade_reads, CASE WHEN p_partkey % 3 > 0 THEN p_partkey END AS direct_reads, 'S' AS rank, p_partkey AS taxid, '  ' || p_name AS name FROM part WHERE p_partkey % 7 > 0")
def read_kraken(spark, sf):
    """A headerless table of six columns, by the table of parsers; every seventh line lacks its name."""
    p = load(spark, sf, "part")
    direct = F.when(F.col("p_partkey") % 3 > 0, F.col("p_partkey").cast("string")).otherwise("-")
    start = F.concat_ws("\t", F.col("p_retailprice").cast("string"), F.concat(F.lit(" "), "p_size"), direct, F.lit("S"), F.col("p_partkey").cast("string"))
    value = F.when(F.col("p_partkey") % 7 == 0, start).otherwise(F.concat(start, F.lit("\t  "), "p_name"))
    return R.FORMATS["Kraken2 Classification Report"].parse(p.select(F.lit("f").alias("file"), value.alias("value")))[0]


@registered("""SELECT 'r' || o_orderkey AS file, o_orderkey AS n_seqs, o_custkey AS n_bps, 3 AS len_shortest_seq, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 100 END AS len_longest_seq, 1.5::DOUBLE AS avg_seq_length, o_totalprice AS median_seq_length, 0.25::DOUBLE AS stddev_seq_length,
o_orderkey - 1 AS n_seqs_with_genes, 1 AS n_seqs_without_genes, o_custkey + 2 AS n_cds, 7 AS n_trna, NULL::BIGINT AS n_ncrna, NULL::BIGINT AS n_rrna, o_orderkey % 3 AS n_crispr, (o_orderkey % 100)::DOUBLE AS coding_density_pct, 900::DOUBLE AS genes_per_1m_bp, NULL::DOUBLE AS seqs_per_1m_bp FROM orders WHERE o_orderkey % 6 > 0""")
def annotation_statistics(spark, sf):
    """A report of three tables for each order; every sixth has none of the sections, some lines aren't numbers, a feature comes twice."""
    o = load(spark, sf, "orders")
    t = lambda c: F.col(c).cast("string")
    rule, dash, tab = "=" * 20, "-" * 20, "\t"
    longest = F.when(F.col("o_orderkey") % 5 > 0, (F.col("o_orderkey") % 100).cast("string")).otherwise("n/a")
    head = tab.join(("Data type", "Number of seqs", "Number of bps", "Length shortest seq", "Length longest seq", "Average length", "Median length", "Standard deviation"))
    report = F.concat(
        F.lit(f"made by a tool\n\nProcessed Sequences Statistics\n\n{rule}\n{head}\n{dash}\n'final_fasta'\t"), t("o_orderkey"), F.lit(tab), t("o_custkey"), F.lit("\t3\t"), longest, F.lit("\t1.5\t"), t("o_totalprice"), F.lit("\t0.25\n'sequences_with_genes'\t"), (F.col("o_orderkey") - 1).cast("string"), F.lit("\t1\n\n'sequences_without_genes'\t1\n"), F.lit(f"{rule}\n\nPredicted Genes Statistics\n{rule}\nFeature type\tPrediction method\tNumber of predicted features\n{dash}\n'CDS'\ta\t"),
        t("o_custkey"), F.lit("\n'CDS'\tb\t2\n'tRNA'\ta\t7\n'CRISPR'\ta\t"), (F.col("o_orderkey") % 3).cast("string"), F.lit(f"\n{rule}\nGeneral Quality Info\n{rule}\nCoding density\tGenes per 1M bp\n{dash}\n"), (F.col("o_orderkey") % 100).cast("string"), F.lit(f"%\t900\n{rule}\n"),
    )
    other = F.lit(f"Something else\n{rule}\na\tb\n1\t2\n{rule}\n")
    return R.statistics(o.select(F.concat(F.lit("r"), "o_orderkey").alias("file"), F.when(F.col("o_orderkey") % 6 == 0, other).otherwise(report).alias("value")))


@registered("SELECT 'r' || o_orderkey AS file, CAST(o_orderkey AS DOUBLE) AS n_seqs, CAST(o_custkey AS DOUBLE) AS n_cds, CAST(o_orderkey % 100 AS DOUBLE) AS density, CAST(NULL AS DOUBLE) AS n_other FROM orders")
def read_sections(spark, sf):
    """A report of three sections for each order."""
    o = load(spark, sf, "orders")
    t = lambda c: F.col(c).cast("string")
    report = F.concat(
        F.lit("Sequence stats\n====\nNumber of seqs: "), t("o_orderkey"), F.lit("\nother: 5\n\nFeatures\n=======\n'CDS'\t"), t("o_custkey"), F.lit("\n\nSummary\n=====\ncoding density: "), (F.col("o_orderkey") % 100).cast("string"), F.lit("%\nNumber of seqs: 1\n")
    )
    rows = R.sections(o.select(F.concat(F.lit("r"), "o_orderkey").alias("file"), report.alias("value")))
    return R.metrics_row(rows, {"n_seqs": ("Sequence stats", "Number of seqs"), "n_cds": ("Features", "CDS"), "density": ("Summary", "coding density"), "n_other": ("Features", "other")})


@registered("SELECT 'PF' || p_partkey AS pfam_id, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'CL' || p_size END AS clan_id, p_brand AS clan_name, p_name AS name, p_type AS description FROM part")
def read_strict(spark, sf):
    p = load(spark, sf, "part")
    text = F.concat_ws("\t", F.concat(F.lit("PF"), "p_partkey"), F.when(F.col("p_partkey") % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("CL"), "p_size")), "p_brand", "p_name", "p_type")
    return R.strict_terms(p.select(text.alias("value")).unionByName(p.select(F.lit("  ").alias("value"))))


@registered("SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN true WHEN doc_id % 6 = 1 THEN true ELSE false END AS placeholder FROM documents")
def placeholder_filter(spark, sf):
    d = load(spark, sf, "documents")
    value = F.when(F.col("doc_id") % 6 == 0, F.lit("No results for this sample\n")).when(F.col("doc_id") % 6 == 1, F.lit(" \n ")).when(F.col("doc_id") % 6 == 2, F.lit("No results for this sample\nbut lines")).otherwise(F.concat(F.lit("x "), "text"))
    return d.select("doc_id", S.is_placeholder(value, ("no results for",)).alias("placeholder"))


@registered("SELECT min(page_id) AS id, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages GROUP BY 2")
def manifest_dedup(spark, sf):
    p = load(spark, sf, "pages").select(F.col("page_id").alias("id"), F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"))
    return A.first_per(p, ["host"], [F.col("id")]).select("id", "host")


_KIND = "CASE page_id % 3 WHEN 0 THEN 'KO' WHEN 1 THEN 'EC' ELSE 'Other' END"


@registered(f"""SELECT data_object_type, count(*) AS files, sum(b) / 1e9 AS gigabytes FROM (
SELECT {_KIND} AS data_object_type, CASE WHEN page_id % 4 = 0 THEN 0 ELSE page_id * 1000 END AS b, row_number() OVER (PARTITION BY regexp_extract(url, '^[^:]*://[^/?#]*', 0), {_KIND} ORDER BY page_id) AS n
FROM pages WHERE page_id % 3 <> 2 AND page_id % 5 <> 0 AND url LIKE 'https:%') WHERE n = 1 GROUP BY 1""")
def file_manifest(spark, sf):
    p = load(spark, sf, "pages")
    kind = F.when(F.col("page_id") % 3 == 0, "KO").when(F.col("page_id") % 3 == 1, "EC").otherwise("Other")
    objects = p.select(F.col("page_id").alias("id"), F.regexp_extract("url", "^[^:]*://[^/?#]*", 0).alias("url"), kind.alias("data_object_type"), F.when(F.col("page_id") % 5 != 0, F.lit("run")).alias("was_generated_by"), F.when(F.col("page_id") % 4 == 0, F.lit("?")).otherwise((F.col("page_id") * 1000).cast("string")).alias("file_size_bytes"))
    return A.manifest_summary(A.file_manifest(objects, ["KO", "EC"], "https:"))


@registered("SELECT page_id % 2 = 0 AND url NOT LIKE '%..%' AS hit, count(*) AS files FROM pages GROUP BY 1")
def manifest_binding(spark, sf):
    p = load(spark, sf, "pages").select(F.col("page_id").alias("id"), F.concat(F.lit("https://h/"), "page_id", F.lit("/a.tsv?x=1")).alias("url"), F.lit("r").alias("was_generated_by"))
    landed = p.where("id % 2 = 0").select(F.concat(F.lit("cache/"), "id", F.lit("/a.tsv")).alias("file"))
    return R.bind_manifest(landed, p, "cache").groupBy("hit").agg(F.count("*").alias("files"))


@registered("SELECT o_orderkey AS whole, CAST(o_totalprice AS DOUBLE) AS real, CASE WHEN o_orderkey % 97 = 5 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS mixed FROM orders")
def type_stabilize(spark, sf):
    o = load(spark, sf, "orders")
    text = o.select(F.col("o_orderkey").cast("string").alias("whole"), F.col("o_totalprice").cast("string").alias("real"), F.when(F.col("o_orderkey") % 97 == 5, F.lit("x")).otherwise(F.col("o_custkey").cast("string")).alias("mixed"))
    return S.stabilised(text, ["whole", "real", "mixed"])


@registered("SELECT CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS kind, count(*) AS n, round(sum(CASE WHEN event_id % 2 = 0 THEN value END), 2) AS v, count(CASE WHEN event_id % 2 = 1 THEN user_id END) AS u FROM events GROUP BY 1")
def union_differing(spark, sf):
    e = load(spark, sf, "events")
    a, b = e.where("event_id % 2 = 0").select(F.lit("a").alias("kind"), "value"), e.where("event_id % 2 = 1").select("user_id", F.lit("b").alias("kind"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("kind").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("v"), F.count("user_id").alias("u"))


# -- graph --------------------------------------------------------------------------------------------------------------------


def provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Edges from orders to regions by two ways: over the customer's nation, and over the lines' suppliers' nations."""
    t = {n: load(spark, sf, n) for n in ("orders", "customer", "nation", "region", "lineitem", "supplier")}
    key = lambda p, c: F.concat(F.lit(p), F.col(c))
    return graph.edges([
        (t["orders"].select(key("o", "o_orderkey").alias("a"), key("c", "o_custkey").alias("b")), "a", "b", "placed_by"),
        (t["customer"].select(key("c", "c_custkey").alias("a"), key("n", "c_nationkey").alias("b")), "a", "b", "lives_in"),
        (t["lineitem"].select(key("o", "l_orderkey").alias("a"), key("l", "l_suppkey").alias("b")), "a", "b", "sold_by"),
        (t["supplier"].select(key("l", "s_suppkey").alias("a"), key("m", "s_nationkey").alias("b")), "a", "b", "ships_from"),
        (t["nation"].select(key("m", "n_nationkey").alias("a"), key("n", "n_nationkey").alias("b")), "a", "b", "same_as"),
        (t["nation"].select(key("n", "n_nationkey").alias("a"), key("r", "n_regionkey").alias("b")), "a", "b", "part_of"),
    ])


_EDGES = """e AS (SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS next_id, 'placed_by' AS slot FROM orders UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'lives_in' FROM customer
UNION ALL SELECT 'o' || l_orderkey, 'l' || l_suppkey, 'sold_by' FROM lineitem UNION ALL SELECT 'l' || s_suppkey, 'm' || s_nationkey, 'ships_from' FROM supplier
UNION ALL SELECT 'm' || n_nationkey, 'n' || n_nationkey, 'same_as' FROM nation UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'part_of' FROM nation)"""
_WALK = f"""WITH RECURSIVE {_EDGES}, d AS (SELECT DISTINCT src, next_id FROM e), w AS (SELECT 'o' || o_orderkey AS origin, 'o' || o_orderkey AS id, 0 AS hops FROM orders
UNION SELECT w.origin, d.next_id, w.hops + 1 FROM w JOIN d ON d.src = w.id WHERE w.hops < 15 AND w.id NOT LIKE 'r%')"""


@registered(f"WITH {_EDGES} SELECT slot, count(*) AS links, count(DISTINCT src) AS sources, count(DISTINCT next_id) AS targets FROM e GROUP BY 1")
def union_edges(spark, sf):
    return provenance(spark, sf).groupBy("slot").agg(F.count("*").alias("links"), F.countDistinct("src").alias("sources"), F.countDistinct("next_id").alias("targets"))


def order_walk(spark: SparkSession, sf: str) -> graph.Reach:
    seeds = load(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("origin"))
    return graph.reach(provenance(spark, sf), seeds, F.col("id").startswith("r"))


@registered(f"{_WALK} SELECT origin, id AS terminal_id, min(hops) AS n_hops FROM w WHERE id LIKE 'r%' GROUP BY 1, 2")
def bfs_min_hops(spark, sf):
    return order_walk(spark, sf).min_hops()


@registered(f"{_WALK} SELECT id, min(hops) AS nearest, max(hops) AS furthest, count(*) AS pairs FROM (SELECT origin, id, min(hops) AS hops FROM w WHERE hops > 0 GROUP BY 1, 2) GROUP BY 1")
def reach_by_node(spark, sf):
    """How many orders reach each node, and over how many hops, from the packed walk: bits are counted, and no pair is unpacked."""
    bits = order_walk(spark, sf).packed
    return bits.groupBy("id").agg(F.min("hops").alias("nearest"), F.max("hops").alias("furthest"), F.sum(F.bit_count("bits")).cast("long").alias("pairs"))


@registered(f"{_WALK} SELECT origin, id, min(hops) AS hops FROM w WHERE id LIKE 'r%' GROUP BY 1, 2")
def bfs_recursive(spark, sf):
    seeds = load(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("origin"))
    return graph.walk_recursive(spark, provenance(spark, sf), seeds, F.col("id").startswith("r"))


_TYPES = "t AS (SELECT 'c' || c_custkey AS id, c_mktsegment AS type FROM customer UNION ALL SELECT 'l' || s_suppkey, 'supplier' FROM supplier UNION ALL SELECT 'm' || n_nationkey, 'depot' FROM nation)"
_FLAGS = {"supplier": "has_supplier", "depot": "has_depot", "BUILDING": "has_building", "absent": "has_absent"}


def _bridge(spark: SparkSession, sf: str) -> DataFrame:
    kind = lambda p, t, c, v: load(spark, sf, t).select(F.concat(F.lit(p), c).alias("id"), v.alias("type"))
    types = kind("c", "customer", "c_custkey", F.col("c_mktsegment")).union(kind("l", "supplier", "s_suppkey", F.lit("supplier"))).union(kind("m", "nation", "n_nationkey", F.lit("depot")))
    origins = load(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("origin"), F.col("o_orderstatus").alias("origin_type"))
    return graph.bridge(order_walk(spark, sf), types, origins, _FLAGS)


_BRIDGE = f"""{_WALK}, {_TYPES}, f AS (SELECT origin, bool_or(type = 'supplier') AS s, bool_or(type = 'depot') AS p, bool_or(type = 'BUILDING') AS b FROM w JOIN t ON w.id = t.id WHERE w.hops > 0 GROUP BY 1),
m AS (SELECT origin, id AS terminal_id, min(hops) AS n_hops FROM w WHERE id LIKE 'r%' GROUP BY 1, 2),
br AS (SELECT terminal_id, m.origin, o_orderstatus AS origin_type, n_hops, coalesce(s, false) AS has_supplier, coalesce(p, false) AS has_depot, coalesce(b, false) AS has_building, false AS has_absent FROM m LEFT JOIN f USING (origin) JOIN orders ON m.origin = 'o' || o_orderkey)"""


@registered(f"{_BRIDGE} SELECT * FROM br")
def bridge_table(spark, sf):
    return _bridge(spark, sf)


@registered(f"{_BRIDGE} SELECT origin_type, count(*) AS pairs, count(DISTINCT terminal_id) AS terminals, count(DISTINCT origin) AS origins, round(avg(n_hops), 2) AS mean_hops, sum(has_supplier::INT) AS with_has_supplier FROM br GROUP BY 1")
def bridge_summary(spark, sf):
    return graph.bridge_summary(_bridge(spark, sf), ("has_supplier",))


@registered("SELECT event_type AS type, count(*) AS nodes FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1")
def unknown_types(spark, sf):
    return graph.unknown_types(load(spark, sf, "events").select(F.col("event_type").alias("type")), ("click", "view"))


# -- analytics ----------------------------------------------------------------------------------------------------------------


def _order_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_custkey").alias("entity"))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "run")


@registered("SELECT o_custkey AS entity, count(*) AS hits, count(DISTINCT o_orderkey) AS runs FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1 ORDER BY hits DESC, 1 LIMIT 20")
def top_hits_per_entity(spark, sf):
    return A.hits_per_entity(_lines(spark, sf), "l_returnflag", "R", _order_bridge(spark, sf), "run", "entity")


@registered("SELECT coalesce(a.k, b.k) AS key, coalesce(counted, 0) AS counted, coalesce(stored, 0) AS stored, coalesce(counted, 0) - coalesce(stored, 0) AS difference FROM (SELECT 'ORDER:' || l_orderkey AS k, count(*) AS counted FROM lineitem GROUP BY 1) a FULL JOIN (SELECT 'ORDER:' || o_orderkey AS k, o_orderkey % 7 AS stored FROM orders) b ON a.k = b.k")
def cross_check(spark, sf):
    return _order_counts(spark, sf, None)


@registered("SELECT * FROM (SELECT coalesce(a.k, b.k) AS key, coalesce(counted, 0) AS counted, coalesce(stored, 0) AS stored, coalesce(counted, 0) - coalesce(stored, 0) AS difference FROM (SELECT 'ORDER:' || l_orderkey AS k, count(*) AS counted FROM lineitem GROUP BY 1) a FULL JOIN (SELECT 'ORDER:' || o_orderkey AS k, o_orderkey % 7 AS stored FROM orders) b ON a.k = b.k) ORDER BY abs(difference) DESC, key LIMIT 25")
def largest_differences(spark, sf):
    return _order_counts(spark, sf, 25)


def _order_counts(spark: SparkSession, sf: str, n: int | None) -> DataFrame:
    fact = load(spark, sf, "lineitem").select(F.concat(F.lit("KO:"), "l_orderkey").alias("id"))
    rollup = load(spark, sf, "orders").select(F.concat(F.lit("ORDER:"), "o_orderkey").alias("id"), (F.col("o_orderkey") % 7).alias("n"))
    return A.cross_check(fact, "id", rollup, "id", "n", "ORDER:", 3, n)


@registered("SELECT l_partkey, count(*) AS hits, min(l_tax) AS best, max(l_tax) AS worst, round(avg(l_quantity), 2) AS mean_score FROM lineitem GROUP BY 1 ORDER BY hits DESC, 1 LIMIT 20")
def quality_summary(spark, sf):
    return A.hit_quality(load(spark, sf, "lineitem"), "l_partkey", "l_tax", "l_quantity")


@registered("SELECT c_mktsegment AS segment, count(DISTINCT l_orderkey) AS runs, count(DISTINCT o_custkey) AS entities, round(avg(l_quantity), 2) AS mean_l_quantity, round(avg(l_discount), 2) AS mean_l_discount FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def qc_by_group(spark, sf):
    entities = load(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("segment"))
    return A.qc_by(_lines(spark, sf), _order_bridge(spark, sf), entities, "run", "entity", "segment", ["l_quantity", "l_discount"])


@registered("SELECT o_custkey AS entity, max(l_quantity) AS max_l_quantity, sum(l_quantity) AS sum_l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE trim(l_linestatus) = 'O' AND l_quantity > 10 AND l_discount > 0.02 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def taxon_to_sample(spark, sf):
    return A.taxon_to_entities(_lines(spark, sf), "l_linestatus", "O", {"l_quantity": 10, "l_discount": 0.02}, _order_bridge(spark, sf), "run", "entity", ["l_quantity"])


@registered("SELECT o_custkey AS entity, count(*) AS items, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS names FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey WHERE p_brand LIKE '%#1%' GROUP BY 1")
def lineage_substring(spark, sf):
    summary = _lines(spark, sf).join(load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return A.lineage_to_entities(summary, "p_brand", "#1", "l_partkey", _order_bridge(spark, sf), "run", "entity", None)


@registered("SELECT o_custkey AS entity, count(*) AS items, round(avg(l_quantity), 2) AS mean_l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity >= 40 AND l_discount <= 0.05 GROUP BY 1")
def hq_threshold(spark, sf):
    return A.quality_to_entities(_lines(spark, sf), (F.col("l_quantity") >= 40) & (F.col("l_discount") <= 0.05), _order_bridge(spark, sf), "run", "entity", ["l_quantity"], None)


@registered("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END AS size, round(abs(p_retailprice - 1000), 1) AS off FROM part WHERE p_partkey % 2 = 0 ORDER BY size DESC NULLS LAST, off, p_partkey LIMIT 50")
def nulls_last_top(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", F.lit("even").alias("run"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_size")).alias("size"), F.round(F.abs(F.col("p_retailprice") - 1000), 1).alias("off")).where("p_partkey % 2 = 0")
    return A.bins_of_run(p, "run", "even", [F.col("size").desc_nulls_last(), F.col("off"), F.col("p_partkey")]).drop("run").limit(50)


@registered("SELECT DISTINCT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 10 AND l_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 20)")
def cooccurrence(spark, sf):
    fact = load(spark, sf, "lineitem").join(load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return A.cooccurrence(fact, "l_orderkey", "p_size", 10, 20)


@registered(f"SELECT r_name, n_name, count(*) AS lines FROM lineitem JOIN orders oo ON l_orderkey = oo.o_orderkey JOIN customer ON oo.o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def multi_hop_chain(spark, sf):
    t = {n: load(spark, sf, n) for n in ("orders", "customer", "nation", "region")}
    out = A.chain(load(spark, sf, "lineitem"), (t["orders"], "l_orderkey", "o_orderkey"), (t["customer"], "o_custkey", "c_custkey"), (t["nation"], "c_nationkey", "n_nationkey"), (t["region"], "n_regionkey", "r_regionkey"))
    return out.groupBy("r_name", "n_name").agg(F.count("*").alias("lines"))


@registered("SELECT l_partkey, p_name, count(*) AS hits FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def named_hits(spark, sf):
    return A.named_hits(load(spark, sf, "lineitem"), "l_partkey", load(spark, sf, "part"), "p_partkey", "p_name")


@registered("SELECT l.* FROM lineitem l WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey = 1 AND o_orderstatus = 'F')")
def rows_for_entity(spark, sf):
    bridge = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    return A.rows_for_entity(load(spark, sf, "lineitem"), bridge, "l_orderkey", "o_custkey", 1, "o_orderstatus", "F")


@registered("SELECT DISTINCT o_custkey AS entity FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey WHERE p_name LIKE '%bolt%'")
def entities_with(spark, sf):
    summary = _lines(spark, sf).join(load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return A.entities_with(summary, "p_name", "bolt", _order_bridge(spark, sf), "run", "entity")


@registered("SELECT k AS p_partkey, p_name, p_name IS NOT NULL AS found FROM (SELECT unnest([1, 5, -1]) AS k) LEFT JOIN part ON p_partkey = k")
def term_lookup(spark, sf):
    return A.term_lookup(load(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", [1, 5, -1])


@registered("SELECT l_linestatus AS rank, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 5 AND l_linestatus = 'O' ORDER BY l_quantity DESC, l_partkey LIMIT 3")
def top_taxa(spark, sf):
    return A.top_taxa(_lines(spark, sf).withColumnRenamed("l_linestatus", "rank"), "run", 5, "rank", "O", "l_quantity", "l_partkey", 3).select("rank", "l_partkey", "l_quantity")


@registered("SELECT l_orderkey AS run, l_partkey, o_custkey AS entity, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_orderkey = 5")
def qc_for_run(spark, sf):
    entities = load(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), "c_name")
    return A.of_run(_lines(spark, sf), _order_bridge(spark, sf), entities, "run", "entity", 5).select("run", "l_partkey", "entity", "c_name")


@registered("SELECT page_id AS id, url FROM pages WHERE page_id = 3")
def source_file(spark, sf):
    return A.source_file(load(spark, sf, "pages").select(F.col("page_id").alias("id"), "url"), 3)


@registered("SELECT event_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def id_set_filter(spark, sf):
    return A.in_set(load(spark, sf, "events"), "user_id", load(spark, sf, "customer").where("c_acctbal > 5000"), "c_custkey").select("event_id")


@registered("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 49 AND l_returnflag IS NOT NULL ORDER BY l_orderkey, l_partkey, l_linenumber LIMIT 1")
def anchor_row(spark, sf):
    rows = load(spark, sf, "lineitem").where("l_quantity >= 49 AND l_returnflag IS NOT NULL")
    return A.anchor_row(rows, "l_orderkey", "l_partkey", "l_linenumber", what="line").select("l_orderkey", "l_partkey", "l_quantity")


@registered("SELECT DISTINCT o_orderkey AS run, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderkey = 5")
def run_to_study(spark, sf):
    """From one run over its entity to the group that holds it."""
    t = {n: load(spark, sf, n) for n in ("orders", "customer", "nation", "region")}
    runs = t["orders"].select(F.col("o_orderkey").alias("run"), "o_custkey")
    found = A.reached_from_run(runs, "run", 5, (t["customer"], "o_custkey", "c_custkey"), (t["nation"], "c_nationkey", "n_nationkey"), (t["region"], "n_regionkey", "r_regionkey"))
    return found.select("run", "n_name", "r_name")


@registered(f"{_WALK.replace('FROM orders' + chr(10), 'FROM orders WHERE o_orderkey = 5' + chr(10))} SELECT w.origin AS run, id AS entity, r_name, min(hops) AS n_hops FROM w JOIN region ON w.id = 'r' || r_regionkey GROUP BY 1, 2, 3")
def run_to_entities(spark, sf):
    """A run's entities with their own columns and the hops to them."""
    seeds = load(spark, sf, "orders").where("o_orderkey = 5").select(F.concat(F.lit("o"), "o_orderkey").alias("origin"))
    reached = graph.min_hops(graph.walk(provenance(spark, sf), seeds, F.col("id").startswith("r"))).select(F.col("origin").alias("run"), F.col("terminal_id").alias("entity"), "n_hops")
    region = load(spark, sf, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("entity"), "r_name")
    return A.entities_of_run(reached, region, "run", "entity", "o5").select("run", "entity", "r_name", "n_hops")


@registered("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM (SELECT event_id, event_type FROM events)) WHERE place <= 3")
def first_of_each_type(spark, sf):
    rows = A.first_n_per(load(spark, sf, "events").select("event_id", "event_type"), ["event_type"], [F.col("event_id")], 3)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")))


# -- validation, inventories ------------------------------------------------------------------------------------------------------


@registered("SELECT 'ERROR' AS severity, 'finite-number' AS rule, 'total' AS path, count(*) AS rows FROM orders WHERE o_orderkey % 11 = 0 HAVING count(*) > 0 UNION ALL SELECT 'ERROR', 'required', 'id', count(*) FROM orders WHERE o_orderkey % 13 = 0 HAVING count(*) > 0 UNION ALL SELECT 'ERROR', 'enum', 'status', count(*) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0 UNION ALL SELECT 'ERROR', 'undeclared', 'extra', count(*) FROM orders WHERE o_orderkey % 17 = 0 HAVING count(*) > 0 UNION ALL SELECT 'ERROR', 'pattern', 'priority', count(*) FROM orders WHERE o_orderpriority NOT LIKE '1%' HAVING count(*) > 0")
def rule_validation(spark, sf):
    return validation.issue_counts(_checked(spark, sf))


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    key = F.col("o_orderkey")
    rows = o.select(F.when(key % 13 != 0, key).alias("id"), F.when(key % 11 == 0, F.lit(float("inf"))).otherwise(F.col("o_totalprice")).alias("total"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.when(key % 17 == 0, F.lit("x")).alias("extra"))
    rules = [validation.required("id"), validation.finite_number("total"), validation.enumerated("status", ("F", "O")), validation.pattern("priority", "^1")]
    return validation.with_issues(rows, rules, ["id", "total", "status", "priority"])


@registered("SELECT count(*) AS selected, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid FROM (SELECT o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 17 <> 0 AND o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '1%' AS ok FROM orders)")
def validity_report(spark, sf):
    return validation.validity(_checked(spark, sf))


_LINE = Schema.of(
    ClassSpec("Line", (
        Slot("id", identifier=True), Slot("quantity", "double", required=True), Slot("flag", enum=("A", "N")), Slot("ship", pattern="[12].*"), Slot("rates", "double", multivalued=True), Slot("tags", multivalued=True, enum=("F", "O")), Slot("count", "integer"),
    )),
)


def _line_rows(spark: SparkSession, sf: str) -> DataFrame:
    key, odd = F.col("l_orderkey"), F.col("l_linenumber") % 2 == 1
    return load(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.when(key % 7 != 0, F.col("l_quantity")).alias("quantity"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linenumber").cast("string").alias("ship"),
        F.array(F.col("l_tax"), F.when(key % 9 == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))).alias("rates"),
        F.array(F.when(odd, F.lit("F")).otherwise(F.lit("x")), F.lit(None).cast("string")).alias("tags"),
        F.when(key % 8 == 0, F.lit("many")).otherwise(F.col("l_linenumber").cast("string")).alias("count"),
    )


@registered("""SELECT 'ERROR' AS severity, rule, path, count(*) AS rows FROM (SELECT unnest([
CASE WHEN l_orderkey % 7 = 0 THEN {'rule': 'required', 'path': 'quantity'} END, CASE WHEN l_returnflag NOT IN ('A', 'N') THEN {'rule': 'enum', 'path': 'flag'} END,
CASE WHEN l_linenumber NOT IN (1, 2) THEN {'rule': 'pattern', 'path': 'ship'} END, CASE WHEN l_orderkey % 9 = 0 THEN {'rule': 'finite-number', 'path': 'rates[*]'} END,
CASE WHEN l_linenumber % 2 = 0 THEN {'rule': 'enum', 'path': 'tags[*]'} END, CASE WHEN l_orderkey % 8 = 0 THEN {'rule': 'type', 'path': 'count'} END], recursive := true) FROM lineitem) WHERE rule IS NOT NULL GROUP BY 1, 2, 3""")
def schema_rules(spark, sf):
    """Issues of rows by rules that the schema implies, in lists too."""
    rows = _line_rows(spark, sf)
    return validation.issue_counts(validation.with_issues(rows, validation.schema_rules(_LINE, "Line", rows.schema), [c.name for c in _LINE.flat_columns("Line")]))


@registered("""SELECT 'lines' AS "table", CASE WHEN (SELECT count(*) FROM lineitem) <= 10000 THEN 'full' ELSE 'sample' END AS mode, (SELECT count(*) FROM lineitem) AS eligible, CASE WHEN (SELECT count(*) FROM lineitem) <= 10000 THEN (SELECT count(*) FROM lineitem) ELSE 100 END AS selected
UNION ALL SELECT 'nations', 'full', count(*), count(*) FROM nation""")
def sampled_report(spark, sf):
    """Few rows are validated all, many by a sample that doesn't depend on their order."""
    lines = _line_rows(spark, sf)
    nations = load(spark, sf, "nation")
    found = validation.report({"lines": (lines, validation.schema_rules(_LINE, "Line", lines.schema)), "nations": (nations, [validation.required("n_name")])})
    return found.where(F.col("valid") + F.col("invalid") == F.col("selected")).select("table", "mode", "eligible", "selected")


@registered("SELECT n_name AS \"table\", 'version' AS field, CAST(n_regionkey AS VARCHAR) AS expected, CAST(CASE WHEN n_nationkey % 5 = 0 THEN 9 ELSE n_regionkey END AS VARCHAR) AS found FROM nation WHERE n_nationkey % 5 = 0")
def contract_check(spark, sf):
    """Where a manifest's table facts differ from the schema's."""
    n = load(spark, sf, "nation").select(F.col("n_name").alias("table"), F.lit("version").alias("field"), "n_nationkey", F.col("n_regionkey").cast("string").alias("value"))
    return validation.contract(n.withColumn("value", F.when(F.col("n_nationkey") % 5 == 0, F.lit("9")).otherwise(F.col("value"))).drop("n_nationkey"), n.drop("n_nationkey"))


@registered("""SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}') AS digest FROM customer ORDER BY digest LIMIT 100""")
def digest_sample(spark, sf):
    return validation.sample(load(spark, sf, "customer").select("c_custkey", "c_name"), 100, "c_custkey", "c_name").select("c_custkey", "digest")


@registered("""SELECT n_nationkey AS id, sha256('{"id":' || n_nationkey || ',"place":{"a":[{"k":"' || n_name || '","z":1}],"b":' || n_regionkey || '},"x":{' || CASE WHEN n_nationkey % 2 = 0 THEN '"special":"NaN"' ELSE '"number":0.5' END || '}}') AS digest FROM nation""")
def nested_digest(spark, sf):
    """Keys are sorted at every depth, nulls are left out, and numbers that aren't finite have a form of their own."""
    element = F.struct(F.lit(1).alias("z"), F.col("n_name").alias("k"), F.lit(None).cast("string").alias("m"))
    place = F.struct(F.col("n_regionkey").alias("b"), F.array(element).alias("a"))
    x = F.when(F.col("n_nationkey") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(0.5))
    rows = load(spark, sf, "nation").select(x.alias("x"), place.alias("place"), F.col("n_nationkey").alias("id"))
    return rows.select("id", S.row_digest(rows, *rows.columns).alias("digest"))


@registered("SELECT event_type AS type, count(*) FILTER (event_id % 4 = 0) AS files_with_data, count(*) FILTER (event_id % 4 = 1) AS placeholders, count(*) FILTER (event_id % 4 = 2) AS misses, count(*) FILTER (event_id % 4 = 3) AS errors, sum(user_id) AS rows, sum(event_id % 3) AS null_keys, count(*) FILTER (event_id % 3 > 0) AS files_with_null_keys, array_to_string(list_sort(list('f' || event_id) FILTER (event_id % 4 = 2))[1:5], ',') AS missing FROM events GROUP BY 1")
def load_statistics(spark, sf):
    e = load(spark, sf, "events")
    status = F.element_at(F.array(*map(F.lit, ("data", "placeholder", "miss", "error"))), (F.col("event_id") % 4 + 1).cast("int"))
    bound = e.select(F.col("event_type").alias("type"), F.concat(F.lit("f"), "event_id").alias("file"), status.alias("status"), F.col("user_id").alias("rows"), (F.col("event_id") % 3).alias("null_keys"))
    return validation.load_stats(bound).withColumn("missing", F.array_join("missing", ","))


@registered("SELECT unnest(['customer', 'nation', 'orders', 'part']) AS \"table\", unnest([(SELECT count(*) FROM customer), (SELECT count(*) FROM nation), (SELECT count(*) FROM orders), (SELECT count(*) FROM part)]) AS rows, true AS stable")
def table_inventory(spark, sf):
    """The inventory of four tables, and whether hashes are the same for another order and number of partitions."""
    tables = {n: load(spark, sf, n) for n in ("customer", "nation", "orders", "part")}
    again = snapshot.inventory({n: d.repartition(7).select(*reversed(d.columns)) for n, d in tables.items()}).select("table", F.col("content").alias("c2"), F.col("schema_hash").alias("s2"))
    return snapshot.inventory(tables).join(again, "table").select("table", "rows", ((F.col("content") == F.col("c2")) & (F.col("schema_hash") == F.col("s2"))).alias("stable"))


@registered("SELECT unnest(['customer', 'nation', 'orders', 'part', 'supplier']) AS \"table\", unnest(['keep', 'retire', 'replace', 'add', 'preserve']) AS action")
def disposition_plan(spark, sf):
    t = {n: load(spark, sf, n) for n in ("customer", "nation", "orders", "part", "supplier")}
    candidate = snapshot.inventory({"customer": t["customer"], "orders": t["orders"].where("o_orderkey % 2 = 0"), "part": t["part"]})
    live = snapshot.inventory({n: t[n] for n in ("customer", "orders", "nation", "supplier")})
    rules = spark.createDataFrame([("nation", "retire"), ("supplier", "preserve")], "table string, rule string")
    return snapshot.checked_disposition(snapshot.disposition(candidate, live, rules))


@registered("SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'removed' WHEN o_orderkey % 5 = 1 THEN 'added' WHEN o_orderkey % 5 = 2 THEN 'changed' ELSE 'same' END AS change, count(*) AS rows FROM orders GROUP BY 1")
def row_changes(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 5 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 2, F.lit("?")).otherwise(F.col("o_orderstatus")))
    return snapshot.row_changes(o.where("o_orderkey % 5 <> 1"), new, "o_orderkey")


@registered("SELECT n_name, CASE WHEN n_nationkey % 5 = 0 THEN 'both' WHEN n_nationkey % 5 = 3 THEN 'neither' END AS problem FROM nation WHERE n_nationkey % 5 IN (0, 3)")
def exact_cover(spark, sf):
    n = load(spark, sf, "nation")
    return snapshot.exact_cover(n.select("n_name"), n.where("n_nationkey % 5 in (0, 1)").select("n_name"), n.where("n_nationkey % 5 in (0, 2, 4)").select("n_name"), "n_name")


@registered("SELECT n_name, CASE WHEN n_nationkey % 3 = 1 THEN 'missing' ELSE 'unexpected' END AS side FROM nation WHERE n_nationkey % 3 > 0")
def name_diff(spark, sf):
    n = load(spark, sf, "nation")
    return snapshot.name_differences(n.where("n_nationkey % 3 < 2").select("n_name"), n.where("n_nationkey % 3 <> 1").select("n_name"))


@registered("SELECT event_type, count(*) AS rows FROM events GROUP BY 1")
def value_counts(spark, sf):
    return A.value_counts(load(spark, sf, "events"), "event_type")


@registered("SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS distinct_l_orderkey, count(DISTINCT l_partkey) AS distinct_l_partkey FROM lineitem")
def spot_check(spark, sf):
    return validation.spot_check(load(spark, sf, "lineitem"), "l_orderkey", "l_partkey")


# -- reads and writes of files: what a query writes goes to the shared checkpoint folder ----------------------------------------------


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"


@registered("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%'")
def collection_scan(spark, sf):
    """Equality filters reach the scan."""
    return R.read_collection(spark, f"{sf}/orders.parquet", "parquet", o_orderstatus="F").where(F.col("o_orderpriority").startswith("1"))


@registered("SELECT o_orderkey AS id, o_totalprice AS total, CAST(NULL AS VARCHAR) AS missing FROM orders")
def bulk_flat(spark, sf):
    """A flat JSON collection straight into its target columns."""
    from pyspark.sql import types as T

    path = _folder(spark)
    load(spark, sf, "orders").select(F.lit("x").alias("_id"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("extra")).write.json(path)
    return R.read_flat(spark, path, T.StructType([T.StructField("id", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("missing", T.StringType())]))


@registered("SELECT CAST(p_partkey AS VARCHAR) AS name, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand, CASE WHEN p_partkey % 2 = 1 THEN p_type END AS kind FROM part")
def headered_tsv(spark, sf):
    """Two ages of a headered file: a column was renamed, another replaced."""
    p, path = load(spark, sf, "part"), _folder(spark)
    old = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("user_name"), F.col("p_brand").alias("brand"))
    new = p.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("name"), F.col("p_type").alias("kind"))
    for name, df in (("old", old), ("new", new)):
        df.write.option("sep", "\t").option("header", True).csv(f"{path}/{name}")
    return R.read_drifting(spark, [f"{path}/old", f"{path}/new"], {"user_name": "name"})


@registered("SELECT CAST(l_orderkey AS VARCHAR) AS a_key, string_agg(CAST(l_linenumber AS VARCHAR), '|' ORDER BY l_linenumber) AS lines FROM lineitem GROUP BY 1")
def csv_export(spark, sf):
    path = _folder(spark)
    W.write_csv(load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("lines")).withColumnRenamed("l_orderkey", "a_key"), path)
    return spark.read.option("header", True).csv(path)


@registered("SELECT 'order_set' AS \"table\", count(*) AS rows FROM orders UNION ALL SELECT 'order_set_lines', count(*) FROM lineitem UNION ALL SELECT 'order_set_parts', count(*) FROM lineitem WHERE l_partkey % 10 <> 0")
def promote_table_set(spark, sf):
    """A collection's primary and side tables, staged, checked, promoted over an older set, and counted where they lie."""
    tables, root = flatten.flatten_all({"order_set": nested_orders(spark, sf)}, ORDERS), _folder(spark)
    owned = tuple(n for n in tables if n != "order_set")
    W.promote(spark, {"order_set": tables["order_set"].limit(1)}, root, "order_set", owned)
    W.promote(spark, tables, root, "order_set", owned)
    count = lambda n: spark.read.parquet(f"{root}/{n}").agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows")
    return count("order_set").union(count("order_set_lines")).union(count("order_set_parts"))


@registered("SELECT 1 AS run, count(*) FILTER (l_orderkey % 17 <> 0) AS rows, count(*) FILTER (l_orderkey % 17 = 0) AS rejects FROM lineitem UNION ALL SELECT 2, count(*) FILTER (l_orderkey % 17 <> 0), count(*) FILTER (l_orderkey % 17 = 0) FROM lineitem")
def ingest_incremental(spark, sf):
    """Files of an 11-column table are ingested by a stream; a second run, without the first one's checkpoint, adds nothing."""
    path = _folder(spark)
    _blast_lines(spark, sf).select("value").write.text(f"{path}/in")
    counts, log = [], TableLog(spark, f"{path}/out")
    for run in (1, 2):
        I.ingest(spark, f"{path}/in", R.blast, log.root, f"{path}/checkpoint{run}").awaitTermination()
        counts.append((run, log.read("rows").count(), log.read("rejects").count()))
    return spark.createDataFrame(counts, "run int, rows long, rejects long")


@registered("SELECT 'nation' AS \"table\", 'missing' AS status UNION ALL SELECT 'orders', 'changed' UNION ALL SELECT 'part', 'unexpected'")
def manifest_check(spark, sf):
    """A manifest recomputed over other tables: what is missing, changed and unexpected."""
    t = {n: load(spark, sf, n) for n in ("customer", "nation", "orders", "part")}
    sealed = snapshot.manifest({n: t[n] for n in ("customer", "nation", "orders")}, snapshot.inventory({n: t[n] for n in ("customer", "nation", "orders")}).select("table", "rows"))
    return snapshot.differences(sealed, snapshot.inventory({"customer": t["customer"], "orders": t["orders"].where("o_orderkey <> 1"), "part": t["part"]}))


@registered("SELECT event_type || 'x' AS value, event_type AS suggestion FROM events GROUP BY 1, 2")
def enum_suggestions(spark, sf):
    e = load(spark, sf, "events")
    known = e.select(F.col("event_type").alias("v"))
    return S.suggestions(known.withColumn("v", F.concat("v", F.lit("x"))), known.distinct(), "v").where("place = 1").select("value", "suggestion")


@registered("SELECT 'x' || event_type || 'x' AS value, event_type AS suggestion FROM events WHERE length(event_type) >= 4 GROUP BY 1, 2")
def enum_suggestions_at_both_ends(spark, sf):
    """Values that differ from members in their first and last letters."""
    known = load(spark, sf, "events").select(F.col("event_type").alias("v"))
    return S.suggestions(known.where("length(v) >= 4").withColumn("v", F.concat(F.lit("x"), "v", F.lit("x"))), known, "v").where("place = 1").select("value", "suggestion")


@registered(f"{_WALK.replace('FROM orders\n', 'FROM orders WHERE o_orderstatus = ' + chr(39) + 'F' + chr(39) + chr(10))} SELECT w.origin, r_name, min(hops) AS n_hops FROM w JOIN region ON w.id = 'r' || r_regionkey GROUP BY 1, 2")
def walk_chosen(spark, sf):
    """The walk from a chosen set of runs, with the terminals' own columns."""
    seeds = load(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("o"), "o_orderkey").alias("origin"))
    hops = graph.min_hops(graph.walk(provenance(spark, sf), seeds, F.col("id").startswith("r")))
    region = load(spark, sf, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("terminal_id"), "r_name")
    return hops.join(region, "terminal_id").select("origin", "r_name", "n_hops")


@registered("SELECT event_type AS name, count(*) AS rows FROM events GROUP BY 1")
def tables_by_type(spark, sf):
    """One output for each type that has rows; one of the types has none."""
    e = load(spark, sf, "events")
    kinds = [*sorted(r[0] for r in e.select("event_type").distinct().collect()), "a type without rows"]
    parts = [d.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n, d in W.nonempty_tables(W.by_type(e, "event_type", kinds)).items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@registered("SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS made, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status FROM orders")
def json_union(spark, sf):
    """JSON files of two ages with differing fields, by name; dates stay text."""
    o, path = load(spark, sf, "orders"), _folder(spark)
    key = F.col("o_orderkey").alias("id")
    o.where("o_orderkey % 2 = 0").select(key, F.date_format("o_orderdate", "yyyy-MM-dd").alias("made")).write.json(f"{path}/old")
    o.where("o_orderkey % 2 = 1").select(key, F.col("o_orderstatus").alias("status")).write.json(f"{path}/new")
    return R.read_json_union(spark, f"{path}/old", f"{path}/new")


@registered("SELECT unnest(['orders', 'lineitem', 'events']) AS \"table\", unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM lineitem), (SELECT count(*) FROM events)]) AS rows")
def collection_sizes(spark, sf):
    return R.row_counts({n: load(spark, sf, n) for n in ("orders", "lineitem", "events")})


@registered("SELECT 'run' || (page_id % 7) AS workflow_run_id, CAST(page_id AS VARCHAR) AS data_object_id, page_id * 2 AS n FROM pages WHERE page_id % 3 > 0 AND page_id % 2 = 0")
def manifest_rows(spark, sf):
    """A manifest as CSV: files without bytes go, landed files are bound to it, and their rows get the run and data object of their file."""
    p, path = load(spark, sf, "pages"), _folder(spark)
    size = F.when(F.col("page_id") % 6 == 0, F.lit("none")).when(F.col("page_id") % 3 == 0, F.lit("0")).otherwise(F.lit("12"))
    listed = p.select(F.col("page_id").alias("id"), F.concat(F.lit("https://h/d/"), "page_id", F.lit(".tsv?a=1,b")).alias("url"), size.alias("file_size_bytes"), F.concat(F.lit("run"), F.col("page_id") % 7).alias("was_generated_by"))
    listed.write.option("header", True).option("escape", '"').csv(path)
    landed = p.where("page_id % 2 = 0").select(F.concat(F.lit("/d/"), "page_id", F.lit(".tsv")).alias("file"), (F.col("page_id") * 2).alias("n"))
    return R.tagged(landed, R.bind_manifest(landed, R.nonempty(R.read_manifest(spark, path)))).select("workflow_run_id", "data_object_id", "n")


@registered("SELECT t AS \"table\", unnest(['id', 'customer_balance', 'parts']) AS name, unnest(['string', 'double', 'array<string>']) AS type, n AS rows FROM (SELECT 'all' AS t, (SELECT count(*) FROM orders) AS n UNION ALL SELECT 'none', 0)")
def typed_write(spark, sf):
    """Flat rows in the types that the schema's ranges mean, and an empty table that still has them."""
    path, struct = _folder(spark), ORDERS.flat_struct("Order")
    flat = flatten.primary(nested_orders(spark, sf), ORDERS, "Order").select("parts", "id", F.col("customer_balance").cast("string").alias("customer_balance"))
    W.write_table(flat, f"{path}/all", struct)
    W.write_table(spark.createDataFrame([], "id string"), f"{path}/none", struct)
    found = {n: spark.read.parquet(f"{path}/{n}") for n in ("all", "none")}
    kinds = spark.createDataFrame([(n, f.name, f.dataType.simpleString()) for n, d in found.items() for f in d.schema if f.name in ("id", "customer_balance", "parts")], "`table` string, name string, type string")
    return kinds.join(R.row_counts(found), "table")


@registered("""SELECT unnest(['a', 'b', 'c']) AS "table", unnest([2 * (SELECT count(*) FROM orders), (SELECT count(*) FROM part WHERE p_size > 10), NULL]) AS rows, unnest(['parquet', 'parquet', NULL]) AS format, unnest(['orders', '', NULL]) AS made_of, unnest([false, false, true]) AS to_make""")
def managed_tables(spark, sf):
    """Managed tables: one written and appended to, one replaced as a whole, one that isn't there; what of it the catalog says."""
    name = f"tables_{uuid.uuid4().hex}"
    o, p = load(spark, sf, "orders"), load(spark, sf, "part")
    spark.sql(f"CREATE DATABASE {name}")
    try:
        W.save_managed(o, f"{name}.a", properties={"made_of": "orders", "said": "it's"})
        W.save_managed(o, f"{name}.a", "append")
        W.save_managed(p, f"{name}.b")
        W.save_managed(p.where("p_size > 10").select("p_partkey"), f"{name}.b", "overwrite")
        counted = {r["table"]: r["rows"] for r in snapshot.catalog_inventory(spark, name).collect()}
        formats = {r["table"]: r["format"] for r in snapshot.catalog_formats(spark, name, "parquet").collect()}
        missing = W.to_register(spark, name, ["a", "b", "c"])
        rows = []
        for t in ("a", "b", "c"):
            there = R.table_or_none(spark, f"{name}.{t}") is not None
            rows.append((t, counted.get(t), formats.get(t), W.properties_of(spark, f"{name}.{t}").get("made_of", "") if there else None, t in missing))
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return spark.createDataFrame(rows, "`table` string, rows long, format string, made_of string, to_make boolean")


@registered("SELECT n AS bad_types, p AS allow_partial, CASE WHEN p OR n = 0 THEN 'loaded' ELSE 'stopped' END AS outcome FROM (SELECT count(DISTINCT event_type) FILTER (event_id % 4 > 1) AS n FROM events), (SELECT unnest([true, false]) AS p)")
def partial_load_gate(spark, sf):
    """A load with misses or errors stops, unless a partial one is allowed."""
    e = load(spark, sf, "events")
    stats = e.groupBy(F.col("event_type").alias("type")).agg(F.count_if(F.col("event_id") % 4 == 2).alias("misses"), F.count_if(F.col("event_id") % 4 == 3).alias("errors"))
    bad, rows = stats.where("misses > 0 or errors > 0").count(), []
    for partial in (True, False):
        try:
            W.gate(stats, partial)
            rows.append((bad, partial, "loaded"))
        except W.PromotionError:
            rows.append((bad, partial, "stopped"))
    return spark.createDataFrame(rows, "bad_types long, allow_partial boolean, outcome string")


@registered("""SELECT unnest(['lines', 'bad', 'all']) AS run, unnest(['success', 'failed', NULL]) AS status, unnest([NULL, 'error', NULL]) AS error, unnest([(SELECT count(*) FROM lineitem), 0, (SELECT count(*) FROM lineitem)]) AS rows_read,
unnest([(SELECT count(*) FROM lineitem WHERE l_quantity > 10), 0, (SELECT count(*) FROM lineitem WHERE l_quantity > 10)]) AS rows_written, unnest([true, false, true]) AS has_bytes""")
def run_log(spark, sf):
    """Rows read and written as Spark counts them while it writes, a run that fails, and totals."""
    lines, path = load(spark, sf, "lineitem"), _folder(spark)
    runs = [
        snapshot.measured("lines", lines, lambda d: d.where("l_quantity > 10"), f"{path}/lines"),
        snapshot.measured("bad", lines, lambda d: d.select(F.raise_error(F.lit("a secret")).cast("string").alias("x")), f"{path}/bad"),
    ]
    log = snapshot.run_metrics(spark, runs)
    totals = snapshot.run_totals(log).select(F.lit("all").alias("run"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("error"), "rows_read", "rows_written", "bytes")
    every = log.select("run", "status", "error", "rows_read", "rows_written", "bytes").unionByName(totals)
    return every.select("run", "status", F.when(F.col("error").isNotNull(), "error").alias("error"), "rows_read", "rows_written", (F.col("bytes") > 0).alias("has_bytes"))


@registered("""SELECT unnest(['orders', 'part']) AS "table", unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM part)]) AS rows, true AS same_bytes, unnest(['customer|orders', '']) AS made_from, true AS refused""")
def stored_manifest(spark, sf):
    """A manifest of stored tables whose rows and bytes agree with the run's; other bytes are refused."""
    path, runs = _folder(spark), []
    for n in ("orders", "part"):
        runs.append(snapshot.measured(n, load(spark, sf, n), lambda d: d, f"{path}/{n}"))
    metrics = snapshot.run_metrics(spark, runs).select(F.col("run").alias("table"), F.col("rows_written").alias("rows"), "bytes")
    paths = {n: f"{path}/{n}" for n in ("orders", "part")}
    try:
        snapshot.stored_manifest(spark, paths, metrics.withColumn("bytes", F.col("bytes") + 1))
        refused = False
    except snapshot.SnapshotError:
        refused = True
    sealed = snapshot.stored_manifest(spark, paths, metrics, {"orders": ["orders", "customer"]})
    said = metrics.select("table", F.col("bytes").alias("said"))
    return sealed.join(said, "table").select("table", "rows", (F.col("bytes") == F.col("said")).alias("same_bytes"), F.array_join("made_from", "|").alias("made_from"), F.lit(refused).alias("refused"))


# -- tables of a log ----------------------------------------------------------------------------------------------------------


@registered(ORACLES["side_child"])
def publish_collection(spark, sf):
    """A collection's primary and side tables from one pass over its records, published together over an older set; the lines as the log has them."""
    log = TableLog(spark, _folder(spark))
    publish(log, flatten.records(spark.createDataFrame([('{"id": "old", "lines": [{"number": 1}]}',)], "raw string")), ORDERS, "Order", "order_set")
    publish(log, nested_orders(spark, sf), ORDERS, "Order", "order_set")
    return log.read("order_set_lines").select("parent_id", "number", "part", "quantity", "price", "flag")


@registered("SELECT event_type AS name, count(*) AS rows, round(sum(value), 2) AS v FROM events GROUP BY 1")
def publish_types(spark, sf):
    """One table for each type that has rows, from one pass; one of the types has none."""
    e, log = load(spark, sf, "events"), TableLog(spark, _folder(spark))
    kinds = [*sorted(r[0] for r in e.select("event_type").distinct().collect()), "a type without rows"]
    found = publish_by_type(log, e, "event_type", kinds)
    at = log.snapshot()
    return reduce(lambda a, b: a.unionByName(b), [log.read(n, at).agg(F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("v")).select(F.lit(n).alias("name"), "rows", "v") for n in found])


@registered("""SELECT 'old' AS age, 'orders' AS "table", count(*) AS rows FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'old', 'orders_customers', count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'new', 'orders', count(*) FROM orders UNION ALL SELECT 'new', 'orders_lines', count(*) FROM lineitem""")
def promote_at_once(spark, sf):
    """A table set promoted over another in one step: a reader of the older snapshot keeps its set, one of the newer sees the new set, in which a side table is gone and another has come."""
    o, lines, log = load(spark, sf, "orders"), load(spark, sf, "lineitem"), TableLog(spark, _folder(spark))
    owned, half = ("orders_customers", "orders_lines"), o.where("o_orderkey % 2 = 0")
    old = log.promote({"orders": half, "orders_customers": half.select("o_custkey").distinct()}, "orders", owned)
    new = log.promote({"orders": o, "orders_lines": lines}, "orders", owned)
    count = lambda age, at: [log.read(n, at).agg(F.count("*").alias("rows")).select(F.lit(age).alias("age"), F.lit(n).alias("table"), "rows") for n in at.tables]
    return reduce(lambda a, b: a.unionByName(b), [*count("old", old), *count("new", new)])


@registered("""SELECT 'gottcha2_classification_report' AS name, count(*) AS rows, 0 AS rejects, sum(s_suppkey) AS total FROM supplier
UNION ALL SELECT 'kraken2_classification_report', count(*) FILTER (p_partkey % 7 <> 0), count(*) FILTER (p_partkey % 7 = 0), sum(p_partkey) FILTER (p_partkey % 7 <> 0) FROM part
UNION ALL SELECT 'centrifuge_output_report_file', count(*), 0, sum(c_custkey) FROM customer
UNION ALL SELECT 'gtdbtk_bacterial_summary', count(*), 0, sum(p_partkey) FROM part
UNION ALL SELECT 'gtdbtk_archaeal_summary', 0, 0, NULL
UNION ALL SELECT 'checkm_statistics', count(*), 0, sum(n_nationkey) FROM nation
UNION ALL SELECT 'annotation_statistics', count(*) FILTER (n_nationkey % 5 <> 0), count(*) FILTER (n_nationkey % 5 = 0), sum(n_nationkey) FILTER (n_nationkey % 5 <> 0) FROM nation""")
def ingest_file_types(spark, sf):
    """Files of all seven kinds of summaries, by the names of their types: headered, headerless, aligned, whole reports and placeholders, streamed into one log, twice."""
    t, path = {n: load(spark, sf, n) for n in ("supplier", "part", "customer", "nation", "region")}, _folder(spark)
    text = lambda *c: F.concat_ws("\t", *[F.col(x).cast("string") if isinstance(x, str) else x for x in c]).alias("value")
    at = lambda kind: f"{path}/in/{S.safe_name(kind)}"
    table = lambda df, kind: df.write.mode("append").option("sep", "\t").option("header", True).csv(at(kind))
    # a file for each row
    whole = lambda df, kind: df.write.mode("append").option("maxRecordsPerFile", 1).text(at(kind))
    kinds = list(R.FORMATS)[:7]
    table(t["supplier"].select(F.lit("genus").alias("LEVEL"), F.col("s_name").alias("NAME"), F.col("s_suppkey").alias("TAXID")), kinds[0])
    lines = text(F.lit("1.5"), F.lit("3"), F.lit("2"), F.lit("S"), "p_partkey")
    t["part"].select(F.when(F.col("p_partkey") % 7 == 0, lines).otherwise(F.concat(lines, F.lit("\t  "), "p_name")).alias("value")).write.mode("append").text(at(kinds[1]))
    table(t["customer"].select(F.col("c_name").alias("name"), F.col("c_custkey").alias("taxID")), kinds[2])
    table(t["part"].where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("user_genome"), F.col("p_type").alias("classification")), kinds[3])
    table(t["part"].where("p_partkey % 2 = 1").select(F.col("p_brand").alias("user_genome"), F.col("p_partkey").alias("name")), kinds[3])
    row = F.concat(F.lit("  Bin Id   a\n----\n  "), "n_nationkey", *[F.lit(f"   {i}") for i in range(13)])
    whole(t["nation"].select(row.alias("value")), kinds[5])
    rule = "=" * 20
    report = F.concat(F.lit(f"Predicted Genes Statistics\n{rule}\nFeature type\tNumber of predicted features\n'CDS'\t"), "n_nationkey", F.lit(f"\n{rule}\n"))
    whole(t["nation"].select(F.when(F.col("n_nationkey") % 5 == 0, F.lit("another report\nwithout sections")).otherwise(report).alias("value")), kinds[6])
    for kind, phrase in zip(kinds, (R.PLACEHOLDERS[i] for i in (1, 4, 6, 3, 2, 0, 8)), strict=True):
        whole(t["region"].select(F.concat(F.lit(f"{phrase} "), "r_name").alias("value")), kind)
    log, counts = TableLog(spark, f"{path}/log"), []
    for run in (1, 2):
        for query in I.ingest_types(spark, {k: at(k) for k in kinds}, log.root, f"{path}/checkpoint{run}", S.safe_name).values():
            query.awaitTermination()
    snapshot_ = log.snapshot()
    numbers = ("fields.TAXID", "taxid", "fields.taxID", "fields.name", "fields.name", "bin_id", "n_cds")
    for kind, number in zip(kinds, numbers, strict=True):
        name = S.safe_name(kind)
        counts.append(log.read(name, snapshot_).agg(F.count("*").alias("rows"), F.sum(F.expr(number).cast("long")).alias("total")).select(F.lit(name).alias("name"), "rows", F.lit(snapshot_.tables[f"{name}_rejects"].rows).cast("long").alias("rejects"), "total"))
    return reduce(lambda a, b: a.unionByName(b), counts)


@registered("""WITH RECURSIVE n AS (SELECT n_name AS a FROM nation UNION SELECT c_mktsegment FROM customer UNION SELECT r_name FROM region),
p AS (SELECT v.b, n.a FROM (SELECT DISTINCT substr(a, 4) || substr(a, 1, 3) AS b FROM n) v, n),
m AS MATERIALIZED (SELECT a, b, i, j, (SELECT max(k) FROM range(0, least(length(a) - i, length(b) - j) + 2) r(k) WHERE substr(a, i, k) = substr(b, j, k)) AS k FROM (SELECT a, b, unnest(range(1, length(a) + 1)) AS i, range(1, length(b) + 1) AS js FROM p), unnest(js) u(j)),
s AS (SELECT a, b, 1 AS al, length(a) + 1 AS ah, 1 AS bl, length(b) + 1 AS bh, 0 AS got FROM p
UNION ALL SELECT a, b, unnest([al, x.i + x.k]), unnest([x.i, ah]), unnest([bl, x.j + x.k]), unnest([x.j, bh]), unnest([x.k, 0]) FROM (SELECT s.a, s.b, al, ah, bl, bh, arg_max({'i': i, 'j': j, 'k': least(k, ah - i, bh - j)}, least(k, ah - i, bh - j) * 1000000 - i * 1000 - j) AS x
FROM s JOIN m ON m.a = s.a AND m.b = s.b AND i >= al AND i < ah AND j >= bl AND j < bh GROUP BY ALL) WHERE x.k > 0),
l AS (SELECT b AS value, a AS suggestion, 2.0::DOUBLE * sum(got) / (length(a) + length(b)) AS likeness FROM s GROUP BY a, b)
SELECT value, suggestion, CAST(round(likeness, 6) AS DOUBLE) AS likeness, CAST(row_number() OVER (PARTITION BY value ORDER BY likeness DESC, suggestion DESC) AS INTEGER) AS place FROM l WHERE likeness >= 0.6 QUALIFY place <= 3""")
def suggestions_by_blocks(spark, sf):
    """Names whose two parts have changed places, against the names: likeness by matching blocks."""
    t = {n: load(spark, sf, n) for n in ("nation", "customer", "region")}
    names = t["nation"].select(F.col("n_name").alias("v")).union(t["customer"].select("c_mktsegment")).union(t["region"].select("r_name"))
    turned = names.select(F.concat(F.substring("v", 4, 1000), F.substring("v", 1, 3)).alias("v"))
    return S.suggestions(turned, names, "v").withColumn("likeness", F.round("likeness", 6))


@registered("""SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 7 THEN 'removed' ELSE 'changed' END AS change FROM orders WHERE o_orderkey % 1000 IN (7, 8)
UNION ALL SELECT -o_orderkey, 'added' FROM orders WHERE o_orderkey % 1000 = 9""")
def changes_by_range(spark, sf):
    """Rows in which two sealed ages of a table differ, of which only ranges with other digests are read."""
    o, path, k = load(spark, sf, "orders"), _folder(spark), F.col("o_orderkey") % 1000
    digests.seal(o, f"{path}/old", "o_orderkey", ranges=64)
    kept = o.where(k != 7).withColumn("o_totalprice", F.when(k == 8, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    digests.seal(kept.unionByName(o.where(k == 9).withColumn("o_orderkey", -F.col("o_orderkey"))), f"{path}/new", "o_orderkey", ranges=64)
    return digests.changes(spark, f"{path}/old", f"{path}/new", "o_orderkey")


@registered("""SELECT 'night' AS run, NULL AS parent, 'success' AS status, (SELECT count(*) FROM orders) AS rows_read, (SELECT count(*) FROM orders) + (SELECT count(*) + count(*) FILTER (l_partkey % 10 <> 0) FROM lineitem) AS rows_written
UNION ALL SELECT 'order_set', 'night', 'success', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders) + (SELECT count(*) + count(*) FILTER (l_partkey % 10 <> 0) FROM lineitem)
UNION ALL SELECT 'order_set/order_set', 'order_set', 'success', NULL, count(*) FROM orders UNION ALL SELECT 'order_set/order_set_lines', 'order_set', 'success', NULL, count(*) FROM lineitem
UNION ALL SELECT 'order_set/order_set_parts', 'order_set', 'success', NULL, count(*) FROM lineitem WHERE l_partkey % 10 <> 0""")
def run_records(spark, sf):
    """A run over a database, its collections and their tables, from Spark's own counts."""
    results = publish_all(TableLog(spark, _folder(spark)), {"order_set": nested_orders(spark, sf)}, ORDERS)
    return run_tree(spark, "night", results).select("run", "parent", "status", "rows_read", "rows_written")


@registered("""SELECT 'order_set' AS "table", unnest(['customer_balance', 'customer_key', 'customer_name', 'customer_nation_name', 'customer_segment', 'id', 'status', 'total']) AS name,
unnest(['double', 'bigint', 'string', 'string', 'string', 'string', 'string', 'double']) AS kind, count(*) AS filled FROM orders GROUP BY 1, 2, 3
UNION ALL SELECT 'order_set', 'parts', 'array<string>', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'order_set_lines', 'part_id', 'string', 0
UNION ALL SELECT 'order_set_lines', unnest(['flag', 'number', 'parent_id', 'part', 'price', 'quantity']), unnest(['string', 'bigint', 'string', 'string', 'double', 'double']), count(*) FROM lineitem GROUP BY 1, 2, 3
UNION ALL SELECT 'order_set_lines', 'type', 'string', 0 UNION ALL SELECT 'order_set_parts', unnest(['parent_id', 'parts']), 'string', count(*) FROM lineitem WHERE l_partkey % 10 <> 0 GROUP BY 1, 2, 3""")
def database_columns(spark, sf):
    """The columns that the schema gives a whole database, with their types, and how many rows of the flattened tables have them."""
    made = flatten.flatten_all({"order_set": flatten.parsed_once(nested_orders(spark, sf))}, ORDERS)
    parts = []
    for table, struct in ORDERS.database().items():
        counts = made[table].agg(*[F.count(f"`{f.name}`").alias(f.name) for f in struct if f.name in made[table].columns])
        kinds = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in struct], "name string, kind string")
        parts.append(counts.unpivot([], list(counts.columns), "name", "filled").join(kinds, "name", "right").select(F.lit(table).alias("table"), "name", "kind", F.coalesce("filled", F.lit(0)).alias("filled")))
    return reduce(lambda a, b: a.unionByName(b), parts)
