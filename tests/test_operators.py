"""Units of the flattening compiler, writers, walks, validation, inventories and ingest on hand-made frames."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scalars as S
from tessera.operators import extract, flatten, graph, snapshot, validation
from tessera.plans import analytics as A
from tessera.schema import ClassSpec, Schema, SchemaError, Slot
from tessera.sinks import tables as W
from tessera.sinks.tablelog import TableLog
from tessera.sources import readers as R
from tessera.streaming import ingest as I

SCHEMA = Schema.of(
    ClassSpec("Term", (Slot("id", required=True, identifier=True), Slot("name"))),
    ClassSpec("Value", (Slot("has_raw_value"), Slot("aliases", multivalued=True), Slot("term", "Term"), Slot("type"))),
    ClassSpec("Text", (Slot("has_raw_value"),)),
    ClassSpec(
        "Record",
        (
            Slot("id", identifier=True), Slot("name"), Slot("depth", "meters"), Slot("tags", multivalued=True), Slot("env", "Value", inlined=True), Slot("about", "Text", inlined=True), Slot("chem", "Value", multivalued=True, inlined=True),
            Slot("studies", "Term", multivalued=True), Slot("scores", "integer", multivalued=True), Slot("parent", "Term"), Slot("type"),
        ),
    ),
    ClassSpec("Process", (Slot("id", identifier=True), Slot("type", required=True, designates_type=True))),
    ClassSpec("Pooling", (Slot("method", description="How."),), is_a="Process"),
    ClassSpec("Extraction", (Slot("targets", multivalued=True), Slot("inputs", "Term", multivalued=True)), is_a="Process"),
    ClassSpec("Holder", (Slot("id", identifier=True), Slot("step", "Process", inlined=True))),
    ClassSpec("Database", (Slot("record_set", "Record", multivalued=True), Slot("process_set", "Process", multivalued=True))),
    types={"meters": "measure", "measure": "float", "loop": "loop"},
)


def frame(spark, *records):
    return flatten.records(spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "raw string"))


def first(df):
    return df.first().asDict()


def test_scalars_lists_and_references(spark):
    row = first(flatten.primary(frame(spark, {"id": "r", "depth": "2.5", "tags": "lone", "scores": [1, 2], "studies": ["a", {"id": "b"}], "parent": {"id": "p"}, "name": None}), SCHEMA, "Record"))
    assert (row["depth"], row["tags"], row["scores"], row["studies"], row["parent"], row["name"]) == (2.5, ["lone"], [1, 2], ["a", "b"], "p", None)


def test_two_levels_and_no_more(spark):
    value = {"has_raw_value": "x", "type": "n:Value", "aliases": ["q"], "term": {"id": "t", "name": "T", "deep": {"x": 1}}}
    row = first(flatten.primary(frame(spark, {"id": "r", "env": value, "chem": [value], "about": {"has_raw_value": "y"}}), SCHEMA, "Record"))
    assert row["env_has_raw_value"] == "x" and row["env_term_id"] == "t" and row["env_term_name"] == "T" and row["env_aliases"] == ["q"] and row["about_has_raw_value"] == "y"
    assert "env_type" not in row and "chem" not in row and not any("deep" in c for c in row)


def test_integers_must_be_whole_and_numbers_numbers(spark):
    schema = Schema.of(ClassSpec("N", (Slot("id", identifier=True), Slot("n", "integer"), Slot("x", "double"), Slot("b", "boolean"))))
    rows = frame(spark, {"id": "a", "n": 3.0, "x": 1, "b": True}, {"id": "b", "n": 2**60, "x": "4", "b": None})
    assert [tuple(r) for r in flatten.primary(rows, schema, "N").select("id", "n", "x", "b").collect()] == [("a", 3, 1.0, True), ("b", 2**60, 4.0, None)]
    bad = frame(spark, {"id": "a", "n": 1.5})
    assert first(flatten.primary(bad, schema, "N", strict=False))["n"] is None
    with pytest.raises(Exception, match="n is not a long"):
        flatten.primary(bad, schema, "N").collect()


def test_dispatch(spark):
    rows = frame(spark, {"id": "1", "type": "x:Pooling", "method": "m", "targets": ["t"]}, {"id": "2", "type": "Extraction", "method": "m", "targets": ["t"]}, {"id": "3", "type": "x:Nobody", "method": "m"}, {"id": "4", "type": "Record", "method": "m"}, "no json")
    got = {r["id"]: (r["method"], r["targets"]) for r in flatten.primary(rows, SCHEMA, "Process").collect()}
    assert got == {"1": ("m", None), "2": (None, ["t"]), "3": (None, None), "4": (None, None), None: (None, None)}
    inner = frame(spark, {"id": "h", "step": {"id": "s", "type": "x:Pooling", "method": "m", "targets": ["t"]}})
    row = first(flatten.primary(inner, SCHEMA, "Holder"))
    assert row["step_id"] == "s" and row["step_method"] == "m" and row["step_targets"] is None


def test_side_tables(spark):
    rows = frame(
        spark,
        {"id": "r", "studies": ["a", None, "a"], "chem": [{"has_raw_value": "x", "type": "Value", "term": {"id": "t"}}, "no object"]},
        {"id": "", "studies": ["z"]},
        {"studies": ["z"]},
        {"id": "s", "chem": {"has_raw_value": "lone"}},
    )
    tables = flatten.side_tables(rows, SCHEMA, "Record", "record_set")
    assert sorted(tables) == ["record_set_chem", "record_set_studies"]
    assert [tuple(r) for r in tables["record_set_studies"].collect()] == [("r", "a"), ("r", "a")]
    assert {(r["parent_id"], r["type"], r["has_raw_value"], r["term_id"]) for r in tables["record_set_chem"].collect()} == {("r", "Value", "x", "t"), ("s", None, "lone", None)}
    process = frame(spark, {"id": "1", "type": "Extraction", "inputs": ["t"]}, {"id": "2", "type": "Pooling", "inputs": ["t"]}, {"id": "3", "type": "Record", "inputs": ["t"]})
    assert [r["parent_id"] for r in flatten.side_tables(process, SCHEMA, "Process", "p")["p_inputs"].collect()] == ["1"]


def test_flat_schema(spark):
    struct = SCHEMA.flat_struct("Process")
    assert struct.names == ["id", "inputs", "method", "targets", "type"]
    assert struct["method"].metadata["comment"] == "How. Only in Pooling."
    assert SCHEMA.flat_struct("Record")["depth"].dataType == T.DoubleType() and SCHEMA.type_of("loop") == T.StringType()
    made = flatten.primary(frame(spark, {"id": "1"}), SCHEMA, "Process")
    assert made.schema["method"].metadata == struct["method"].metadata and made.columns == struct.names
    assert sorted(SCHEMA.database()) == ["process_set", "process_set_inputs", "record_set", "record_set_chem", "record_set_studies"]
    with pytest.raises(SchemaError):
        Schema.of(ClassSpec("A"), ClassSpec("A"))
    with pytest.raises(SchemaError, match="a_b"):
        Schema.of(ClassSpec("A", (Slot("a_b"), Slot("a", "B", inlined=True))), ClassSpec("B", (Slot("b"),))).flat_columns("A")
    again = Schema.from_dict({"classes": {"A": {"slots": {"id": {"identifier": True}, "x": None}}, "B": {"is_a": "A"}}})
    assert [c.name for c in again.flat_columns("B")] == ["id", "x"]


def test_schemas_survive_parquet(spark, tmp_path):
    W.write_table(flatten.primary(frame(spark, {"id": "1", "type": "Pooling", "method": "m"}), SCHEMA, "Process"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["method"].metadata["comment"] == "How. Only in Pooling."
    W.write_table(spark.createDataFrame([], "id string"), str(tmp_path / "e"), SCHEMA.flat_struct("Process"))
    assert spark.read.parquet(str(tmp_path / "e")).columns == ["id", "inputs", "method", "targets", "type"]


def test_conform_prune_and_names(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None, "x")], "id string, n int, empty string, odd string")
    out = W.conform(df, T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.ArrayType(T.LongType())), T.StructField("new", T.DoubleType())]))
    assert first(out) == {"id": "a", "n": [1], "new": None}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        W.conform(df, T.StructType([T.StructField("odd", T.LongType())])).collect()
    assert W.prune_empty(df, ("id",)).columns == ["id", "n", "odd"]
    assert W.prune_empty(df.limit(0)).columns == df.columns
    with pytest.raises(ValueError, match="same name"):
        W.sanitised(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))
    assert list(W.by_type(df, "odd", ["x y", "z"])) == ["x_y", "z"]
    W.write_csv(df.withColumn("l", F.array(F.lit(1), F.lit(2))), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).select("l", "id").first() == ("1|2", "a")


def test_promotion(spark, tmp_path):
    root = str(tmp_path / "set")
    one = spark.createDataFrame([("a",)], "id string")
    assert W.promote(spark, {"p": one, "p_s": one.union(one)}, root, "p", ("p_s", "p_t")) == {"p": 1, "p_s": 2}
    assert W.promote(spark, {"p": one.union(one)}, root, "p", ("p_s",)) == {"p": 2}
    assert spark.read.parquet(f"{root}/p").count() == 2 and not Path(f"{root}/p_s").exists()
    for tables in ({"q": one}, {"p": one, "x": one}):
        with pytest.raises(W.PromotionError):
            W.promote(spark, tables, root, "p", ())
    failing = one.select(F.raise_error(F.lit("no")).cast("string").alias("id"))
    with pytest.raises(Exception, match="no"):
        W.promote(spark, {"p": failing}, root, "p", ())
    assert spark.read.parquet(f"{root}/p").count() == 2
    with pytest.raises(W.PromotionError, match="KO: 1 missing"):
        W.gate(spark.createDataFrame([("KO", 1, 0)], "type string, misses long, errors long"))


def test_managed_tables(spark):
    df = spark.createDataFrame([(1,)], "a int")
    spark.sql("CREATE DATABASE IF NOT EXISTS tables_db")
    W.save_managed(df, "tables_db.one", "overwrite")
    W.save_managed(df, "tables_db.one", "append")
    assert R.table_or_none(spark, "tables_db.one").count() == 2 and R.table_or_none(spark, "tables_db.none") is None
    with pytest.raises(Exception, match="already exists"):
        W.save_managed(df, "tables_db.one")
    assert W.to_register(spark, "tables_db", ["one", "two"]) == ["two"] and W.to_register(spark, "tables_db", ["one"], force=True) == ["one"]
    assert [(r["table"], r["rows"]) for r in snapshot.catalog_inventory(spark, "tables_db").collect()] == [("one", 2)]
    spark.sql("DROP DATABASE tables_db CASCADE")


def test_walk(spark):
    links = [("r1", "a"), ("a", "end1"), ("r2", "p"), ("p", "end1"), ("p", "end2"), ("r3", "x"), ("x", "y"), ("y", "end3"), ("x", "end3"), ("r4", "c"), ("c", "d"), ("d", "c"), ("end1", "never")]
    edges = spark.createDataFrame([(a, b, "s") for a, b in links], "src string, next_id string, slot string")
    seeds = spark.createDataFrame([(f"r{i}",) for i in range(1, 6)], "origin string")
    end = F.col("id").startswith("end")
    reached = graph.walk(edges, seeds, end)
    want = {("r1", "end1", 2), ("r2", "end1", 2), ("r2", "end2", 2), ("r3", "end3", 2)}
    assert {tuple(r) for r in graph.min_hops(reached).collect()} == want
    assert {tuple(r) for r in graph.walk_recursive(spark, edges, seeds, F.col("id").startswith("end")).collect()} == want
    assert {tuple(r) for r in graph.walk(edges.repartition(7), seeds, end, 1).where("terminal").collect()} == set()
    types = spark.createDataFrame([("a", "Pooling"), ("p", "Pooling"), ("x", "Other"), ("end1", "Extraction")], "id string, type string")
    origins = spark.createDataFrame([("r1", "W"), ("r2", "W")], "origin string, origin_type string")
    table = {(r["origin"], r["terminal_id"]): (r["origin_type"], r["n_hops"], r["has_p"], r["has_e"]) for r in graph.bridge(reached, types, origins, {"Pooling": "has_p", "Extraction": "has_e"}).collect()}
    assert table == {("r1", "end1"): ("W", 2, True, False), ("r2", "end1"): ("W", 2, True, False), ("r2", "end2"): ("W", 2, True, False), ("r3", "end3"): (None, 2, False, False)}
    assert [tuple(r) for r in graph.unknown_types(types, ("Pooling", "Extraction")).collect()] == [("Other", 1)]


def test_parsers(spark, tmp_path):
    lines = spark.createDataFrame([("f", x) for x in ["g\t1\tK1\t99.5\t1\t2\t3\t4\t1e-5\t50\t7", "bad\tline", "", "g\tx\tK2\t\t1\t2\t3\t4\t0\t1\t2"]], "file string, value string")
    rows, bad = R.blast(lines)
    assert [(r["annotation_id"], r["ncbi_taxid"], r["evalue"], r["pct_identity"]) for r in rows.collect()] == [("K1", 1, 1e-5, 99.5), ("K2", None, 0.0, None)] and bad.count() == 1
    assert R.kraken(spark.createDataFrame([("f", " 1.5\t2\t3\tS\t9\t  E coli")], "file string, value string"))[0].first()["name"] == "  E coli"
    terms = spark.createDataFrame([("PF1\t\tc\tn\td",), (" ",)], "value string")
    assert R.strict_terms(terms).collect() == [("PF1", None, "c", "n", "d")]
    with pytest.raises(Exception, match="fields expected: 5, found: 2"):
        R.strict_terms(spark.createDataFrame([("a\tb",)], "value string")).collect()
    for name, head in (("a", "name\tx"), ("b", "user_genome\tx")):
        (tmp_path / f"{name}.tsv").write_text(f"{head}\nv{name}\t1\n")
    assert {r["name"] for r in R.read_drifting(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")], {"user_genome": "name"}).collect()} == {"va", "vb"}
    (tmp_path / "j.json").write_text('{"_id":1,"a":"x","extra":2}\n{"b":3}\n')
    flat = R.read_flat(spark, str(tmp_path / "j.json"), T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())]))
    assert sorted(map(tuple, flat.collect()), key=str) == [("x", None), (None, 3)]
    assert R.read_collection(spark, str(tmp_path / "j.json"), "json", a="x").drop("extra").first() == ("x", None)
    assert R.read_json_union(spark, str(tmp_path / "j.json"), str(tmp_path / "j.json")).count() == 4
    manifest = spark.createDataFrame([("1", "https://h/x/../a"), ("2", "https://h/a?q")], "id string, url string")
    bound = R.bind_manifest(spark.createDataFrame([("/a",)], "file string"), manifest)
    assert {r["id"]: r["hit"] for r in bound.collect()} == {"1": False, "2": True}


def test_scalars(spark):
    df = spark.createDataFrame([("ABC_1_2", "k=1;x=2;k=3", " 'q' ", "12%")], "c string, a string, q string, p string")
    row = df.select(S.normal_curie("c"), S.attribute("a", "k"), S.attribute("a", "zz"), S.unquoted("q"), S.percent("p"), S.prefixed("K:", "c", 4)).first()
    assert tuple(row) == ("ABC:1_2", "3", None, "q", 12.0, "K:1_2")
    known = spark.createDataFrame([("metagenome",), ("metabolome",), ("proteome",)], "v string")
    assert [r["suggestion"] for r in S.suggestions(spark.createDataFrame([("metagenom",)], "v string"), known, "v").orderBy("place").collect()] == ["metagenome", "metabolome"]
    clicks = spark.createDataFrame([("click",), ("click_through",), ("",)], "v string")
    asked = spark.createDataFrame([("xlicx",), ("cxick_throughx",), (None,), ("zzzzzzzzzz",)], "v string")
    assert {(r["value"], r["suggestion"]) for r in S.suggestions(asked, clicks, "v").collect()} == {("xlicx", "click"), ("cxick_throughx", "click_through")}
    assert S.safe_name("KO, annotation (v2)") == "ko_annotation_v2"


def test_rules_of_a_schema(spark):
    schema = Schema.of(ClassSpec("Base", (Slot("id", identifier=True), Slot("kind", enum=("a", "b"), required=True), Slot("n", "float", multivalued=True))), ClassSpec("Sub", (Slot("code", pattern="[A-Z]{2}"),), is_a="Base"))
    df = spark.createDataFrame([("1", "a", [1.0, None], "AB"), (None, "z", [float("inf")], "ABC"), ("3", None, None, None)], "id string, kind string, n array<double>, code string")
    issues = validation.issue_counts(validation.with_issues(df, validation.schema_rules(schema, "Base", df.schema), df.columns))
    assert {(r["rule"], r["path"], r["rows"]) for r in issues.collect()} == {("required", "id", 1), ("required", "kind", 1), ("enum", "kind", 1), ("finite-number", "n[*]", 1), ("pattern", "code", 1)}


def test_an_anchor_is_needed(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string")
    assert A.anchor_row(df, "id").first()["v"] == "a"
    with pytest.raises(LookupError):
        A.anchor_row(df.where("id > 5"), "id")


def test_validation(spark):
    df = spark.createDataFrame([(1, "a", 1.0, ["x"]), (None, "z", float("nan"), ["q"])], "id int, kind string, n double, tags array<string>")
    rules = [validation.required("id"), validation.enumerated("kind", ("a",)), validation.finite_number("n"), validation.list_members("tags", ("x",)), *validation.rules_of(T.StructType([]), {"kind": {"pattern": "^[a-z]$"}})]
    checked = validation.with_issues(df, rules)
    assert {(r["rule"], r["path"], r["rows"]) for r in validation.issue_counts(checked).collect()} == {("required", "id", 1), ("enum", "kind", 1), ("finite-number", "n", 1), ("enum", "tags[*]", 1)}
    assert validation.report({"t": (df, rules)}).first().asDict() == {"table": "t", "mode": "full", "eligible": 2, "selected": 2, "valid": 1, "invalid": 1}
    many = spark.range(500).withColumn("x", F.col("id") * 2)
    picks = [{r["id"] for r in validation.sample(d, 20).collect()} for d in (many.repartition(1), many.repartition(7).orderBy(F.desc("id")))]
    assert picks[0] == picks[1] and len(picks[0]) == 20
    rows, mode, eligible = validation.selected(many, full_up_to=100, sample_rows=7)
    assert (rows.count(), mode, eligible) == (7, "sample", 500)
    a = spark.createDataFrame([("t", "class", "A")], "table string, field string, value string")
    assert validation.contract(a, a).count() == 0 and validation.contract(a, a.withColumn("value", F.lit("B"))).count() == 1


def test_snapshots(spark):
    a, b = spark.range(5).withColumn("x", F.lit("y")), spark.range(6).withColumn("x", F.lit("y"))
    assert snapshot.inventory({"a": a.repartition(1)}).first() == snapshot.inventory({"a": a.repartition(7)}).first()
    assert snapshot.differences(snapshot.inventory({"a": a, "b": b}), snapshot.inventory({"a": b, "c": a})).orderBy("table").collect() == [("a", "changed"), ("b", "missing"), ("c", "unexpected")]
    metrics = spark.createDataFrame([("a", 5)], "table string, rows long")
    assert snapshot.identity(snapshot.manifest({"a": a}, metrics)) == snapshot.identity(snapshot.manifest({"a": a.repartition(3)}, metrics))
    with pytest.raises(snapshot.SnapshotError, match="a is changed"):
        snapshot.manifest({"a": b}, metrics)
    rules = lambda *r: spark.createDataFrame(list(r), "table string, rule string")
    live, new = snapshot.inventory({"a": a, "old": b}), snapshot.inventory({"a": a, "n": b})
    for r in ([], [("old", "burn")], [("old", "retire"), ("n", "retire")], [("old", "retire"), ("ghost", "retire")]):
        with pytest.raises(snapshot.SnapshotError):
            snapshot.checked_disposition(snapshot.disposition(new, live, rules(*r)))
    assert {tuple(r) for r in snapshot.checked_disposition(snapshot.disposition(new, live, rules(("old", "rebuild")))).collect()} == {("a", "keep"), ("n", "add"), ("old", "rebuild")}
    runs = snapshot.run_metrics(spark, [{"run": "x", "rows_written": 10, "seconds": 2.0}, {"run": "y", "error": ValueError("secret")}]).orderBy("run").collect()
    assert runs[0]["rows_per_second"] == 5.0 and runs[1]["status"] == "failed" and runs[1]["error"] == "ValueError" and "secret" not in str(runs)


def test_first_rows_don_t_depend_on_partitions(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("k"), "id")
    assert len({tuple(sorted((r["k"], r["id"]) for r in A.first_per(d, ["k"], [F.desc("id")]).collect())) for d in (df.repartition(1), df.repartition(7))}) == 1
    assert A.first_n_per(df, ["k"], [F.col("id")], 3).count() == 21


def test_extracts(spark):
    df = spark.createDataFrame([("s", [("a", ["y", "x"])])], "id string, credits array<struct<person:string,roles:array<string>>>")
    shaped = df.withColumn("credits", F.transform("credits", lambda c: F.struct(F.struct(c["person"].alias("name")).alias("person"), c["roles"].alias("roles"))))
    assert extract.credit_rows(shaped).collect() == [("s", "x|y", "a")]
    assert {tuple(r) for r in extract.field_counts(df).collect()} == {("id", 1), ("credits", 1)}


def test_incremental_ingest(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    Path(source).mkdir()
    line = "g\t1\tK1\t99.5\t1\t2\t3\t4\t1e-5\t50\t7\n"
    (Path(source) / "a.tsv").write_text(line * 3 + "bad\n")
    run = lambda c=checkpoint: I.ingest(spark, source, R.blast, root, c).awaitTermination(120)
    held = lambda table="rows": TableLog(spark, root).read(table).count()
    assert run() and held() == 3 and held("rejects") == 1
    (Path(source) / "b.tsv").write_text(line)
    assert run() and held() == 4
    assert run() and held() == 4
    assert run(checkpoint + "2") and held() == 4  # a lost checkpoint adds nothing twice


def test_reports_with_tables(spark):
    rule, text = "=" * 12, "note\n\n"
    first_part = f"General Quality Info\n\n{rule}\nCoding density\tGenes per 1M bp\n------------\n91.5%\tmany\n\n"
    closed = text + first_part + f"{rule}\nPredicted Genes Statistics\n{rule}\nFeature type\tNumber of predicted features\n'CDS'\t3\n'CDS'\t4\n'rRNA'\t?\n"
    files = spark.createDataFrame([("a", closed), ("b", first_part), ("c", "no results"), ("d", ""), ("e", None), ("f", f"{rule}\n{first_part}")], "file string, value string")
    got = {r["file"]: (r["coding_density_pct"], r["genes_per_1m_bp"], r["n_cds"], r["n_rrna"], r["n_trna"]) for r in R.statistics(files).collect()}
    assert got == {"a": (91.5, None, 7, None, None), "b": (91.5, None, None, None, None), "f": (91.5, None, None, None, None)}
    assert len(R.STATISTICS) == 17


def test_manifests_from_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,url,file_size_bytes,was_generated_by\n1,"https://h/a,b.tsv",5,r\n2,https://h/c.tsv,,r\n3,https://h/d.tsv,x,\n')
    manifest = R.read_manifest(spark, str(tmp_path / "m.csv"))
    assert [r["id"] for r in R.nonempty(manifest).collect()] == ["1"] and manifest.where("id = '3'").first()["was_generated_by"] is None
    landed = spark.createDataFrame([("/a,b.tsv", 7), ("/z.tsv", 8)], "file string, n int")
    assert [tuple(r) for r in R.tagged(landed, R.bind_manifest(landed, manifest)).select("workflow_run_id", "data_object_id", "n").collect()] == [("r", "1", 7)]


def test_canonical_digests(spark):
    digest = lambda df: df.select(S.row_digest(df, *df.columns)).first()[0]
    one = spark.sql("SELECT named_struct('b', 1, 'a', array(named_struct('z', 1, 'y', 'q'))) AS s, map('k', 1D, 'a', 2D) AS m, CAST('NaN' AS DOUBLE) AS x")
    two = spark.sql("SELECT CAST('NaN' AS DOUBLE) AS x, map('a', 2D, 'k', 1D) AS m, named_struct('a', array(named_struct('y', 'q', 'z', 1)), 'b', 1) AS s")
    assert digest(one) == digest(two)
    assert len({digest(spark.sql(f"SELECT {v} AS x")) for v in ("CAST('NaN' AS DOUBLE)", "'NaN'", "CAST('Infinity' AS DOUBLE)", "CAST(NULL AS DOUBLE)", "1D")}) == 5


def test_json_of_lists_sorts_keys_at_every_depth(spark):
    df = spark.sql("SELECT array(named_struct('b', named_struct('z', 1, 'y', 2), 'a', 3)) AS l")
    assert flatten.flatten_struct(df).first()["l"] == '[{"a":3,"b":{"y":2,"z":1}}]'


def test_measured_runs(spark, tmp_path):
    ran = snapshot.measured("r", spark.range(10), lambda d: d.where("id > 3"), str(tmp_path / "r"))
    assert (ran["rows_read"], ran["rows_written"]) == (10, 6) and ran["bytes"] > 0 and ran["seconds"] > 0
    again = snapshot.measured("r", spark.range(10), lambda d: d, str(tmp_path / "r"))
    assert again["error"] and spark.read.parquet(str(tmp_path / "r")).count() == 6
    total = snapshot.run_totals(snapshot.run_metrics(spark, [ran, again])).first()
    assert (total["runs"], total["failed"], total["rows_written"]) == (2, 1, 6)
    metrics = lambda n: spark.createDataFrame([("t", 6, n)], "`table` string, rows long, bytes long")
    assert snapshot.stored_manifest(spark, {"t": str(tmp_path / "r")}, metrics(ran["bytes"]), {"t": ["b", "a"]}).first()["made_from"] == ["a", "b"]
    with pytest.raises(snapshot.SnapshotError, match="t is changed"):
        snapshot.stored_manifest(spark, {"t": str(tmp_path / "r")}, metrics(1))


def test_dry_runs_and_formats(spark):
    rows = frame(spark, {"id": "r", "studies": ["a", "b"]}, {"id": "s"})
    assert flatten.dry_run(flatten.flatten_all({"record_set": rows}, SCHEMA)) == {"record_set": 2, "record_set_chem": 0, "record_set_studies": 2}
    spark.sql("CREATE DATABASE IF NOT EXISTS formats_db")
    W.save_managed(spark.range(1), "formats_db.one", "overwrite", properties={"a": "it's b"})
    assert [tuple(r) for r in snapshot.catalog_formats(spark, "formats_db", "parquet").collect()] == [("one", "parquet")] and W.properties_of(spark, "formats_db.one")["a"] == "it's b"
    with pytest.raises(snapshot.SnapshotError, match="not delta: one"):
        snapshot.catalog_formats(spark, "formats_db", "delta")
    spark.sql("DROP DATABASE formats_db CASCADE")


def brute_walk(links, seeds, end, depth=15):
    after: dict[str, set[str]] = {}
    for a, b in links:
        after.setdefault(a, set()).add(b)
    found = {}
    for seed in seeds:
        front = {seed}
        for hop in range(1, depth + 1):
            front = {b for a in front for b in after.get(a, ())} - {n for s, n in found if s == seed}
            if not front:
                break
            found |= {(seed, n): (hop, end(n)) for n in front}
            front = {n for n in front if not end(n)}
    return {(s, n, *x) for (s, n), x in found.items()}


def test_packed_walk(spark):
    """Many origins that meet, cycles, a hot node, origins that are nodes of others' ways, and depths."""
    r = random.Random(4)
    nodes = [f"n{i}" for i in range(60)] + ["end1", "end2"]
    seeds = [f"s{i:03}" for i in range(300)] + ["n3", "end1"]
    links = [(s, r.choice(nodes)) for s in seeds for _ in range(r.randrange(3))] + [(s, "n0") for s in seeds[:200]] + [(a, r.choice(nodes)) for a in nodes for _ in range(2)] + [("n5", "n5")]
    df = spark.createDataFrame([(a, b, "s") for a, b in links] * 2, "src string, next_id string, slot string")
    origins = spark.createDataFrame([(s,) for s in [*seeds, seeds[0], None]], "origin string")
    end = F.col("id").startswith("end")
    before = len(spark.catalog.listTables())
    for depth in (15, 1, 3):
        found = graph.reach(df, origins, end, depth, buckets=3)
        assert {tuple(x) for x in found.rows().collect()} == brute_walk(links, seeds, lambda n: n.startswith("end"), depth)
        assert depth < 15 or found.packed.count() < found.rows().count() / 4
    types = spark.createDataFrame([("n0", "A"), ("n1", "B"), ("n2", "B"), ("end1", "C")], "id string, type string")
    flags, kinds = {"A": "a", "B": "b", "C": "c"}, spark.createDataFrame([("s000", "W")], "origin string, origin_type string")
    full = graph.reach(df, origins, end)
    assert {tuple(x) for x in graph.bridge(full, types, kinds, flags).collect()} == {tuple(x) for x in graph.bridge(full.rows(), types, kinds, flags).collect()}
    assert graph.reach(df, origins.limit(0), end).rows().count() == 0 and graph.reach(df.limit(0), origins, end).rows().count() == 0
    assert len(spark.catalog.listTables()) == before


def test_recursive_walk_of_more_rows_than_spark_lets_a_recursion_have(spark, monkeypatch):
    """Origins that share nodes, repeated and null origins, a terminal as an origin, cycles, depths; no table or view stays."""
    r = random.Random(5)
    nodes = [f"n{i}" for i in range(40)]
    seeds = [f"s{i:03}" for i in range(300)] + ["n3", "end1"]
    links = [(s, r.choice([*nodes, "end1"])) for s in seeds for _ in range(r.randrange(1, 4))] + [(n, r.choice([*nodes, "end1", "end2"])) for n in [*nodes, *nodes[:8]]] + [("n5", "n5"), ("n7", "end3")]
    df = spark.createDataFrame([(a, b, "s") for a, b in links] * 2, "src string, next_id string, slot string")
    origins = spark.createDataFrame([(s,) for s in [*seeds, seeds[0], None]], "origin string")
    before = len(spark.catalog.listTables())
    monkeypatch.setattr(graph, "BUCKET", 100)
    spark.conf.set("spark.sql.cteRecursionRowLimit", 50)
    try:
        for depth in (15, 1, 3, 0):
            want = sorted((s, n, hops) for s, n, hops, over in brute_walk(links, seeds, lambda n: n.startswith("end"), depth) if over)
            assert sorted(tuple(x) for x in graph.walk_recursive(spark, df, origins, F.col("id").startswith("end"), depth).collect()) == want
            assert depth == 0 or want
        for few in ((df.limit(0), origins), (df, origins.limit(0))):
            assert graph.walk_recursive(spark, *few, F.col("id").startswith("end")).count() == 0
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    assert len(spark.catalog.listTables()) == before


def test_a_hop_shuffles_neither_edges_nor_what_was_reached(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, df, keys in (("hop_links", spark.createDataFrame([("a", "b")], "src string, next_id string"), ("src",)), ("hop_seen", spark.createDataFrame([("b", 0, 1)], "id string, block long, bits long"), ("id", "block"))):
            graph._bucketed(df, name, str(tmp_path / name), 4, *keys)
        frontier = spark.createDataFrame([("a", 0, 3)], "id string, block long, bits long")
        step = graph._step(frontier, spark.table("hop_links"), spark.table("hop_seen"), F.lit(False))
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Bucketed: true") == 2
        assert [tuple(x) for x in step.collect()] == [("b", 0, 2, False)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        for name in ("hop_links", "hop_seen"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_json_of_many_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "d": "2020-01-01", "n": 1, "o": {"x": 1}, "m": 1, "it\'s": true}\n\n')
    (tmp_path / "b.json").write_text('{"id": 2, "n": 1.5, "o": {"x": 2.5, "y": ["p"]}, "m": {"k": [1]}, "v": null, "l": [1, 2]}\n')
    got = R.read_json_union(spark, str(tmp_path))
    assert dict(got.dtypes) == {"d": "string", "id": "bigint", "it's": "boolean", "l": "array<bigint>", "m": "string", "n": "double", "o": "struct<x:double,y:array<string>>", "v": "string"}
    one, two = got.orderBy("id").collect()
    assert (one["d"], one["n"], one["o"]["x"], one["m"], one["it's"]) == ("2020-01-01", 1.0, 1.0, "1", True)
    assert (two["d"], two["n"], two["o"]["y"], two["m"], two["v"], two["l"]) == (None, 1.5, ["p"], '{"k":[1]}', None, [1, 2])
    for i in range(40):
        (tmp_path / f"many{i}.json").write_text(f'{{"id": {i + 3}, "only{i}": {i}}}\n')
    more = R.read_json_union(spark, *[str(p) for p in tmp_path.iterdir()])
    assert more.count() == 42 and len(more.columns) == 48
    assert more._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    with pytest.raises(Exception):  # noqa: B017
        (tmp_path / "bad.json").write_text("no")
        R.read_json_union(spark, str(tmp_path))
