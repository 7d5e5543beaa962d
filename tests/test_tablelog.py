"""The table log: one step for several tables, batches and promotions that break off between any two moves, writers that meet, upkeep."""

import gzip
import json
import random
from difflib import get_close_matches
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import flatten
from tessera.sinks.collections import publish, publish_all, publish_types
from tessera.sinks.tablelog import Conflict, TableLog
from tessera.sinks.tables import PromotionError
from tessera.sources import readers as R
from tessera.streaming import ingest as I
from tests.test_operators import SCHEMA, frame

MOVES = ("stage 1", "stage 2", "stage 3", "draft", "place", "placed")


class Broken(RuntimeError):
    pass


def breaking(log: TableLog, at: str) -> TableLog:
    """log, which breaks off before or after one of its moves."""
    stage, place, staged = log.stage, log._placed, []

    def broken_stage(df, name):
        staged.append(name)
        if at == f"stage {len(staged)}":
            # some files are in place, the job isn't done
            df.limit(1).write.parquet(f"{log.root}/data/{name}/half")
            raise Broken(at)
        return stage(df, name)

    def broken_place(draft, version):
        if at == "draft":
            raise Broken(at)
        if at == "place":
            log._fs.delete(log._path(draft), False)
            raise Broken(at)
        place(draft, version)
        if at == "placed":
            raise Broken(at)

    log.stage, log._placed = broken_stage, broken_place
    return log


def rows(spark, *files):
    return spark.createDataFrame([(f, n) for f in files for n in range(4)], "file string, n int").repartition(3)


def held(log, table="rows"):
    return sorted((r["file"] or "", r["n"]) for r in log.read(table).collect())


@pytest.mark.parametrize("at", MOVES)
def test_a_batch_that_breaks_off_adds_nothing_or_all(spark, tmp_path, at):
    log = TableLog(spark, str(tmp_path / "t"))
    log.append_new({"rows": rows(spark, "f1"), "bad": rows(spark, "f9").limit(0)}, "file")
    batch = {"rows": rows(spark, "f1", "f2"), "bad": rows(spark, "f3")}
    with pytest.raises(Broken):
        breaking(TableLog(spark, log.root), at).append_new(batch, "file")
    whole = [(f, n) for f in ("f1", "f2") for n in range(4)]
    assert (held(log), len(held(log, "bad"))) == ((whole, 4) if at == "placed" else (whole[:4], 0))
    log.append_new(batch, "file")
    log.append_new(batch, "file")
    assert held(log) == whole and len(held(log, "bad")) == 4
    assert {t: x.rows for t, x in log.snapshot().tables.items()} == {"rows": 8, "bad": 4, "_keys_rows": 3}


@pytest.mark.parametrize("at", MOVES[:1] + MOVES[3:])
def test_promotion_is_one_step(spark, tmp_path, at):
    log = TableLog(spark, str(tmp_path / "t"))
    first, second = rows(spark, "a"), rows(spark, "b", "c")
    log.promote({"p": first, "p_s": first, "p_t": first}, "p", ("p_s", "p_t"))
    before = log.snapshot()
    with pytest.raises(Broken):
        breaking(TableLog(spark, log.root), at).promote({"p": second, "p_s": second}, "p", ("p_s", "p_t"))
    now = log.snapshot()
    assert {n: t.rows for n, t in now.tables.items()} == ({"p": 8, "p_s": 8} if at == "placed" else {"p": 4, "p_s": 4, "p_t": 4})
    assert len(held(log, "p")) == now.tables["p"].rows
    log.promote({"p": second, "p_s": second}, "p", ("p_s", "p_t"))
    # a reader that began before goes on with the old set
    assert log.read("p_t", before).count() == 4 and sorted(log.snapshot().tables) == ["p", "p_s"] and len(held(log, "p_s")) == 8


def test_promotion_checks_its_set_and_says_what_stays(spark, tmp_path):
    log, one = TableLog(spark, str(tmp_path / "t")), rows(spark, "a")
    for tables, message in (({"q": one}, "no table p"), ({"p": one, "x": one}, "unexpected tables")):
        with pytest.raises(PromotionError, match=message):
            log.promote(tables, "p", ("p_s",))
    failing = one.withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):  # noqa: B017
        log.promote({"p": one, "p_s": failing}, "p", ("p_s",))
    assert log.versions() == [] and not list(Path(log.root, "data", "p").iterdir())

    class Stuck:
        def __getattr__(self, name):
            return getattr(fs, name)

        def delete(self, *_):
            raise OSError("stuck")

    fs, log._fs = log._fs, Stuck()
    with pytest.raises(Exception) as raised:  # noqa: B017
        log.promote({"p": one, "p_s": failing}, "p", ("p_s",))
    assert any("stays at" in n for n in raised.value.__notes__) and list(Path(log.root, "data", "p").iterdir())


def test_writers_that_meet(spark, tmp_path):
    log, other = (TableLog(spark, str(tmp_path / "t")) for _ in range(2))
    base = log.snapshot()
    other.append("x", rows(spark, "a"))
    with pytest.raises(Conflict):
        log.commit(base.with_part("y", log.stage(rows(spark, "b"), "y")))
    # the same key from two writers: the slower one looks again
    make, met = log.commit, []

    def slow(changed):
        if not met:
            met.append(other.append_new({"rows": rows(spark, "f", "g")}, "file"))
        return make(changed)

    log.commit = slow
    log.append_new({"rows": rows(spark, "f", "h")}, "file")
    assert held(log) == [(f, n) for f in "fgh" for n in range(4)] and log.versions() == [0, 1, 2]


def test_streams_batches_nulls_and_schemas(spark, tmp_path):
    log = TableLog(spark, str(tmp_path / "t"))
    for batch in (0, 0, 1):
        log.append_new({"rows": rows(spark, None)}, "file", "s", batch)
    assert log.snapshot().streams == {"s": 1} and len(held(log)) == 8
    log.append_new({"rows": rows(spark, "a").limit(0)}, "file", "s", 2)
    assert len(held(log)) == 8
    with pytest.raises(PromotionError, match="other columns"):
        log.append("rows", rows(spark, "a").withColumnRenamed("n", "m"))
    with pytest.raises(KeyError):
        log.read("absent")
    commented = spark.createDataFrame([(1,)], "a int").select(F.col("a").alias("a", metadata={"comment": "said"}))
    log.append("c", commented)
    assert log.read("c").schema["a"].metadata == {"comment": "said"}


def test_upkeep(spark, tmp_path):
    log = TableLog(spark, str(tmp_path / "t"))
    for f in "abcd":
        log.append("rows", rows(spark, f))
    before = log.snapshot()
    log.compact("rows")
    assert len(log.snapshot().tables["rows"].parts) == 1 and len(held(log)) == 16
    rows(spark, "z").write.parquet(f"{log.root}/data/rows/half")
    assert log.vacuum(seconds=3600) == [] and log.versions() == [4]
    assert sorted(log.vacuum(seconds=-60)) == sorted([*before.tables["rows"].parts, "data/rows/half"])
    assert len(held(log)) == 16
    assert json.loads(Path(log._entry(4)).read_text())["tables"]["rows"]["rows"] == 16


# files of all kinds, one log

HEADS = ("LEVEL\tNAME\tTAXID", "name\ttaxID\tabundance", "user_genome\tclassification", "name\tuser_genome")
REPORT = f"Predicted Genes Statistics\n{'=' * 12}\nFeature type\tNumber of predicted features\n'CDS'\t7\n"
CHECKM = "---\n  Bin Id   Marker lineage   a   b   c\n---\n  bin.1   k__B (UID1)   1   2   3   4   5   6   7   8   9   90.5   1.25   0.0\n"


def landed(folder: Path) -> dict[str, Path]:
    files = {
        "GOTTCHA2 Classification Report": {"a b%c#.tsv": f"{HEADS[0]}\ngenus\tX\t2759_pt\n\ngenus\t\t5\n", "none.tsv": "Nothing found in gottcha2 for x\n", "empty.tsv": "", "over.tsv": f"{HEADS[0]}\n1\t2\t3\t4\n"},
        "Kraken2 Classification Report": {"k.tsv": "1.5\t3\t2\tS\t9\t  x\nbad\n", "none.tsv": "\nNothing found in kraken2 for y\n"},
        "Centrifuge output report file": {"c+d.tsv": f'{HEADS[1]}\n"x ""y"""\t5\t0.5\n"a\tb"\t6\n'},
        "GTDBTK Bacterial Summary": {"old.tsv": f"{HEADS[2]}\nb1\td__B\n", "new.tsv": f"{HEADS[3]}\nb2\tu2\n", "none.tsv": "No Bacterial Results for z"},
        "GTDBTK Archaeal Summary": {"twice.tsv": "user_genome\tq\tq\nb3\t1\t2\n"},
        "CheckM Statistics": {"m.tsv": CHECKM, "none.tsv": "No Checkm Results for nmdc:x\n"},
        "Annotation Statistics": {"r.tsv": REPORT, "none.tsv": "No Annotation Results for x", "odd.tsv": "some\nother text"},
    }
    folders = {}
    for kind, named in files.items():
        folders[kind] = folder / S.safe_name(kind)
        folders[kind].mkdir(parents=True)
        for name, text in named.items():
            (folders[kind] / name).write_text(text)
    return folders


def test_seven_types_by_name(spark, tmp_path):
    folders, log = landed(tmp_path / "in"), TableLog(spark, str(tmp_path / "log"))
    for _ in range(2):
        for query in I.ingest_types(spark, {k: str(f) for k, f in folders.items()}, log.root, str(tmp_path / "check"), S.safe_name).values():
            assert query.awaitTermination(120)
    of = lambda t, *c: sorted(map(tuple, log.read(t).select(F.substring_index("file", "/", -1), *c).collect()), key=str)
    assert of("gottcha2_classification_report", "fields.NAME", "fields.TAXID") == [("a b%c#.tsv", "X", "2759_pt"), ("a b%c#.tsv", None, "5")]
    assert of("gottcha2_classification_report_rejects", "value") == [("over.tsv", "1\t2\t3\t4")]
    assert of("kraken2_classification_report", "taxid", "name") == [("k.tsv", 9, "  x")]
    assert of("kraken2_classification_report_rejects", "value") == [("k.tsv", "bad")]
    assert [r["fields"] for r in log.read("centrifuge_output_report_file").orderBy("fields.taxID").collect()] == [{"name": 'x "y"', "taxID": "5", "abundance": "0.5"}, {"name": "a\tb", "taxID": "6", "abundance": None}]
    assert of("gtdbtk_bacterial_summary", "fields.name", "fields.user_genome") == [("new.tsv", "b2", "u2"), ("old.tsv", "b1", None)]
    assert [r["fields"] for r in log.read("gtdbtk_archaeal_summary").collect()] == [{"name": "b3", "q": "1", "q.2": "2"}]
    assert of("checkm_statistics", "bin_id", "completeness") == [("m.tsv", "bin.1", 90.5)]
    assert of("annotation_statistics", "n_cds") == [("r.tsv", 7)]
    assert of("annotation_statistics_rejects", "value") == [("odd.tsv", "some\nother text")]


def test_unknown_type_names_those_like_it():
    with pytest.raises(ValueError, match="Did you mean: CheckM Statistics"):
        R.format_of("Checkm Statistic")
    with pytest.raises(ValueError, match="file types.$"):
        R.format_of("xxxxxxxxxxxxxx")


def test_drifting_headers_of_awkward_names(spark, tmp_path):
    for name, text in (("a b.tsv", "user_genome\tx\n1\t2\n"), ("c%20d.tsv", "name\ty\n3\t4\n"), ("e#f+g.tsv", 'name\tx\n"5\t6"\t\n'), ("none.tsv", ""), ("head.tsv", "name\tz\n")):
        (tmp_path / name).write_text(text)
    got = R.read_drifting(spark, [str(tmp_path)], {"user_genome": "name"})
    assert got.columns == ["name", "x", "y"]
    assert {tuple(r) for r in got.collect()} == {("1", "2", None), ("3", None, "4"), ("5\t6", None, None)}
    files = R.read_lines(spark, str(tmp_path)).select("file").distinct()
    manifest = spark.createDataFrame([("1", f"https://h{tmp_path}/a%20b.tsv"), ("2", f"https://h{tmp_path}/c%2520d.tsv"), ("3", f"https://h{tmp_path}/no.tsv")], "id string, url string")
    assert {r["id"]: r["hit"] for r in R.bind_manifest(files, manifest, "file:").collect()} == {"1": True, "2": True, "3": False}


def test_many_headers_make_no_larger_plan(spark, tmp_path):
    plans = []
    for n in (3, 30):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"f{i}.tsv").write_text(f"name\tcolumn{i}\n{i}\tv\n")
        lines = spark.read.text(str(folder)).select(R.file_of().alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
        plans.append(R.headered(R.placed(lines))[0]._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        assert R.read_drifting(spark, [str(folder)], {}).count() == n
    assert plans[0] == plans[1]


# likeness


def test_suggestions_agree_with_difflib(spark):
    r = random.Random(3)
    parts = ["Taxonomic", "Kraken2", "Classification", "Report", "Annotation", "GFF", "é", "Pfam", "x", "abab", "ba"]
    domain = sorted({" ".join(r.sample(parts, r.randrange(1, 4))) for _ in range(60)} | {"abcd", "bcde", "a" * 250, "ab" * 120, "𝄞x"})
    asked = sorted({"".join(r.sample(x, len(x)) if r.random() < 0.2 else (x[k:] + x[:k])) for x in domain for k in (r.randrange(len(x)), 1)} | {" ".join(reversed(x.split())) for x in domain} | {"bcdx", "", "ab" * 130, "a" * 201, "x𝄞"})
    got: dict[str, list] = {}
    for row in S.suggestions(spark.createDataFrame([(a,) for a in asked] * 2 + [(None,)], "v string"), spark.createDataFrame([(d,) for d in domain] + [(None,)], "v string"), "v").orderBy("value", "place").collect():
        got.setdefault(row["value"], []).append(row["suggestion"])
    want = {a: m for a in asked if (m := get_close_matches(a, domain, 3, 0.6))}
    assert got == want and len(want) > 60


def test_strict_terms_of_a_compressed_file(spark, tmp_path):
    with gzip.open(tmp_path / "terms.tsv.gz", "wt") as out:
        out.write("PF1\tCL1\tclan\tname\ttext\n\nPF2\t \t\tother\tmore\n")
    assert [tuple(r) for r in R.strict_terms(R.read_lines(spark, str(tmp_path))).orderBy("pfam_id").collect()] == [("PF1", "CL1", "clan", "name", "text"), ("PF2", None, None, "other", "more")]


# many tables from one pass


def same(a, b):
    assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    text = lambda d: sorted(map(str, d.collect()))
    assert text(a) == text(b)


def nested(spark):
    rows = [
        {"id": "1", "type": "x:Extraction", "targets": ["t"], "inputs": ["a", {"id": "b"}, None, "a"]}, {"id": "2", "type": "Pooling", "method": "m", "inputs": ["no"]}, {"type": "Extraction", "inputs": ["noid"]}, {"id": "", "inputs": ["e"]}, {"id": "3", "type": "Extraction", "inputs": {"id": "lone"}},
    ]
    records = [
        {"id": "r1", "chem": [{"has_raw_value": "x", "type": "n:Value", "aliases": ["q"], "term": {"id": "t", "name": "T"}}, "text", None, {"term": "only"}], "studies": ["s1", "s2"], "scores": [1]}, {"id": "r2", "chem": {"has_raw_value": "lone"}, "depth": 2}, {"id": "r3"},
    ]
    return frame(spark, *rows), frame(spark, *records, "no json")


def test_one_pass_gives_the_tables_that_one_scan_for_each_gives(spark, tmp_path):
    process, record = nested(spark)
    log = TableLog(spark, str(tmp_path / "log"))
    results = {r["collection"]: r for r in publish_all(log, {"record_set": record, "process_set": process}, SCHEMA)}
    assert results["record_set"]["rows"] == {"record_set": 4, "record_set_chem": 3, "record_set_studies": 2} and results["process_set"]["rows"] == {"process_set": 5, "process_set_inputs": 4}
    for name, df, cls in (("record_set", record, "Record"), ("process_set", process, "Process")):
        same(log.read(name), flatten.primary(df, SCHEMA, cls))
        for table, side in flatten.side_tables(df, SCHEMA, cls, name).items():
            same(log.read(table), side)
    # rows that are gone take their side table along, in the same step
    assert publish(log, record.limit(0), SCHEMA, "Record", "record_set") == {"record_set": 0}
    assert log.read("record_set").count() == 0 and log.read("record_set").columns == flatten.primary(record, SCHEMA, "Record").columns and "record_set_chem" not in log.snapshot().tables
    bad = frame(spark, {"id": "r", "depth": "deep"})
    before = log.snapshot()
    (failed, skipped) = publish_all(log, {"record_set": bad}, SCHEMA, skip=("process_set",))
    assert (failed["status"], skipped["status"]) == ("failed", "skipped") and failed["error"] and log.snapshot() == before


def test_one_pass_is_one_scan(spark, tmp_path):
    """A collection with three side tables is read once; the stored rows have each column once."""
    folder = str(tmp_path / "in")
    spark.createDataFrame([('{"id": "r1", "chem": [{"has_raw_value": "x"}], "studies": ["s1"]}',)], "raw string").write.text(folder)
    records = flatten.records(R.read_raw(spark, folder))
    plan = flatten.tagged_rows(records, SCHEMA, "Record", "record_set")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
    names = flatten.stored_names(flatten.table_shapes(SCHEMA, "Record", "record_set"))
    assert names["record_set"]["studies"] == "studies" and names["record_set_studies"]["studies"] == "studies__2"


def test_types_in_one_pass(spark, tmp_path):
    df, log = spark.createDataFrame([("A b", 1), ("A b", 2), ("c/d", 3), ("other", 4), (None, 5)], "kind string, n int"), TableLog(spark, str(tmp_path / "log"))
    log.append("kept", df)
    assert publish_types(log, df, "kind", ["A b", "c/d", "none"]) == {"a_b": 2, "c_d": 1}
    assert sorted(r["n"] for r in log.read("a_b").collect()) == [1, 2] and log.read("a_b").columns == ["n"]
    assert publish_types(log, df.where("kind = 'c/d'"), "kind", ["A b", "c/d"]) == {"c_d": 1} and sorted(log.snapshot().tables) == ["c_d", "kept"]
    log.append("c_d", spark.createDataFrame([(9,)], "n int"))
    assert sorted(r["n"] for r in log.read("c_d").collect()) == [3, 9]
    with pytest.raises(ValueError, match="same table name"):
        publish_types(log, df, "kind", ["A b", "A  b"])
