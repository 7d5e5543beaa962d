"""Readers. Each parser is a function of a DataFrame of lines, so that it serves batch reads, tests and streams alike.

Line frames have `file` and `value`; parsers keep `file`, give typed columns, and route what they can't parse to a reject frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import attribute_list, attribute_of, blank_to_null, decoded, is_placeholder, not_in_domain, percent, to_number, unquoted, url_path

#: Columns of the fixed formats, in file order. Fixed values.
BLAST = "gene_id string, ncbi_taxid long, annotation_id string, pct_identity double, q_start long, q_end long, s_start long, s_end long, evalue double, bitscore double, aln_len long"
KRAKEN = "pct_clade double, clade_reads long, direct_reads long, rank string, taxid long, name string"
CHECKM = "bin_id string, marker_lineage string, n_genomes long, n_markers long, n_marker_sets long, n_0 long, n_1 long, n_2 long, n_3 long, n_4 long, n_5_plus long, completeness double, contamination double, strain_heterogeneity double"
#: The statistics report of annotations: column -> (section, row's label or None for its first row, column of the section), type. Fixed values.
STATISTICS: dict[str, tuple[str, str | None, str, str]] = {
    "n_seqs": ("Processed Sequences Statistics", "final_fasta", "Number of seqs", "long"),
    "n_bps": ("Processed Sequences Statistics", "final_fasta", "Number of bps", "long"),
    "len_shortest_seq": ("Processed Sequences Statistics", "final_fasta", "Length shortest seq", "long"),
    "len_longest_seq": ("Processed Sequences Statistics", "final_fasta", "Length longest seq", "long"),
    "avg_seq_length": ("Processed Sequences Statistics", "final_fasta", "Average length", "double"),
    "median_seq_length": ("Processed Sequences Statistics", "final_fasta", "Median length", "double"),
    "stddev_seq_length": ("Processed Sequences Statistics", "final_fasta", "Standard deviation", "double"),
    "n_seqs_with_genes": ("Processed Sequences Statistics", "sequences_with_genes", "Number of seqs", "long"),
    "n_seqs_without_genes": ("Processed Sequences Statistics", "sequences_without_genes", "Number of seqs", "long"),
    "n_cds": ("Predicted Genes Statistics", "CDS", "Number of predicted features", "long"),
    "n_trna": ("Predicted Genes Statistics", "tRNA", "Number of predicted features", "long"),
    "n_ncrna": ("Predicted Genes Statistics", "ncRNA", "Number of predicted features", "long"),
    "n_rrna": ("Predicted Genes Statistics", "rRNA", "Number of predicted features", "long"),
    "n_crispr": ("Predicted Genes Statistics", "CRISPR", "Number of predicted features", "long"),
    "coding_density_pct": ("General Quality Info", None, "Coding density", "double"),
    "genes_per_1m_bp": ("General Quality Info", None, "Genes per 1M bp", "double"),
    "seqs_per_1m_bp": ("General Quality Info", None, "Seqs per 1M bp", "double"),
}
#: How a file that holds no results begins. Fixed values.
PLACEHOLDERS = (
    "No Checkm Results for", "Nothing found in gottcha2 for", "No Archaeal Results for", "No Bacterial Results for", "Nothing found in kraken2 for", "No Kraken Results for", "Nothing found in centrifuge for",
    "No Centrifuge Results for", "Nothing found in annotation for", "No Annotation Results for",
)
TERMS = "pfam_id string, clan_id string, clan_name string, name string, description string"


def read_collection(spark: SparkSession, path: str, file_format: str = "parquet", schema: T.StructType | str | None = None, **equal) -> DataFrame:
    """A collection dump (parquet, json, ...) without `_id`, with equality filters that reach the scan."""
    reader = spark.read.format(file_format)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    for column, value in equal.items():
        df = df.where(F.col(column) == value)
    return df.drop("_id")


def read_flat(spark: SparkSession, path: str, struct: T.StructType) -> DataFrame:
    """An already flat JSON collection, read straight into its target columns: missing keys are null, others are dropped."""
    return spark.read.schema(struct).json(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as text, for operators.flatten.records."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def read_json_union(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON lines of differing fields, united by name; dates stay text.

    One pass finds what any line has, a second reads it, however many files and shapes there are. Fractions are doubles; a field that has values of several kinds is text, with objects
    as JSON. Blank lines are skipped; a line that isn't JSON fails the job."""
    lines = spark.read.text(list(paths)).where(F.trim("value") != "").select(F.parse_json("value").alias("record"))
    found = lines.agg(F.schema_of_variant_agg("record").alias("schema")).first()["schema"]
    shape = T._parse_datatype_string(found.replace("OBJECT<", "STRUCT<")) if found != "VOID" else T.StructType()
    if not isinstance(shape, T.StructType):
        raise ValueError(f"lines aren't objects: {found}")
    if odd := [f.name for f in shape if "'" in f.name and '"' in f.name]:
        raise ValueError(f"a field's name has both kinds of quotes: {odd[0]}")
    path = lambda name: f'$["{name}"]' if "'" in name else f"$['{name}']"
    return lines.select(*[F.variant_get("record", path(f.name), _readable(f.dataType)).alias(f.name) for f in shape])


def _readable(kind: T.DataType) -> str:
    """The type to read a variant as."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_readable(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_readable(kind.elementType)}>"
    return "double" if isinstance(kind, T.DecimalType) else "string" if isinstance(kind, (T.VariantType, T.NullType)) else kind.simpleString()


def file_of() -> Column:
    """The path of a row's file as it is named: blanks, `%` and `#` aren't encoded."""
    return decoded(F.col("_metadata.file_path"))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(file_of().alias("file"), "value")


def placed(lines: DataFrame) -> DataFrame:
    """Lines (file, start: where a line's block begins in its file, value) with their order within a block."""
    return lines.withColumn("at", F.monotonically_increasing_id())


def read_headered(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """A tab-separated file with a header."""
    reader = spark.read.option("sep", "\t").option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def _fields(value: Column) -> Column:
    """Fields between tabs; a tab within double quotes doesn't count, and such quotes go."""
    bare = lambda x: F.when(x.rlike('^".*"$'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
    return F.when(value.contains('"'), F.transform(F.split(value, r'\t(?=(?:[^"]*"[^"]*")*[^"]*$)'), bare)).otherwise(F.split(value, "\t"))


def headered(lines: DataFrame, renames: dict[str, str] | None = None, keep: tuple[str, ...] = ("file",)) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of tab-separated files whose first line names the columns: rows have keep and `fields`, a map from column to text (null where empty), so that files
    may have other columns each. Rejects are lines with more fields than names. lines: as placed() gives them, with `file`.

    A column is renamed where its file has none of the new name. One (file, header) table is joined to the lines, so the plan doesn't grow with files or headers. Names that a
    header has twice get their place as a suffix. Blank lines are skipped; a file without a first line, or with nothing else, has no rows."""
    filled = lines.where(F.trim("value") != "")
    first = filled.where("start = 0").groupBy("file").agg(F.min_by(F.struct("value", "at"), "at").alias("first"))
    once = F.transform("names", lambda n, i: F.when(F.array_position("names", n) <= i, F.concat(n, F.lit("."), i.cast("string"))).otherwise(n))
    heads = first.select("file", F.col("first.at").alias("head_at"), _fields(F.col("first.value")).alias("names")).withColumn("names", once)
    for old, new in (renames or {}).items():
        heads = heads.withColumn("names", _renamed_in(F.col("names"), old, new))
    body = filled.join(heads, "file").where((F.col("start") != 0) | (F.col("at") != F.col("head_at"))).withColumn("parts", _fields(F.col("value")))
    fits = F.size("parts") <= F.size("names")
    fields = F.map_from_arrays("names", F.transform("names", lambda _, i: F.nullif(F.get("parts", i), F.lit(""))))
    return body.where(fits).select(*keep, fields.alias("fields")), body.where(~fits).select(*keep, "value")


def _renamed_in(names: Column, old: str, new: str) -> Column:
    return F.when(F.array_contains(names, new), names).otherwise(F.transform(names, lambda n: F.when(n == old, F.lit(new)).otherwise(n)))


def columns_of(rows: DataFrame, fields: str = "fields") -> DataFrame:
    """rows with a text column for each key that `fields` has anywhere, in name order, in its place."""
    keys = rows.select(F.explode(F.map_keys(fields)).alias("k")).distinct().collect()
    others = [c for c in rows.columns if c != fields]
    return rows.select(*others, *[F.col(fields)[k].alias(k) for k in sorted(r["k"] for r in keys)])


def read_drifting(spark: SparkSession, paths: list[str], renames: dict[str, str]) -> DataFrame:
    """Headered files whose column names drift, as one table of text columns: a column is renamed where its new name isn't there already."""
    lines = spark.read.text(paths).select(file_of().alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    return columns_of(headered(placed(lines), renames)[0].drop("file"))


def without_placeholders(lines: DataFrame, phrases: tuple[str, ...] = PLACEHOLDERS) -> DataFrame:
    """Lines but for those of files that only say, in one line, that nothing was found. Only files with such a line are counted."""
    said = F.lit(False)
    for phrase in phrases:
        said = said | F.ltrim("value").startswith(phrase)
    filled = lines.where(F.trim("value") != "")
    empty = filled.join(filled.where(said).select("file").distinct(), "file", "left_semi").groupBy("file").agg(F.count("*").alias("lines")).where("lines = 1").select("file")
    return lines.join(empty, "file", "left_anti")


def renamed(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns and new not in df.columns})


def _typed(parts: Column, ddl: str) -> list[Column]:
    fields = T._parse_datatype_string(ddl).fields
    text = lambda i: F.get(parts, F.lit(i))
    return [(text(i) if f.dataType == T.StringType() else F.trim(text(i)).try_cast(f.dataType)).alias(f.name) for i, f in enumerate(fields)]


def delimited(lines: DataFrame, ddl: str, keep: tuple[str, ...] = ("file",)) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of headerless tab-separated lines; lines of another number of fields are rejects. Blank lines are skipped."""
    n = len(T._parse_datatype_string(ddl).fields)
    parts = lines.where(F.trim("value") != "").withColumn("parts", F.split("value", "\t"))
    return parts.where(F.size("parts") == n).select(*keep, *_typed(F.col("parts"), ddl)), parts.where(F.size("parts") != n).select(*keep, "value")


def blast(lines: DataFrame, keep: tuple[str, ...] = ("file",)) -> tuple[DataFrame, DataFrame]:
    return delimited(lines, BLAST, keep)


def kraken(lines: DataFrame, keep: tuple[str, ...] = ("file",)) -> tuple[DataFrame, DataFrame]:
    return delimited(lines, KRAKEN, keep)


def gff(lines: DataFrame, keep: tuple[str, ...] = ("file",)) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of nine-column GFF lines: comments skipped, four attributes taken from the last column."""
    parts = lines.where((F.trim("value") != "") & ~F.col("value").startswith("#")).withColumn("p", F.split("value", "\t"))
    text = lambda i: F.get("p", F.lit(i))
    rows = parts.where(F.size("p") == 9).withColumn("listed", attribute_list(text(8))).select(
        *keep,
        text(0).alias("gene_id"),
        text(2).alias("accession"),
        text(3).try_cast("long").alias("start"),
        text(4).try_cast("long").alias("end"),
        text(5).try_cast("double").alias("score"),
        attribute_of("listed", "e-value").try_cast("double").alias("e_value"),
        attribute_of("listed", "alignment_length").try_cast("long").alias("alignment_length"),
        attribute_of("listed", "model_start").try_cast("long").alias("model_start"),
        attribute_of("listed", "model_end").try_cast("long").alias("model_end"),
    )
    return rows, parts.where(F.size("p") != 9).select(*keep, "value")


def aligned(lines: DataFrame, ddl: str = CHECKM, header: str = "Bin Id", keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """Rows of a table aligned with blanks: fields are two blanks or more apart; rules, the header and lines of another number of fields go."""
    n = len(T._parse_datatype_string(ddl).fields)
    body = lines.withColumn("text", F.trim("value")).where((F.col("text") != "") & ~F.col("text").startswith("---") & ~F.col("text").startswith(header))
    parts = body.withColumn("p", F.split("text", r"\s{2,}")).where(F.size("p") == n)
    return parts.select(*keep, *_typed(F.col("p"), ddl))


def sections(files: DataFrame, keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """keep, title, line, text of reports (value: a whole file) whose sections have a title over a line of `=`."""
    parts = files.select(*keep, F.explode(F.split("value", r"(?:^|\n)(?=[^\n]+\n={3,})")).alias("part")).where(F.col("part").rlike(r"^[^\n]+\n={3,}"))
    rows = parts.select(*keep, F.trim(F.substring_index("part", "\n", 1)).alias("title"), F.posexplode(F.split("part", "\n")).alias("line", "text"))
    return rows.where((F.col("line") >= 2) & (F.trim("text") != "")).select(*keep, "title", "line", F.trim("text").alias("text"))


def metrics_row(section_rows: DataFrame, wanted: dict[str, tuple[str, str]], keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """One row per file: column -> (section title, label of the line); a line is `label: value` or a tab-separated pair.

    Percent signs and quotes are dropped. Lines with equal labels add up."""
    pair = F.split("text", r"\s*[:\t]\s*", 2)
    rows = section_rows.withColumn("label", unquoted(F.get(pair, F.lit(0)))).withColumn("number", percent(unquoted(F.get(pair, F.lit(1)))))
    return rows.groupBy(*keep).agg(*[F.sum(F.when((F.col("title") == t) & (F.col("label") == label), F.col("number"))).alias(c) for c, (t, label) in wanted.items()])


def section_tables(files: DataFrame, keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """keep, title, header, place, fields: rows of tab-separated tables in reports (value: a whole file).

    A section is a title, a rule of `=`, a header, rows, and a rule that closes it (or the end); rules of `-` and blank lines don't count. Text
    between two rules is a title where no section is open, else the section's table."""
    title = lambda part: F.nullif(F.trim(F.regexp_extract(part, r"([^\n]*\S[^\n]*)\s*$", 1)), F.lit(""))
    state = "struct<title:string,found:array<struct<title:string,body:string>>>"
    step = lambda s, part: F.struct(
        F.when(s["title"].isNull(), title(part)).alias("title"),
        F.when(s["title"].isNull(), s["found"]).otherwise(F.concat(s["found"], F.array(F.struct(s["title"].alias("title"), part.alias("body"))))).alias("found"),
    ).cast(state)
    start = F.struct(F.lit(None).cast("string").alias("title"), F.array().alias("found")).cast(state)
    found = files.select(*keep, F.explode(F.aggregate(F.split("value", r"(?m)^[ \t]*={10,}.*$"), start, step)["found"]).alias("s"))
    lines = F.filter(F.split("s.body", "\r?\n"), lambda x: (F.trim(x) != "") & ~x.rlike(r"^\s*-{10,}"))
    tables = found.select(*keep, F.col("s.title").alias("title"), lines.alias("lines")).where(F.size("lines") > 1)
    rows = tables.select(*keep, "title", F.split(F.get("lines", F.lit(0)), "\t").alias("header"), F.posexplode(F.slice("lines", F.lit(2), F.size("lines"))).alias("place", "text"))
    return rows.select(*keep, "title", "header", "place", F.split("text", "\t").alias("fields"))


def statistics(files: DataFrame, wanted: dict[str, tuple[str, str | None, str, str]] = STATISTICS, keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """One row for each report that has one of the wanted sections; values of rows with equal labels add up, what isn't a number is null."""
    rows = section_tables(files, keep).where(F.col("title").isin(sorted({w[0] for w in wanted.values()}))).withColumn("label", unquoted(F.get("fields", F.lit(0))))
    columns = []
    for name, (title, label, column, kind) in wanted.items():
        here = (F.col("title") == title) & ((F.col("place") == 0) if label is None else (F.col("label") == label))
        at = F.array_position("header", column).cast("int")
        columns.append(F.sum(F.when(here & (at > 0), percent(F.get("fields", at - 1)))).cast(kind).alias(name))
    return rows.groupBy(*keep).agg(*columns)


def strict_terms(lines: DataFrame, ddl: str = TERMS) -> DataFrame:
    """A reference table that must parse: a line of another number of fields fails the job; blanks are null, blank lines skipped."""
    fields = T._parse_datatype_string(ddl).fields
    parts = lines.where(F.trim("value") != "").withColumn("p", F.split("value", "\t"))
    right = F.size("p") == len(fields)
    guarded = F.when(right, F.col("p")).otherwise(F.raise_error(F.concat(F.lit("fields expected: "), F.lit(str(len(fields))), F.lit(", found: "), F.size("p").cast("string"))).cast("array<string>"))
    return parts.select(guarded.alias("p")).select(*[blank_to_null(F.get("p", F.lit(i))).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest of files as CSV with a header; everything is text, blanks are null."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.select(*[blank_to_null(f"`{c}`").alias(c) for c in df.columns])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table, rows. Parquet answers from its footers, without reading columns."""
    return reduce(lambda a, b: a.unionByName(b), [d.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, d in tables.items()])


def bind_manifest(files: DataFrame, manifest: DataFrame, root: str = "") -> DataFrame:
    """manifest with `file` of the landed file whose path is the url's, and `hit`. files: file. Urls with `..` in the path never bind.

    manifest: id, url, data_object_type, was_generated_by, ..."""
    path = decoded(url_path("url"))
    safe = F.when(~path.rlike(r"(^|/)\.\.(/|$)"), F.concat(F.lit(root), path))
    landed = files.select("file").distinct()
    return manifest.withColumn("wanted_file", safe).join(landed, F.col("wanted_file") == F.col("file"), "left").withColumn("hit", F.col("file").isNotNull()).drop("wanted_file")


def tagged(rows: DataFrame, bound: DataFrame) -> DataFrame:
    """rows (with `file`) and the run and data object that each file belongs to."""
    return rows.join(bound.where("hit").select("file", F.col("was_generated_by").alias("workflow_run_id"), F.col("id").alias("data_object_id")), "file").drop("file")


def nonempty(manifest: DataFrame, size: str = "file_size_bytes") -> DataFrame:
    """Files of a positive size; sizes that aren't numbers count as 0."""
    return manifest.where(F.coalesce(to_number(size, "long"), F.lit(0)) > 0)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


@dataclass(frozen=True)
class FileFormat:
    """How files of a type become (rows, rejects). parse: frames with file, start (of the block) and value, which is a line, or the whole text if `whole`."""

    parse: Callable[[DataFrame], tuple[DataFrame, DataFrame]]
    whole: bool = False


def _report(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports with statistics; those that have text, say no placeholder, and yet no section that is known, are rejects."""
    real = files.where(~is_placeholder("value", PLACEHOLDERS))
    rows = statistics(real)
    return rows, real.join(rows.select("file"), "file", "left_anti").select("file", F.substring("value", 1, 200).alias("value"))


def _table(renames: dict[str, str] | None = None) -> FileFormat:
    return FileFormat(lambda d: headered(placed(without_placeholders(d)), renames))


#: Type of a file, as manifests name it -> its format. The names are fixed values.
FORMATS: dict[str, FileFormat] = {
    "GOTTCHA2 Classification Report": _table(),
    "Kraken2 Classification Report": FileFormat(lambda d: kraken(without_placeholders(d))),
    "Centrifuge output report file": _table(),
    "GTDBTK Bacterial Summary": _table({"user_genome": "name"}),
    "GTDBTK Archaeal Summary": _table({"user_genome": "name"}),
    "CheckM Statistics": FileFormat(lambda d: (aligned(d), d.where(F.lit(False)).select("file", "value"))),
    "Annotation Statistics": FileFormat(_report, whole=True),
    "Annotation KEGG Orthology": FileFormat(blast),
    "Annotation Enzyme Commission": FileFormat(blast),
    "Pfam Annotation GFF": FileFormat(gff),
}


def format_of(kind: str) -> FileFormat:
    """The format of a file type; an unknown one is an error that names up to three like it."""
    if kind in FORMATS:
        return FORMATS[kind]
    raise ValueError(not_in_domain(kind, sorted(FORMATS), "file types"))
