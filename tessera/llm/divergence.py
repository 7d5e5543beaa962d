"""How the sources of a language differ in their terms, by a K-squared quadtree over the group-term count matrix.

A group is a (lang, source); its row of the matrix has its count of each term that the language keeps (in LEAST_DOCUMENTS of its documents at least). A cell's share is
p = 1 + floor(10^9 (count + 1) / (N + V)), with N the group's counts and V the terms kept. A group differs from another, with shares p and q, by the sum
of floor((p - q)^2 / q) over all V terms. All arithmetic is on whole numbers (decimals where counts are multiplied).

1. Counts are summed in each task's batches, then by (lang, source, term): only cells that aren't zero exist from here on.
2. The matrix is cut into blocks of ROWS sources and about COLUMNS terms (by a term's hash), one for each pair of row blocks, which Spark deals out. A block orders its
   columns by the sources that have them, so that zeros lie together, and builds a tree of quadrants over its cells, K = 2 a side.
3. Pairs of groups go down the tree together: a step takes a pair of quadrants over the same columns to their children. A pair of quadrants that
   are both all zero ends there. Single columns of two groups are priced by their shares, a zero's share being the row's constant.
4. What ended early is priced at once: its columns (V without those visited) times the divergence of the two constants. Blocks give sums, which Spark adds for each pair.

A block has ROWS^2 / 2 * COLUMNS leaf pairs at most, so that memory is bounded; a term in all documents has one row for each source after summing.

Null text, lang and source are ''. Documents without terms, and groups of only such ones, count as groups. Repeated rows count as documents of their own. Ties are settled by the item's bytes. Long texts
are counted whole, in parts that end between terms. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import table, tidy, written

LEAST_DOCUMENTS = 3
UNIT = 1_000_000_000
#: Terms of a group that are listed.
TOP = 200
#: Sources (a power of two) and terms of a block.
ROWS, COLUMNS = 32, 2048
#: Different terms that a task counts before it hands them on.
HELD = 1 << 18
#: Bytes of a text that are split at once.
PART = 1 << 24
_FOLD = bytes(x if x >= 128 or 97 <= x <= 122 else x + 32 if 65 <= x <= 90 else 32 for x in range(256))


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, lower-cased, in parts."""
    if len(raw) <= PART:
        yield raw.translate(_FOLD).split()
        return
    rest = b""
    for at in range(0, len(raw), PART):
        part = rest + raw[at : at + PART].translate(_FOLD)
        end = part.rfind(b" ") + 1 if at + PART < len(raw) else len(part)
        rest = part[end:]
        yield part[:end].split()


def cells(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), documents (that have it): what isn't zero in the matrix."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                rows = [pa.array([x] * len(n), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())], names=["lang", "source", "term", "n", "documents"])
            groups.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*map(batch.column, ("lang", "source", "text")), strict=True):
                n, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                before, own = len(n), set()
                for part in terms_of(text.as_buffer().to_pybytes()):
                    n.update(part)
                    own.update(part)
                docs.update(own)
                held += len(n) - before
                if held > HELD:
                    yield from out()
                    held = 0
        yield from out()

    filled = documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    each = filled.mapInArrow(counted, "lang string, source string, term string, n long, documents long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(n: str, total: str, terms: str) -> Column:
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + (CAST({n} + 1 AS DECIMAL(38, 0)) * {UNIT}) div ({total} + {terms}) END")


def difference(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _pyramid(cells: np.ndarray, rows: int) -> list[np.ndarray]:
    """cells, and what quadrants of 2, 4, .. `rows` places a side have any."""
    levels = [cells]
    while 1 << (len(levels) - 1) < rows:
        x = np.pad(levels[-1], [(0, k % 2) for k in levels[-1].shape])
        levels.append(x[::2, ::2] | x[1::2, ::2] | x[::2, 1::2] | x[1::2, 1::2])
    return levels


def traversed(first: np.ndarray, shares: np.ndarray, row: np.ndarray, column: np.ndarray, p: np.ndarray, across: bool, rows: int = ROWS) -> tuple[np.ndarray, ...]:
    """(a, b, value, columns): what pairs of rows differ by in the columns that were visited, both ways round.

    first: the share of a zero for each row (0: no such row); row, column, p: the cells that aren't zero. across: only pairs of one of the first `rows` rows with one of the others."""
    filled = np.zeros((len(first), int(column.max(initial=-1)) + 1), dtype=bool)
    filled[row, column] = True
    order = np.lexsort(filled[::-1])
    shares = np.repeat(first[:, None], filled.shape[1], axis=1)
    shares[row, column] = p
    filled, shares = filled[:, order], shares[:, order]
    levels, there = _pyramid(filled, rows), _pyramid((first > 0)[:, None], rows)
    top = len(levels) - 1
    c = np.arange(levels[top].shape[1])
    a, b = np.zeros_like(c), np.full_like(c, int(across))
    for level in range(top, -1, -1):
        if level < top:
            # the children of each pair of quadrants
            a, b, c = (np.repeat(x * 2, 8) + np.tile([k >> s & 1 for k in range(8)], len(x)) for s, x in ((2, a), (1, b), (0, c)))
        some = levels[level]
        inside = (a < some.shape[0]) & (b < some.shape[0]) & (c < some.shape[1]) & (across | (a <= b))
        a, b, c = a[inside], b[inside], c[inside]
        wanted = (some[a, c] | some[b, c]) & there[level][a, 0] & there[level][b, 0]
        a, b, c = a[wanted], b[wanted], c[wanted]
    a, b, c = (x[a != b] for x in (a, b, c))
    size, pair = len(first), a * len(first) + b
    apart = np.square(shares[a, c] - shares[b, c])
    sums = np.zeros((2, size * size), dtype=np.int64)
    np.add.at(sums[0], pair, apart // shares[b, c])
    np.add.at(sums[1], pair, apart // shares[a, c])
    visited = np.bincount(pair, minlength=size * size)
    pairs = np.flatnonzero(visited)
    a, b = pairs // size, pairs % size
    return np.append(a, b), np.append(b, a), np.append(sums[0][pairs], sums[1][pairs]), np.tile(visited[pairs], 2)


def _block(block: pa.Table, rows: int) -> pa.Table:
    """Sums for pairs of sources of one block. Rows without a term give the sources and their shares of a zero."""
    block = block.combine_chunks()
    number, term, p = (block.column(c).combine_chunks() for c in ("number", "term", "p"))
    low, high = block.column("low")[0].as_py(), block.column("high")[0].as_py()
    number, p = number.to_numpy(), p.to_numpy()
    row = number % rows + np.where((number // rows == high) & (high > low), rows, 0)
    head = term.is_null().to_numpy(zero_copy_only=False)
    first = np.zeros(int(row.max()) + 1, dtype=np.int64)
    first[row[head]] = p[head]
    codes = term.filter(pa.array(~head)).dictionary_encode().indices.to_numpy()
    a, b, value, columns = traversed(first, p, row[~head], codes.astype(np.int64), p[~head], high > low, rows)
    # back to the sources' numbers
    back = lambda r: np.where(r < rows, low * rows + r, high * rows + r - rows)
    lang = pa.array([block.column("lang")[0].as_py()] * len(a), pa.string())
    return pa.Table.from_arrays([lang, pa.array(back(a)), pa.array(back(b)), pa.array(value), pa.array(columns.astype(np.int64))], names=["lang", "a", "b", "value", "columns"])


def _blocks(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value, columns: sums over the visited columns of all blocks."""
    # all pairs of a row's block with a block of rows
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.expr("(sources - 1) div " + str(ROWS))), lambda k: F.struct(F.least(k, F.expr(f"number div {ROWS}")).alias("low"), F.greatest(k, F.expr(f"number div {ROWS}")).alias("high"))))
    parts = f"cast((terms + {COLUMNS - 1}) div {COLUMNS} as int)"
    members = groups.where("terms > 0").select("lang", "source", "number", "sources", "terms", "total", share("0", "total", "terms").alias("zero"))
    heads = members.select("lang", "number", "sources", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"), F.explode(F.expr(f"sequence(0, {parts} - 1)")).alias("part"))
    body = kept.join(members, ["lang", "source"]).select("lang", "number", "sources", "term", share("n", "total", "terms").alias("p"), F.expr(f"cast(pmod(xxhash64(term), {parts}) as int)").alias("part"))
    dealt = heads.unionByName(body).select("lang", "number", "term", "p", "part", pairs.alias("pair")).select("lang", "number", "term", "p", "part", "pair.*")
    rows = ROWS
    each = dealt.groupBy("lang", "part", "low", "high").applyInArrow(lambda block: _block(block, rows), "lang string, a long, b long, value long, columns long")
    return each.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("columns").alias("columns"))


def kept_cells(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells of the terms that a language keeps, with lang_n: the term's count in the language; all groups: lang, source, number of the source in its language, sources,
    total, terms, lang_total)."""
    of_term = Window.partitionBy("lang", "term")
    every = cells(documents).withColumns({"in_all": F.sum("documents").over(of_term), "lang_n": F.sum("n").over(of_term), "first": (F.row_number().over(of_term.orderBy("source")) == 1).cast("long")})
    kept = written(every.where(F.col("in_all") >= LEAST_DOCUMENTS).select("lang", "source", "term", "n", "lang_n", "first"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("first").alias("first"))
    named = documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    # one row for each group from here on
    of_lang = Window.partitionBy("lang")
    groups = named.join(sizes, ["lang", "source"], "left").select(
        "lang", "source", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("number"), F.count("*").over(of_lang).alias("sources"),
        F.coalesce("n", F.lit(0)).alias("total"), F.coalesce(F.sum("first").over(of_lang), F.lit(0)).alias("terms"), F.coalesce(F.sum("n").over(of_lang), F.lit(0)).alias("lang_total"),
    )
    return kept, written(groups)


def divergences(documents: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: how a source differs from each other of its language (`pair`), and its TOP terms that are more
    common in it than in the language (`term`)."""
    tidy(documents.sparkSession)
    kept, groups = kept_cells(documents)
    ends = groups.select("lang", "source", "number", "terms", share("0", "total", "terms").alias("zero"))
    a, b = ends.alias("a"), ends.select("lang", F.col("source").alias("item"), F.col("number").alias("other"), F.col("zero").alias("other_zero")).alias("b")
    both = a.join(b, "lang").where("number != other")
    sums = _blocks(kept, groups).withColumnsRenamed({"a": "number", "b": "other"})
    rest = difference("zero", "other_zero") * (F.col("terms") - F.coalesce("columns", F.lit(0)))
    pair = both.join(sums, ["lang", "number", "other"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.when(F.col("terms") > 0, F.coalesce("value", F.lit(0)) + rest).otherwise(0).alias("value"))
    priced = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"))
    term = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pair, term)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= TOP))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents").select("text", "lang", "source"))
