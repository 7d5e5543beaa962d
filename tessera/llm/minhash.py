"""MinHash near-deduplication with bottom-k sketches of one hash function.

1. Each document's distinct shingles are hashed; the k smallest hashes are its sketch. Documents with equal
   sets are one class, and only classes go on, so exact copies cost one row each.
2. Inverted lists of retained values generate overlaps. Two sets over the threshold share at least c(n) retained values, so values
   are put in one global order, rarest first, and each class enters the lists of its first |sketch| - c(n) + 1 values only: two
   such sets still meet in at least one list, and frequent word pairs or passages hardly ever enter one.
3. A list isn't expanded into all pairs. Every member meets the list's hub (the member with fewest values of its own, as the
   original of copies is); pairs whose union-sketch estimate is too low go, the rest is measured exactly on full sets. Links join components,
   and only members of different components go on. A list of at most FEW members gives its remaining pairs: a bounded number for each member.
4. Members of larger lists (a passage, a group of near copies) enter finer lists, of all their shingles, rarest among them first:
   a set that is at least `percent` similar to another meets it in the first n - ceil(n * percent / 100) + 1, with no doubt left, and the places of a shared
   shingle in both bound what they share. What copies have of their own thus keeps them out of the lists of what all have. Lists are parted by
   size, and an entry goes at once if what it has from its place on can't suffice for the smallest set of its list. What is left meets hubs first, one of them and then TURNS - 1
   others; then each other, if still in different components. Before that, a list with far more pairs than its members have places for the next shared
   shingle is parted by that shingle, which both of a pair must have soon after the first, and so on, up to DEPTH shingles: texts that only share much
   without being similar are told apart by rows that grow with them, not with their pairs.
5. Components of verified links, joined up after each step: only links between components are kept.

Losslessness: with n shingles in the smaller set, at most n/4 of the union are outside the intersection, so for sets that the
sketches hold whole, or up to n/4 < k, the bound c(n) is certain. Beyond, the number of shared values among the union's k
smallest is binomial with mean 0.8 k or more; for k = 96 it is under 52 with a probability below 1e-8, and so is the estimate.

Nulls: a null text is empty; a document without words has 0 shingles and is linked with nothing. A null doc_id stays null
and is no component's id unless all are null. Repeated rows and ids are members of one class or another like any document; ties between shingles
of one frequency go by their hashes. Long texts are hashed whole, in parts that end at blanks; a set is one row. Empty tables give empty
results. Extra columns don't matter, as only id and text are read. Tables of the steps between are deleted when the classes are known.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import scratch, table, tidy, written
from tessera.llm.components import merged
from tessera.llm.shingles import digest, shingle_set, word_hashes

K = 96
#: Fewest values that sketches of similar sets share, if these are far larger than a sketch.
LEAST = 52
PERCENT = 80
#: A list of so many members is expanded into pairs at once: half as many rows a member at most.
FEW = 32
#: Hubs that members of larger lists meet before they meet each other.
TURNS = 3
#: A list is parted if its members have, together, so many times fewer places for a next shared shingle than its members' square.
GAIN = 8
#: Most shingles that one list is for.
DEPTH = 4
#: Bits of a bitmap of ids for each id, bits of one of its rows (as Spark's bitmap_construct_agg makes them), and most rows (8 MB in all).
BITS, ROW, ROWS = 16, 32768, 2048


def sketches(documents: DataFrame, width: int, k: int = K) -> DataFrame:
    """doc_id, n (shingles), h1, h2 (128 bits that name the set), sketch (its k smallest hashes, ascending)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, names, lists = [], [], []
            for words in word_hashes(batch.column("text")):
                found = shingle_set(words, width)
                counts.append(len(found))
                names.append(digest(found))
                lists.append(found[:k].copy())  # not a view, which would hold the whole set
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array([x for x, _ in names], pa.int64()), pa.array([y for _, y in names], pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                names=["doc_id", "n", "h1", "h2", "sketch"],
            )

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(rows, "doc_id long, n long, h1 long, h2 long, sketch array<long>")


def texts_for(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, text of the documents whose id is a representative of wanted (a written table), and of few others: what a bitmap of hashed ids lets
    through, before any text is shuffled. If there are more ids than the largest bitmap tells apart, more others come along."""
    rows = min(ROWS, max(1, -(-wanted.count() * BITS // ROW)))
    at = lambda name: F.pmod(F.xxhash64(name), F.lit(rows * ROW))
    place = lambda name: [F.floor(at(name) / ROW).alias("row"), (at(name) % ROW).alias("place")]
    bitmap = wanted.select(*place("rep")).groupBy("row").agg(F.bitmap_construct_agg("place").alias("bits"))
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text").select("id", "text", *place("id"))
    byte = F.conv(F.hex(F.substring("bits", (F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return texts.join(F.broadcast(bitmap), "row").where(F.getbit(byte, F.col("place").cast("int") % 8) == 1).select("id", "text")


def full_sets(documents: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """cid, shingles (ascending) of each class of wanted (a written table), from its representative's text. Where ids repeat, the text must give
    the class's set; of repeated rows one is kept."""
    texts = texts_for(documents, wanted)
    chosen = texts.join(wanted, texts["id"].eqNullSafe(wanted["rep"])).select("cid", "h1", "h2", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for words, cid, h1, h2 in zip(word_hashes(batch.column("text")), *(batch.column(c).to_pylist() for c in ("cid", "h1", "h2")), strict=True):
                if digest(shingles := shingle_set(words, width)) == (h1, h2):
                    ids.append(cid)
                    found.append(shingles)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["cid", "shingles"])

    return chosen.mapInArrow(rows, "cid long, shingles array<long>").dropDuplicates(["cid"])


def sets_of(documents: DataFrame, classes: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The full sets of the classes that pairs need."""
    members = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = written(classes.join(members, "cid", "left_semi").select("rep", "cid", "h1", "h2"))
    return written(full_sets(documents, wanted, width))


def shared_at_least(n: Column, percent: int, k: int, least: int) -> Column:
    """c(n): retained values that a set of n shingles shares with every set that is similar enough."""
    outside = F.floor(n * (100 - percent) / percent)
    return F.when(n * 100 <= k * percent, F.ceil(n * percent / 100)).otherwise(F.greatest(F.lit(least), F.least(F.ceil(n * percent / 100), k - outside))).cast("int")


def _entries(ranked: DataFrame) -> DataFrame:
    """value, cid, n, own, at, left, least, whole from cid, n, held (values), least, ranked (values that others have too, rarest first): an entry for
    each of the first held - least + 1 values, counting those that nobody else has first. at: the value's place in ranked; left: values from this one on."""
    alone = F.col("held") - F.size("ranked")
    take = F.greatest(F.lit(0), F.col("held") - F.col("least") + 1 - alone)
    placed = ranked.select("cid", "n", "held", "least", alone.alias("alone"), F.posexplode(F.slice("ranked", F.lit(1), take.cast("int"))).alias("at", "r"))
    left = F.col("held") - F.col("alone") - F.col("at")
    return placed.select(F.col("r.value").alias("value"), "cid", "n", (F.col("alone") / F.col("held")).alias("own"), "at", left.alias("left"), "least", (F.col("held") == F.col("n")).alias("whole"))


def _ranked(sets: DataFrame) -> DataFrame:
    """cid, n, held, least, ranked from sets (cid, n, held, least, values): those of values that two or more have, rarest first. Values are shuffled
    with their cid alone, and by cid as they are: Spark's partial lists have fewer values each, and more bytes in all, the more partitions there are."""
    each = sets.select("cid", F.explode("values").alias("value"))
    common = each.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    gathered = each.join(common, "value").select("cid", "df", "value").repartition("cid").groupBy("cid")
    return gathered.agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("ranked")).join(sets.drop("values"), "cid")


def inverted_lists(classes: DataFrame, percent: int = PERCENT, k: int = K, least: int = LEAST) -> DataFrame:
    """value, cid, n, own (share of retained values that no other class has), left, least, whole: each class in the lists of its rarest
    retained values."""
    c = shared_at_least(F.col("n"), percent, k, least)
    return _entries(_ranked(classes.select("cid", "n", F.size("sketch").alias("held"), c.alias("least"), F.col("sketch").alias("values")))).drop("at")


def _ranked_sets(sets: DataFrame, percent: int) -> DataFrame:
    n = F.size("shingles").cast("long")
    least = F.ceil(n * percent / 100).cast("int")
    return _ranked(sets.select("cid", n.alias("n"), F.size("shingles").alias("held"), least.alias("least"), F.col("shingles").alias("values")))


def fine_lists(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The same for full sets (cid, shingles): lists of the rarest shingles, certain to bring similar sets together. A list is for a shingle and a
    band of sizes; core: sets of that band's sizes, where the others
    are of the next. Similar sets are of one band or of two neighbours, and meet in the list of the lower."""
    entries = _entries(_ranked_sets(sets, percent))
    # a little wider than the largest ratio of similar sizes, so that rounding can't part them by two
    ratio = max(math.log(100 / percent), 0.001) * (1 + 1e-9)
    band = F.floor(F.log("n") / ratio)
    each = entries.withColumn("core", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("band", F.when(F.col("core"), band).otherwise(band - 1))
    return each.withColumn("value", F.xxhash64("value", "band")).drop("band")


def narrowed(lists: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Fine lists with label, need (what an entry must share with any set of its list), members, fewest (least need of the list) and places (for a next
    shared shingle, of all members): without entries that have too little from their place on, and lists of which all have one label."""
    smallest = lists.groupBy("value").agg(F.min("n").alias("smallest"))
    nearest = F.greatest("smallest", F.ceil(F.col("n") * percent / 100))
    need = F.ceil((F.col("n") + nearest) * percent / (100 + percent)).cast("int")
    enough = lists.drop("label", "need", "members", "fewest", "places").join(smallest, "value").withColumn("need", need).drop("smallest").where("left >= need")
    tagged = enough.join(labels, F.col("cid") == F.col("node")).drop("node")
    kept = tagged.groupBy("value").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max("core").alias("cored"), F.count("*").alias("members"), F.min("need").alias("fewest"), F.sum(F.col("left") - F.col("need") + 1).alias("places")
    )
    return tagged.join(kept.where("low < high and cored").select("value", "members", "fewest", "places"), "value")


def extended(lists: DataFrame, ranked: DataFrame, depth: int) -> DataFrame:
    """Lists for `depth` + 1 shingles from lists (parent; square: its pairs) for `depth`: an entry for each of the next left - need + 1
    shingles, as the next one that a similar set shares is among them. left counts the shingles shared so far, too."""
    after = F.slice("ranked", F.col("at") + 2, F.col("left") - F.col("need") + 1)
    each = lists.join(ranked.select("cid", "ranked"), "cid").select(*lists.columns, F.posexplode(after).alias("skipped", "next"))
    changed = {"value": F.xxhash64("value", "next.value", F.lit(depth)), "at": F.col("at") + 1 + F.col("skipped"), "left": F.col("left") - F.col("skipped")}
    own = [changed.get(c, F.col(c)).alias(c) for c in lists.columns if c not in ("parent", "square")]
    return each.select(*own, F.col("value").alias("parent"), (F.col("members") * F.col("members")).alias("square"))


def no_better(lists: DataFrame) -> DataFrame:
    """parent of extended lists that have together no fewer than half as many pairs as it has itself."""
    each = lists.groupBy("value").agg(F.first("parent").alias("parent"), F.first("square").alias("square"), (F.count("*") * F.count("*")).alias("pairs"))
    return each.groupBy("parent").agg(F.sum("pairs").alias("pairs"), F.max("square").alias("square")).where("pairs * 2 >= square").select("parent")


def _may_link(percent: int) -> Column:
    """Whether entries l and r of a list may be of similar sets, by sizes and by the values from these places on."""
    n, m, left = F.col("l.n"), F.col("r.n"), F.least("l.left", "r.left")
    sizes = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    enough = (left >= F.greatest("l.least", "r.least")) & (~(F.col("l.whole") & F.col("r.whole")) | (left * (100 + percent) >= (n + m) * percent))
    return sizes & enough


def open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """lists with label and members (of the list), without lists all of whose members have one label."""
    tagged = lists.join(labels, F.col("cid") == F.col("node")).drop("node")
    several = tagged.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members")).where("low < high")
    return tagged.join(several.select("value", "members"), "value")


def stars(lists: DataFrame, percent: int, turns: Sequence[int] = (0,)) -> DataFrame:
    """a, b: every member of a list with the list's hub of each turn, if their labels differ; as many rows as members at most, for each turn. The hub
    of turn 0 is the member with fewest values of its own, as the original of copies is; in later turns, one that a hash picks."""
    entry = F.struct("cid", "n", "left", "least", "whole", "label")
    first = lambda turn: F.struct("own", "cid") if not turn else F.struct(F.xxhash64("cid", F.lit(turn)).alias("own"), "cid")
    hubs = lists.groupBy("value").agg(F.array(*[F.min_by(entry, first(turn)) for turn in turns]).alias("hubs"))
    met = lists.select("value", entry.alias("l")).join(hubs, "value").select("l", F.explode("hubs").alias("r"))
    return _pairs(met.where((F.col("l.label") != F.col("r.label")) & _may_link(percent)))


def all_pairs(lists: DataFrame, percent: int, core: Column | None = None) -> DataFrame:
    """a, b: pairs of members of a list whose labels differ, at least one of them `core`."""
    entry = F.struct("cid", "n", "left", "least", "whole", "label", (F.lit(True) if core is None else core).alias("core"))
    met = lists.where(F.lit(True) if core is None else core).select("value", entry.alias("l")).join(lists.select("value", entry.alias("r")), "value")
    once = ~F.col("r.core") | (F.col("l.cid") < F.col("r.cid"))
    return _pairs(met.where(once & (F.col("l.label") != F.col("r.label")) & _may_link(percent)))


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("l.cid", "r.cid").alias("a"), F.greatest("l.cid", "r.cid").alias("b")).distinct()


def estimated(pairs: DataFrame, classes: DataFrame, percent: int, k: int, least: int) -> DataFrame:
    """The pairs whose union sketch (the k smallest values of both) allows the similarity."""
    side = lambda name: classes.select(F.col("cid").alias(name), F.col("sketch").alias(f"s{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), F.col("union")))
    whole = F.size("union") < k
    return both.withColumn("union", union).where(F.when(whole, shared * 100 >= F.size("union") * percent).otherwise(shared >= least)).select("a", "b")


def measured(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs whose exact Jaccard similarity on full sets is at least `percent` hundredths."""
    side = lambda name: sets.select(F.col("cid").alias(name), F.col("shingles").alias(f"s{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = both.select("a", "b", (F.size("sa") + F.size("sb")).alias("total"), F.size(F.array_intersect("sa", "sb")).alias("shared"))
    return sized.where(F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * percent).select("a", "b")


def joined(labels: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """labels after the links among pairs (a written table)."""
    return labels if pairs.isEmpty() else merged(labels, measured(pairs, sets, percent))


def linked_classes(documents: DataFrame, classes: DataFrame, width: int, percent: int, k: int, least: int) -> DataFrame:
    """node, label: every class with the smallest class that verified links lead to."""
    likely = lambda pairs, known: written(estimated(pairs, known, percent, k, least))

    def linked(labels: DataFrame, pairs_of: Callable[[], DataFrame]) -> DataFrame:
        """labels after the links among pairs; their full sets go at once."""
        with scratch(documents.sparkSession) as kept:
            pairs = pairs_of()
            return labels if pairs.isEmpty() else merged(labels, measured(pairs, sets_of(documents, classes, pairs, width), percent), kept)

    labels = classes.select(F.col("cid").alias("node"), F.col("cid").alias("label"))
    lists = written(inverted_lists(classes, percent, k, least))
    labels = linked(labels, lambda: likely(stars(lists.withColumn("label", F.col("cid")), percent), classes))
    still = written(open_lists(lists, labels))
    small = still.where(F.col("members") <= FEW)
    labels = linked(labels, lambda: likely(all_pairs(small, percent), classes.join(small.select("cid").distinct(), "cid", "left_semi")))
    # what follows is about members of large lists alone: their sketches and sets are kept apart, so that no later step moves those of all classes
    crowd = written(still.where(F.col("members") > FEW).select("cid").distinct())
    if crowd.isEmpty():
        return labels
    known = written(classes.join(crowd, "cid", "left_semi"))
    sets = written(full_sets(documents, known.select("rep", "cid", "h1", "h2"), width))
    fine = written(narrowed(fine_lists(sets, percent), labels, percent))
    if fine.isEmpty():
        return labels
    for turns in (range(TURNS)[:1], range(TURNS)[1:]):
        if turns:
            pairs = likely(stars(open_lists(fine.drop("label", "members"), labels), percent, turns), known)
            labels = joined(labels, pairs, sets, percent)
    return last_links(fine, labels, sets, lambda pairs: likely(pairs, known), percent)


def last_links(fine: DataFrame, labels: DataFrame, sets: DataFrame, likely: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """labels after all links that fine lists hold, those of large lists by more shingles than one where that leaves fewer pairs."""
    after = lambda pairs: joined(labels, likely(pairs), sets, percent)
    met = lambda lists: all_pairs(lists, percent, F.col("core"))
    fine = written(narrowed(fine, labels, percent))
    ranked = None
    for depth in range(1, DEPTH + 1):
        hot = (F.col("members") > FEW) & (F.col("fewest") > depth) & (F.col("places") * GAIN < F.col("members") * F.col("members")) & F.lit(depth < DEPTH)
        labels = after(met(fine.where(~hot)))
        large = fine.where(hot)
        if depth == DEPTH or large.isEmpty():
            break
        ranked = ranked or written(_ranked_sets(sets, percent))
        parted = written(narrowed(extended(large, ranked, depth), labels, percent))
        worse = written(no_better(parted))
        if not worse.isEmpty():
            labels = after(met(large.join(worse.withColumnRenamed("parent", "value"), "value", "left_semi")))
        parted = parted.join(worse, "parent", "left_anti").drop("label", "need", "members", "fewest", "places")
        labels = after(stars(open_lists(parted, labels), percent))
        fine = written(narrowed(parted, labels, percent))
    return labels


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = PERCENT, k: int = K, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of documents (doc_id, text)."""
    tidy(documents.sparkSession)
    with scratch(documents.sparkSession) as kept:
        with scratch(documents.sparkSession) as until_done:
            sketched = written(sketches(documents, width, k))
            rows = kept(sketched.select("doc_id", "n", "h1", "h2"))
            named = sketched.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"))
            # ids are read from the written table, so that every later use sees the same
            classes = until_done(named.withColumn("cid", F.monotonically_increasing_id()))
        labels = linked_classes(documents, classes, width, percent, k, least)
        grouped = classes.join(labels, F.col("cid") == F.col("node")).select("h1", "h2", "n", "rep", "label")
        lowest = grouped.groupBy("label").agg(F.min("rep").alias("component"))
        of_class = kept(grouped.join(lowest, "label").select("h1", "h2", "n", "component"))
    whole = rows.join(of_class, ["h1", "h2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=2)
