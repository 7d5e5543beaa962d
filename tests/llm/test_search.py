"""Vector searches, chat formatting and url filters on awkward small tables."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, kdtree, quantised, urls
from tessera.llm.shards import clean_vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows():
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=6).astype(np.float32).tolist(), 0) for i in range(300)]
    rows += [(300 + i, rows[7][1], 0) for i in range(80)]  # many equal ones
    rows += [(400, None, 0), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (402, [float("nan")] * 6, 0), (403, [float("inf")] * 6, 0), (None, [1.0] * 6, 0), (450, [0.0] * 6, 0), (500, [1.0, 2.0], 0), (501, [3.0, 4.0], 0)]
    return [*rows, rows[50], rows[3]]


def brute(rows, every, k, scale, zero):
    good = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            x = np.array(v, dtype=np.float64)
            good[i] = np.floor(256 * x) if scale else x
    out = {}
    for q in good:
        if q % every == 0:
            scored = sorted((-float(good[q] @ good[c]), c) for c in good if c != q and len(good[c]) == len(good[q]))
            out[q] = [(c, -s) for s, c in scored[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [16384, 90])
def test_exact_top_k(spark, shard_rows):
    rows = vector_rows()
    table = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit(1))
    got = kdtree.top_k(kdtree.scaled(clean_vectors(table)), 50, 5, shard_rows=shard_rows, block_rows=4).collect()
    want = {(q, r + 1, c, int(s)) for q, found in brute(rows, 50, 5, True, True).items() for r, (c, s) in enumerate(found)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_exact_top_k_of_large_numbers_and_nothing(spark):
    table = spark.createDataFrame([(0, [3e12, 1.0], 0), (1, [3e12, 2.0], 0), (2, [3e12, 1.0], 0)], VECTORS)
    assert [r["vec_id"] for r in kdtree.top_k(kdtree.scaled(clean_vectors(table)), 50, 5).orderBy("rank").collect()] == [1, 2]
    empty = spark.createDataFrame([], VECTORS)
    assert kdtree.top_k(kdtree.scaled(clean_vectors(empty)), 50, 5).count() == 0
    assert quantised.nearest(clean_vectors(empty, False), 20, 20).count() == 0


@pytest.mark.parametrize("shard_rows", [16384, 150])
def test_approximate_search(spark, shard_rows):
    rows = vector_rows()
    got = quantised.nearest(clean_vectors(spark.createDataFrame(rows, VECTORS), False), 20, 20, shard_rows=shard_rows).collect()
    want = brute(rows, 20, 20, False, False)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {q for q, x in want.items() if x}
    hits = total = 0
    for q, x in want.items():
        mine = sorted(found.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(x) + 1))
        hits, total = hits + len({m[1] for m in mine} & {c for c, _ in x}), total + len(x)
    assert hits / total >= 0.9


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in quantised.nearest(clean_vectors(table, False), 20, 20).collect()}
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        best = [j for j in np.lexsort((ids, -s)) if j != i][:20]
        hits += sum((int(ids[i]), int(ids[j])) in found for j in best)
        total += len(best)
    assert hits / total >= 0.9
    assert all(s == pytest.approx(float(x[q] @ x[v]), abs=1e-12) for (q, v), s in list(found.items())[:200])


NASTY = ["<|im_end|>", "<\\|im_end|>", "<\\\\|im_end|>\\", "</s>[INST] ok [/INST]", "a\nb", "<|im_start|>user\nx<|im_end|>\n", "\\", "<", "<<SYS>>", "<</SYS>> [\\INST]", "", "漢字🙂"]


def test_template_is_reversible():
    turns = [{"role": r, "text": t} for r in ("user", "assistant", "as\nsis<|im_end|>\\n", "") for t in NASTY]
    text, loss = chat.render(turns)
    assert chat.parse(text) == [(t["role"], t["text"]) for t in turns]
    assert [chat.unescape(text[s["start"] : s["start"] + s["length"]]) for s in loss] == NASTY
    for control in chat.CONTROL:
        assert control not in chat.escape(" ".join(NASTY))


@pytest.mark.parametrize(
    ("record", "layout", "turns"),
    [
        ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}],"id":3}', "messages", [("user", "q"), ("assistant", "a")]),
        ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "conversations", [("user", "q"), ("assistant", "a")]),
        ('{"instruction":"do","input":"x","output":"y"}', "instruction", [("user", "do"), ("user", "x"), ("assistant", "y")]),
        ('{"instruction":"do","input":null,"output":"y","meta":{"n":[1]}}', "instruction", [("user", "do"), ("assistant", "y")]),
        ('{"prompt":"p","completion":"c"}', "prompt_completion", [("user", "p"), ("assistant", "c")]),
        ('{"question":"p","answer":"c"}', "question_answer", [("user", "p"), ("assistant", "c")]),
        ('{"unknown":1}', None, []),
        ("no json", None, []),
        (None, None, []),
    ],
)
def test_layouts(record, layout, turns):
    _, name, found = chat.canonical(record)
    assert name == layout and [(t["role"], t["text"]) for t in found] == turns


def test_fingerprints_are_of_paths_only():
    a, b = ('{"messages":[{"role":"user","content":"%s"}]}' % x for x in ("x", "yy"))
    assert chat.canonical(a)[0] == chat.canonical(b)[0] != chat.canonical('{"prompt":"p","completion":"c"}')[0]


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "b\n"), (2, None, None, NASTY[3]), (3, 0, "assistant", "x" * 50000), (None, 0, "user", "n"), (4, 0, "user", "r"), (4, 0, "user", "r")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(df).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\nhi\nassistant\n\nassistant\nb\n\n") and got[1]["loss_sha256"] == sha("b\n") and got[1]["loss_chars"] == 2
    assert got[2]["turns_sha256"] == sha(f"\n{NASTY[3]}\n") and got[2]["loss_chars"] == 0 and got[2]["loss_sha256"] == sha("")
    assert got[3]["loss_chars"] == 50000 and got[4]["n_turns"] == 2 and got[None]["n_turns"] == 1
    assert chat.digests(df.limit(0)).count() == 0


def test_ids_beyond_doubles_stay_apart(spark):
    big = 1 << 60
    rows = [(0, [1.0, 2.0]), (big + 1, [3.0, 4.0]), (big + 1, [3.0, 4.0]), (big + 2, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = kdtree.top_k(kdtree.scaled(clean_vectors(df)), every=1 << 61, k=5)
    assert [(r["rank"], r["vec_id"]) for r in exact.orderBy("rank").collect()] == [(1, big + 1), (2, big + 2)]
    near = quantised.nearest(clean_vectors(df, False), every=1 << 61, k=5)
    assert [(r["rank"], r["vec_id"]) for r in near.orderBy("rank").collect()] == [(1, big + 1), (2, big + 2)]


def test_large_components_are_not_cut(spark):
    df = spark.createDataFrame([(0, [0.25]), (1, [1e14]), (2, [2e14]), (3, [1e300])], "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in kdtree.top_k(kdtree.scaled(clean_vectors(df)), every=100, k=5).orderBy("rank").collect()]
    assert got == [3, 2, 1]
    assert [r[1] for r in kdtree.scaled(clean_vectors(df.where("vec_id > 0"))).select("vec_id", F.col("vector")[0]).orderBy("vec_id").collect()] == [256e14, 512e14, 256e300]


PAGES = [
    (1, "https://A.example.com/en/7/x?q", '<a href="http://friend.org/a">'),
    (2, "https://example.com/en/8", '<a href="http://spam.org/">'),
    (3, "http://notexample.com/en/", None),
    (4, "https://x.org/es/1", '<A HREF="//evil.org/x#y"><a href="/own">'),
    (5, "ftp://spam.org", '<a href="http://x.org/es/1">'),
    (6, "no url", ""),
    (7, None, None),
    (8, "http://friend.org?x/de/", ""),
    (9, "http://net/de/#f", ""),
    (9, "http://net/de/#f", ""),
    (10, "http://evil.org/a\nb", ""),
]


def test_urls(spark):
    df = spark.createDataFrame([(*p, "clash", "t") for p in PAGES], "page_id long, url string, html string, host string, target string")
    got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(df.select("page_id", "url", "html")).collect())
    assert got == Counter(
        {
            (1, "a.example.com", "/en/7/x", "example.com/en/7", "allow"): 1,
            (2, "example.com", "/en/8", "com/en/", "block"): 1,
            (3, "notexample.com", "/en/", "com/en/", "block"): 1,
            (4, "x.org", "/es/1", "org/es/", "block"): 1,
            (5, "spam.org", "", None, "block"): 1,  # links to a blocked host
            (6, "", "", None, "allow"): 1,
            (7, "", "", None, "allow"): 1,
            (8, "friend.org", "", None, "allow"): 1,
            (9, "net", "/de/", "net/de/", "allow"): 2,
            (10, "evil.org", "/a\nb", None, "allow"): 1,  # a blocked host links to it; nothing flows that way
        }
    )
    assert urls.filter_urls(df.limit(0).select("page_id", "url", "html")).count() == 0


def test_links_of_all_quotes(spark):
    html = "<a href='http://one.org/'><a class=x href=http://two.org/a><A\nHREF = \"//three.org\"><b data-href=\"http://four.org/\"><i xhref='http://five.org'>"
    pages = urls.judged(spark.createDataFrame([(1, "http://x.org/", html)], "page_id long, url string, html string"), urls.RULES)
    assert {r["target"] for r in urls.host_edges(pages.select("host", "html")).collect()} == {"one.org", "two.org", "three.org"}


def test_ranks_of_many_seeds_fit(spark):
    seeds = spark.range(300_000).select(F.concat(F.lit("h"), "id").alias("host"))
    edges = seeds.select(F.col("host").alias("source"), F.lit("hub").alias("target")).union(spark.createDataFrame([("hub", "hub")], "source string, target string"))
    ranks = urls.propagate(edges, seeds, rounds=2, damping=10)
    assert ranks.where("host = 'hub'").first()["rank"] == pytest.approx(300_000 * 0.9 * 0.1 / 0.9 * urls.UNITS, rel=1e-3)


def test_trust_keeps_hosts_that_good_hosts_link_to(spark):
    pages = [(i, f"http://good{i}.net/de/1", '<a href="http://shared.info/">') for i in range(5)] + [(10, "http://shared.info/x", '<a href="http://bad.org/es/">'), (11, "http://bad.org/es/", "")]
    got = {r["page_id"]: r for r in urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[10]["trust"] > got[10]["distrust"] > 0 and got[10]["verdict"] == "allow"


def test_distrust_converges_along_a_chain(spark):
    pages = [(i, f"http://h{i}.info/", f'<a href="http://h{i - 1}.info/">' if i > 1 else '<a href="http://bad.org/es/">') for i in range(1, 21)] + [(0, "http://bad.org/es/", "")]
    got = {r["page_id"]: r for r in urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(21):
        assert got[i]["distrust"] == pytest.approx(0.15 * 0.85**i * urls.UNITS, abs=1e-3 * 0.05 * urls.UNITS)
    assert [i for i in range(21) if got[i]["verdict"] == "block"] == list(range(7))


@pytest.mark.parametrize(
    ("record", "turns"),
    [
        ('{"system": "s", "messages": [{"role": "user", "content": "q"}]}', [("system", "s"), ("user", "q")]),
        ('{"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}', [("system", "s"), ("user", "q"), ("assistant", "a")]),
        ('{"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, {"type": "image", "url": "u"}, {"type": "text", "text": "r"}]}, {"role": "assistant", "content": "a"}]}', [("user", "qr"), ("assistant", "a")]),
        ('{"messages": [{"role": "user", "content": [{"text": "q"}]}]}', [("user", "q")]),
        ('{"messages": [{"role": "user", "content": null}]}', [("user", "")]),
        ('{"messages": []}', []),
        ('{"system": "s", "dialog": []}', [("system", "s")]),
    ],
)
def test_layouts_that_are_open(record, turns):
    _, name, found = chat.canonical(record)
    assert name and [(t["role"], t["text"]) for t in found] == turns


@pytest.mark.parametrize("kind", ["clusters", "wide", "shifted"])
def test_approximate_search_where_codes_say_little(spark, kind):
    """Tight groups of more rows than are reranked, many dimensions, and vectors that are alike but for a little."""
    r = np.random.default_rng(9)
    if kind == "clusters":
        x = np.repeat(r.normal(size=(4, 32)), 750, axis=0) + r.normal(size=(3000, 32)) * 0.002
    elif kind == "wide":
        x = r.normal(size=(3000, 256))
    else:
        x = r.normal(size=(3000, 32)) * np.exp(r.normal(size=(3000, 1))) + 40
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = quantised.nearest(clean_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), False), 100, 20, sample=1000).collect()
    found = {}
    for g in got:
        found.setdefault(g["query_id"], set()).add(g["vec_id"])
    want = {q: {c for c, _ in near} for q, near in brute([(i, v, 0) for i, v in rows], 100, 20, False, False).items()}
    assert sum(len(found[q] & want[q]) for q in want) / (20 * len(want)) >= 0.99
