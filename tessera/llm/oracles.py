"""SQL (DuckDB) that gives the rows of the operators' queries, where SQL can express them.

Suffix dedup (op2), quality (op3), byte BPE (op4) and approximate search (op9) have none: the first needs every 200-byte string of the corpus
as a row, the others learn, use a tokenizer's merges, or are approximate. tests/llm holds them against brute force."""

from __future__ import annotations

from tessera.llm import chat, divergence, licenses, mixing, periodic, urls

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def chat_sql() -> str:
    tails = {h: "|".join("".join(f"\\{x}" if x in "|[]<>/" else x for x in c[1:]) for c in chat.CONTROL if c[0] == h) for h in "<["}
    escaped = "coalesce(text, '')"
    for head, rest in tails.items():
        escaped = f"regexp_replace({escaped}, '(\\{head})(\\\\*)({rest})', '\\1\\\\\\2\\3', 'g')"
    marks = len(chat.START) + len(chat.END) + 2
    return f"""WITH t AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(coalesce(text, ''))) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(length({escaped}) + length(coalesce(role, '')) + {marks}) AS BIGINT) AS formatted_chars FROM t GROUP BY conv_id"""


def near_sql(width: int = 2, percent: int = 80) -> str:
    parts = " || chr(31) || ".join(f"w[i + {k}]" for k in range(width))
    return f"""WITH RECURSIVE words AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, CASE WHEN len(w) >= {width} THEN unnest([{parts} for i in range(1, len(w) - {width} + 2)]) END AS s FROM words WHERE len(w) >= {width}
UNION ALL SELECT doc_id, array_to_string(w, chr(31)) FROM words WHERE len(w) BETWEEN 1 AND {width - 1})),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT s FROM sh GROUP BY s HAVING count(*) > 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN common USING (s) JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= {percent} * (p.n + q.n - i)),
e AS MATERIALIZED (SELECT x AS u, y AS v FROM l UNION SELECT y, x FROM l),
r AS (SELECT u AS d, u AS m FROM e UNION SELECT e.v, r.m FROM r JOIN e ON e.u = r.d)
SELECT words.doc_id, coalesce(n.n, 0) AS n_shingles, least(words.doc_id, coalesce(k.m, words.doc_id)) AS component_id, words.doc_id = least(words.doc_id, coalesce(k.m, words.doc_id)) AS kept
FROM words LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT d AS doc_id, min(m) AS m FROM r GROUP BY 1) k USING (doc_id)"""


def top_k_sql(every: int = 50, k: int = 5) -> str:
    return f"""WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= {k}"""


def url_sql(rules=urls.RULES, rounds: int = urls.ROUNDS, damping: int = urls.DAMPING, least: int = urls.LEAST) -> str:
    def chain(value) -> str:
        whens = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in sorted(rules, key=lambda r: (len(r.name), r.name), reverse=True)]
        return f"CASE {' '.join(whens)} END"

    steps = []

    def walk(tag: str, source: str, target: str, seeds: str) -> None:
        degree = f"(SELECT {source} AS f, count(*) AS d FROM e GROUP BY 1)"
        steps.append(f"{tag}0 AS (SELECT host, CAST({urls.UNITS} AS BIGINT) AS rank FROM hosts WHERE {seeds})")
        for i in range(rounds):
            flow = f"SELECT e.{target} AS host, ((rank * {damping} // 100) // d) AS rank FROM {tag}{i} JOIN e ON e.{source} = host JOIN {degree} g ON g.f = host"
            steps.append(f"{tag}{i + 1} AS MATERIALIZED (SELECT host, CAST(sum(rank) AS BIGINT) AS rank FROM ({flow} UNION ALL SELECT host, rank * {100 - damping} // 100 FROM {tag}0) GROUP BY 1 HAVING sum(rank) > 0)")

    walk("t", "source", "target", "trusted AND NOT blocked")
    walk("b", "target", "source", "blocked AND NOT trusted")
    nl = ",\n"
    return f"""WITH p AS MATERIALIZED (SELECT page_id, html, coalesce({_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS MATERIALIZED (SELECT page_id, host, path, {chain(lambda r: r.name)} AS rule, {chain(lambda r: r.verdict)} AS ruled FROM p),
k AS (SELECT host, trim(unnest(regexp_extract_all(html, {_quoted(urls.HREF)}, 1)), '"''') AS link FROM p WHERE host <> ''),
h AS (SELECT host, {_LOWER.format("regexp_extract(link, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)")} AS target FROM k),
e AS MATERIALIZED (SELECT DISTINCT host AS source, CASE WHEN target = '' THEN host ELSE target END AS target FROM h),
hosts AS MATERIALIZED (SELECT host, bool_or(ruled = 'allow') AS trusted, bool_or(ruled = 'block') AS blocked FROM j WHERE ruled IS NOT NULL GROUP BY 1),
{nl.join(steps)}
SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN coalesce(b.rank, 0) >= {urls.UNITS * least // 1000} AND coalesce(b.rank, 0) > coalesce(t.rank, 0) THEN 'block' ELSE 'allow' END) AS verdict, coalesce(t.rank, 0) AS trust, coalesce(b.rank, 0) AS distrust
FROM j LEFT JOIN t{rounds} t ON t.host = j.host LEFT JOIN b{rounds} b ON b.host = j.host"""


def mix_sql(seed: str = "mix", most: int = mixing.MAX_COPIES) -> str:
    uniform = f"((('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT * 2 + 1) / {float(2**49)})"
    liked = f"(500 + CAST(floor(CAST(size AS DOUBLE) * 1000 / (size + {mixing.MIDDLE})) AS BIGINT))"
    alike, scale = "(target / source_size)", "(CAST(source_size AS DOUBLE) / moment)"
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size, {uniform} AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size * {liked}) AS BIGINT) AS moment FROM d GROUP BY 1),
w AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight, source_size * {most} AS cap FROM s),
f AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level FROM w WINDOW o AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS MATERIALIZED (SELECT source, source_size, moment, CASE WHEN level * weight > cap THEN CAST(cap AS DOUBLE) ELSE (max(level) FILTER (NOT level * weight > cap) OVER ()) * weight END AS target FROM f),
x AS MATERIALIZED (SELECT d.*, t.source_size, t.target, CASE WHEN size = 0 THEN CAST(0 AS DOUBLE) WHEN {alike} >= {most} THEN CAST({most} AS DOUBLE)
ELSE least({alike} + {alike} * least(CAST(1 AS DOUBLE), ({most} - {alike}) / ({alike} * ({scale} * 1500 - 1))) * ({scale} * {liked} - 1), CAST({most} AS DOUBLE)) END AS c FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
y AS (SELECT *, CAST(floor(c) AS BIGINT) AS whole, c - floor(c) AS part FROM x),
z AS (SELECT *, CASE WHEN part > 0 THEN u * (1 - part) / (u * (1 - part) + (1 - u) * part) END AS rank FROM y),
r AS (SELECT *, target - sum(size * whole) OVER (PARTITION BY source) AS rest, sum(CASE WHEN part > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2 AS middle FROM z)
SELECT doc_id, size, source_size, target, size * (whole + CASE WHEN part > 0 AND middle <= rest THEN 1 ELSE 0 END) AS taken FROM r"""


def license_sql() -> str:
    words = f"regexp_extract_all({_LOWER.format('{}')}, '{licenses.TOKEN}')"
    phrases = [(p.split(), label) for p, label in licenses.PHRASES.items()]
    places = " || ".join(f"[i for i in range(1, len(w) - {len(p) - 2}) if w[i:i + {len(p) - 1}] = {p!r}]" for p, _ in phrases)
    base = ", ".join(f"CASE WHEN list_contains([w[i:i + {len(p) - 1}] for i in range(1, len(w) - {len(p) - 2})], {p!r}) THEN {_quoted(label)} END" for p, label in phrases)
    templates = ", ".join(f"({i}, {_quoted(t.label)}, {sorted(set(t.text.split()))!r}, {sorted(set(t.told_by.split()))!r})" for i, t in enumerate(licenses.TEMPLATES))
    half = licenses.WINDOW // 2
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, text, {words.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n_words, {places} AS spots, list_filter([{base}], lambda x: x IS NOT NULL) AS base FROM d),
t(i, label, need, told) AS (VALUES {templates}),
b AS (SELECT DISTINCT doc_id, list_distinct(w[i * {half} + 1:i * {half} + {licenses.WINDOW}]) AS have FROM (SELECT doc_id, w, unnest(range((len(w) - 1) // {half} + 1)) AS i FROM d WHERE len(w) > 0)),
m AS (SELECT doc_id, label, len(list_intersect(have, need)) / len(need) AS share FROM b, t WHERE len(list_intersect(have, need)) * 100 >= {licenses.THRESHOLD_PERCENT} * len(need) AND list_has_all(have, told)),
f AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM m GROUP BY 1)
SELECT p.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(spots) AS BIGINT) AS n_base, CAST(list_min(spots) - 1 AS BIGINT) AS first_word, CAST(list_max(spots) - 1 AS BIGINT) AS last_word, array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ',') AS labels, CASE WHEN len(spots) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score FROM p LEFT JOIN f USING (doc_id)"""


def runs_sql(least: int = periodic.LEAST, times: int = periodic.TIMES) -> str:
    bits = "list_reduce([xor(c, b)] || CAST(range(8) AS UBIGINT[]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT)), lambda c, b: {bits}), 4294967295)"
    seed = " || ' ' || ".join(f"w[i + {k}]" for k in range(1, least))
    return f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, {crc} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT *, len(w) AS n, CAST(h // 10 % greatest(len(w), 1) AS BIGINT) AS a, CAST(3 + h // 10 % 8 AS BIGINT) AS parts FROM d),
x AS MATERIALIZED (SELECT k, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN w[1:a] || [w[a + 1 + i % (1 + (n - a) // parts)] for i in range(CAST(n - a AS BIGINT))] ELSE w END AS w FROM t),
words AS MATERIALIZED (SELECT k, unnest(range(n)) AS i, unnest(w) AS word FROM x),
g AS (SELECT k, n, i, {seed} AS s FROM (SELECT k, n, w, unnest(range(n - {least - 2})) AS i FROM x WHERE n >= {least})),
s AS MATERIALIZED (SELECT * FROM g QUALIFY count(*) OVER (PARTITION BY k, s) > 1),
q AS MATERIALIZED (SELECT DISTINCT a.k, b.i - a.i AS q FROM s a JOIN s b ON a.k = b.k AND a.s = b.s AND b.i > a.i WHERE (b.i - a.i) * {times} <= a.n),
same AS (SELECT q.k, q, a.i FROM q JOIN words a ON a.k = q.k JOIN words b ON b.k = q.k AND b.i = a.i + q WHERE a.word = b.word),
islands AS (SELECT k, q, min(i) AS s, count(*) + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM same) GROUP BY k, q, island HAVING count(*) + q >= greatest({least}, {times} * q)),
r AS MATERIALIZED (SELECT * FROM islands a WHERE NOT EXISTS (SELECT 1 FROM islands b WHERE b.k = a.k AND b.q < a.q AND b.s <= a.s AND b.s + b.l >= a.s + a.l)),
best AS (SELECT k, count(*) AS n_runs, list({{'s': s, 'l': l, 'q': q}} ORDER BY l DESC, s, q)[1] AS b, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM r GROUP BY k),
gone AS (SELECT DISTINCT k, unnest(range(s + q, s + l)) AS i FROM r),
kept AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (k, i) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period, b.l * 1000 // b.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM x LEFT JOIN best USING (k) LEFT JOIN kept USING (k)"""


def divergence_sql(least: int = divergence.LEAST_DOCUMENTS, top: int = divergence.TOP, unit: int = divergence.UNIT) -> str:
    share = lambda n, total, v: f"1 + CAST({unit} AS HUGEINT) * ({n} + 1) // ({total} + {v})"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
o AS (SELECT k, lang, source, unnest(w) AS term FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n, count(DISTINCT k) AS docs FROM o GROUP BY ALL),
v AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= {least}),
m AS MATERIALIZED (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n, v.n AS lang_n FROM g JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
t AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS terms FROM m),
s AS MATERIALIZED (SELECT lang, source, term, n, {share("n", "total", "terms")} AS p, {share("lang_n", "(sum(n) OVER (PARTITION BY lang))", "terms")} AS q FROM t),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM s WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= {top}"""


ORACLES = {
    "op1_chat_format": chat_sql(),
    "op5_minhash_dedup": near_sql(),
    "op6_kdtree_topk": top_k_sql(),
    "op7_url_filter": url_sql(),
    "op8_pareto_mixing": mix_sql(),
    "op10_license_scan": license_sql(),
    "op12_source_divergence": divergence_sql(),
    "op13_periodic_runs": runs_sql(),
}
