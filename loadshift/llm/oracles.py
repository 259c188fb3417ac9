"""DuckDB SQL for those queries that SQL can express. Hash filters, sketches and pigeonholes only find candidates, so SQL states what
remains after the exact checks."""

from __future__ import annotations

from loadshift.llm import secret_scan, url_rules

WORD = r"'[^\x20\x09-\x0D]+'"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def run_of(words: str, first: str, n: int) -> str:
    return f"array_to_string(list_slice({words}, {first}, {first} + {n - 1}), ' ')"


DEDUP = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
windows AS (SELECT doc_id, i, md5({run_of("w", "i", 50)}) AS h FROM d, unnest(range(1, len(w) - 48)) r(i)),
firsts AS (SELECT h, min(doc_id) AS m FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (h) WHERE m < doc_id),
each AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) r(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS k FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

LEAKS = f"""
WITH it AS (SELECT item_id, regexp_extract_all(lower(text), {WORD}) AS w FROM benchmark),
ig AS (SELECT item_id, len(w) AS size, i - 1 AS q, {run_of("w", "i", 5)} AS g FROM it, unnest(range(1, len(w) - 3)) r(i)),
dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {WORD}) AS w FROM documents),
dg AS (SELECT doc_id, len(w) AS n, i - 1 AS p, {run_of("w", "i", 5)} AS g FROM dw, unnest(range(1, len(w) - 3)) r(i)),
win AS (SELECT DISTINCT doc_id, size, greatest(0, least(p - q, n - least(size, n))) AS s, least(size, n) AS len
  FROM dg JOIN (SELECT DISTINCT size, q, g FROM ig) USING (g)),
wb AS (SELECT win.doc_id, size, s, len, g, count(*) AS c FROM win JOIN dg ON dg.doc_id = win.doc_id AND p BETWEEN s AND s + len - 5 GROUP BY ALL),
wt AS (SELECT doc_id, size, s, sum(c) AS t FROM wb GROUP BY ALL),
ib AS (SELECT item_id, size, g, count(*) AS c FROM ig GROUP BY ALL),
tt AS (SELECT item_id, sum(c) AS t FROM ib GROUP BY ALL),
j AS (SELECT doc_id, item_id, size, s, len, sum(least(wb.c, ib.c)) AS c FROM wb JOIN ib USING (size, g) GROUP BY ALL),
k AS (SELECT doc_id, item_id, s, len, CAST(j.c AS DOUBLE) / CAST(wt.t + tt.t - j.c AS DOUBLE) AS similarity FROM j JOIN wt USING (doc_id, size, s) JOIN tt USING (item_id))
SELECT doc_id, item_id, CAST(arg_max(s, (similarity, -s)) AS INTEGER) AS start, CAST(arg_max(len, (similarity, -s)) AS INTEGER) AS length, max(similarity) AS similarity
FROM k WHERE similarity >= 0.8 GROUP BY doc_id, item_id"""

HOST = ASCII_LOWER.format(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")
BASE_RULES = ", ".join(f"({text(r.name)}, {text(r.verdict)}, {text(r.name.split('/', 1)[0])}, {text('/' + r.name.split('/', 1)[1])})" for r in url_rules.BASE_RULES)
URLS = rf"""
WITH p AS (SELECT page_id, {HOST} AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(name, v, h, q) AS (VALUES {BASE_RULES}),
best AS (SELECT page_id, arg_max(name, length(name)) AS rule, arg_max(v, length(name)) AS v FROM p
  JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(host, '(?:^|[.-])(?:{"|".join(url_rules.HOST_WORDS)})(?:[.-]|$)')
  THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN best USING (page_id)"""


def secrets() -> str:
    found = " UNION ALL ".join(
        f"""SELECT doc_id, '{r.kind}' AS kind, {i} AS place, {r.least} AS least, regexp_extract_all(t, {text(r.pattern)}) AS m,
        regexp_extract_all(t, {text(r.pattern)}, {r.group}) AS tested, string_split_regex(t, {text(r.pattern)}) AS gaps FROM d
        WHERE regexp_matches(t, {text(r.pattern)})"""
        for i, r in enumerate(secret_scan.RULES)
    )
    base = ", ".join(f"'{r.kind}'" for r in secret_scan.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE)
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
    s AS (SELECT doc_id, kind, place, least, length(tested[i]) AS size,
      list_sum(list_transform(list_slice(gaps, 1, i), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(m, 1, i - 1), lambda x: length(x))), 0) AS a,
      a + length(m[i]) AS b FROM f, unnest(range(1, len(m) + 1)) r(i)),
    g AS (SELECT doc_id, {counts}, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) FILTER (kind IN ({base})) AS base,
      string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) AS spans FROM s WHERE size >= least GROUP BY doc_id)
    SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)}, sha256(coalesce(base, '')) AS base_sha256,
      coalesce(spans, '') AS spans FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""


LINKS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, {WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, {run_of("w", "i", 5)} AS g FROM d, unnest(range(1, greatest(len(w) - 3, 2))) r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)"""

AUDIT = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
f AS (SELECT t, min(doc_id) AS m FROM d GROUP BY t),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END)
  || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END)
  || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN coalesce(d.doc_id > m, false) THEN 'E' ELSE '' END) AS x
  FROM d JOIN f USING (t) LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, x, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY ALL),
o(s) AS (SELECT '' UNION ALL SELECT s || v FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) q(v) WHERE NOT contains(s, v)),
p AS (SELECT s AS filter_order, i AS step, s[1:i-1] AS before, s[i] AS f FROM o, range(1, 6) r(i) WHERE length(s) = 5),
r AS (SELECT part, filter_order, step, f,
  coalesce(sum(n) FILTER (x = '' OR translate(x, before || f, '') = x), 0) AS kept,
  coalesce(sum(n) FILTER (contains(x, f) AND translate(x, before, '') = x), 0) AS removed,
  coalesce(sum(n) FILTER (contains(x, f) AND translate(x, before, '') <> x), 0) AS redundant,
  coalesce(sum(n) FILTER (x = f), 0) AS unique_fails,
  coalesce(sum(good) FILTER (contains(x, f) AND translate(x, before, '') = x), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (contains(x, f) AND translate(x, before, '') = x), 0) AS toxic_lost
  FROM c, p GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""

NEGATIVES = """
WITH e AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM e a, e r WHERE a.id % 100 = 0 AND a.id <> r.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id,
  positive_score, score AS negative_score FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""

SQL: dict[str, str] = {
    "op1_substring_dedup": DEDUP,
    "op3_decontamination": LEAKS,
    "op7_url_rules": URLS,
    "op9_secret_scan": secrets(),
    "op10_ngram_join": LINKS,
    "op11_filter_audit": AUDIT,
    "op13_hard_negatives": NEGATIVES,
}
