"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (
    "list_filter(string_split_regex(" + _LOWER + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

OP7 = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS ws FROM documents),
b AS (SELECT item_id, coalesce({_WORDS.format('text')}, []) AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, len(win) AS size, win FROM (
    SELECT item_id, ws[p + 1 : p + least(10, len(ws))] AS win
    FROM (SELECT item_id, ws, unnest(range(0, greatest(1, len(ws) - 9))) AS p FROM b WHERE len(ws) > 0)
  )
),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, p, ws[p + 1 : p + size] AS win
  FROM (SELECT doc_id, ws, size, unnest(range(0, len(ws) - size + 1)) AS p FROM d, sizes WHERE len(ws) >= size)
),
hit AS (SELECT doc_id, p, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win),
cov AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id
),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

ORACLES = {"op7_decontamination": OP7}

# ---- near duplicates: shared shingles, then reachability

_SPACED = "list_filter(string_split_regex(" + _LOWER.format("text") + r", '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({_SPACED}, []) AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, ws[p + 1 : p + least(5, len(ws))] AS s
  FROM (SELECT doc_id, ws, unnest(range(0, greatest(1, len(ws) - 4))) AS p FROM d WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

# ---- host trust: rules, links, and the rounds written out


def _op3(block: list[str], allow: list[str], rounds: int, damping: int, unit: int, threshold: int) -> str:
    rules = ", ".join(
        f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{v}')" for v, rs in (("block", block), ("allow", allow)) for r in rs
    )

    def split(url: str) -> str:
        rest = f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) END"
        host = f"regexp_extract({rest}, '^([^/?#]*)', 1)"
        return f"coalesce({_LOWER.format(host)}, '') AS host, coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '') AS path"

    link = r"""(?i)\bhref\s*=\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^\s"''<>]+)"""
    steps = ["r0 AS (SELECT kind, host, own AS rank FROM base)"]
    for i in range(rounds):
        steps.append(
            f"r{i + 1} AS (SELECT kind, host, CAST(sum(rank) AS BIGINT) AS rank FROM (SELECT kind, host, own AS rank FROM base UNION ALL "
            f"SELECT g.kind, g.dst, (r.rank * {damping}) // (100 * g.fanout) FROM graph g JOIN r{i} r ON r.kind = g.kind AND r.host = g.src) "
            "GROUP BY kind, host)"
        )
    return f"""
WITH p AS (SELECT page_id, html, {split('url')}, row_number() OVER () AS i FROM pages),
rules(rh, rp, rule, ruling) AS (VALUES {rules}),
best AS (
  SELECT i, arg_max(rule, length(rule)) AS rule, arg_max(ruling, length(rule)) AS ruling
  FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY i
),
ruled AS (SELECT p.i, page_id, host, path, rule, ruling FROM p LEFT JOIN best USING (i)),
hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (WHERE ruling = 'allow') AS al, count(*) FILTER (WHERE ruling = 'block') AS bl
  FROM ruled WHERE host <> '' GROUP BY host
),
found AS (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM p),
whole AS (SELECT src, CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END AS url FROM found),
edge AS (SELECT DISTINCT src, host AS dst FROM (SELECT src, {split('url')} FROM whole) WHERE src <> host AND src <> '' AND host <> ''),
unseen AS (
  SELECT dst AS host, 1 AS n, CAST(arg_max(ruling, length(rule)) = 'allow' AS INTEGER) AS al, CAST(arg_max(ruling, length(rule)) = 'block' AS INTEGER) AS bl
  FROM (SELECT DISTINCT dst FROM edge WHERE dst NOT IN (SELECT host FROM hosts)) JOIN rules ON (dst = rh OR ends_with(dst, '.' || rh)) AND rp = '/' GROUP BY dst
),
start AS (SELECT * FROM hosts UNION ALL SELECT * FROM unseen),
base AS (
  SELECT kind, host, ((100 - {damping}) * seed) // 100 AS own FROM (
    SELECT 'trust' AS kind, host, (al * {unit}) // n AS seed FROM start UNION ALL SELECT 'distrust', host, (bl * {unit}) // n FROM start
  ) WHERE seed > 0
),
fan AS (SELECT src, dst, count(*) OVER (PARTITION BY src) AS fanout FROM edge),
graph AS (SELECT 'trust' AS kind, src, dst, fanout FROM fan UNION ALL SELECT 'distrust', dst, src, fanout FROM fan),
{", ".join(steps)},
ranks AS (
  SELECT host, sum(rank) FILTER (WHERE kind = 'trust') AS t, sum(rank) FILTER (WHERE kind = 'distrust') AS d FROM r{rounds} GROUP BY host
)
SELECT page_id, ruled.host, path, rule,
  coalesce(ruling, CASE WHEN coalesce(d, 0) - coalesce(t, 0) > {threshold} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(coalesce(t, 0) AS DOUBLE) / {unit} AS trust, CAST(coalesce(d, 0) AS DOUBLE) / {unit} AS distrust
FROM ruled LEFT JOIN ranks USING (host)
"""


OP3 = _op3(["net/", "example.com/de/"], ["example.net/en/", "org/fr/"], 12, 85, 10**12, 75 * 10**9)

# ---- repeated byte strings, as hex text

OP10 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w),
hit AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM r WHERE k > 1),
span AS (
  SELECT doc_id, min(p) AS lo, max(p) + 100 AS hi
  FROM (SELECT *, sum(CASE WHEN before IS NULL OR before + 100 < p THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM hit)
  GROUP BY doc_id, g
),
gap AS (
  SELECT doc_id, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS a, lo AS b FROM span
  UNION ALL SELECT span.doc_id, max(hi), any_value(len(h) // 2) FROM span JOIN d USING (doc_id) GROUP BY span.doc_id
),
kept AS (
  SELECT gap.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gap JOIN d USING (doc_id) GROUP BY gap.doc_id
),
n AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES |= {"op3_link_graph": OP3, "op9_minhash": OP9, "op10_suffix_dedup": OP10}

# ---- fill in the middle

_DRAW = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"

OP11 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
cut AS (
  SELECT doc_id, t, n, least({_DRAW.format(1)} % (n + 1), {_DRAW.format(9)} % (n + 1)) AS a,
    greatest({_DRAW.format(1)} % (n + 1), {_DRAW.format(9)} % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_DRAW.format(17)} % 100 >= 90
      THEN 'plain' WHEN {_DRAW.format(25)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
piece AS (
  SELECT *, left(t, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM piece
"""

ORACLES["op11_fill_in_middle"] = OP11

# ---- ranked search: all documents scored, integer division rounding down

_TERMS = (
    "list_filter(string_split_regex(" + _LOWER.format("text") + r", '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

OP12 = f"""
WITH d AS (SELECT doc_id, coalesce({_TERMS}, []) AS ts FROM documents),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
held AS (SELECT doc_id, len(ts) AS n, unnest(ts) AS t FROM d),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM held WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total
),
part AS (
  SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))) AS part
  FROM tf JOIN w USING (t), total
),
score AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN part USING (t) GROUP BY ALL),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM score WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLES["op12_ranked_search"] = OP12

# ---- lines that many documents share

_KEY = "trim(" + _LOWER.format("line") + ", ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

OP13 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
),
k AS (SELECT doc_id, line, place, {_KEY} AS key FROM l),
gone AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN gone USING (key) GROUP BY doc_id
"""

ORACLES["op13_line_dedup"] = OP13
