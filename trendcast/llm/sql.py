"""DuckDB SQL for those queries whose result SQL can express."""

from trendcast.llm.chat import CONTROL, MARKS, NAMED, OTHER, OTHER_END
from trendcast.llm.mixing import WEIGHTS
from trendcast.llm.secrets import BASE, COMPLEMENTS, KINDS, SCOPE_BREAK, WEAK

SQL: dict[str, str] = {}

SQL["op8_mix_sources"] = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS ord
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no
  FROM d GROUP BY source),
w AS (
  SELECT *, {list(WEIGHTS)}[((no - 1) % {len(WEIGHTS)} + 1)::BIGINT] AS weight, source_size * 2.0::DOUBLE AS most FROM s),
f AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (
           ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (SELECT source, source_size, least(most, max(level) OVER () * weight)::DOUBLE AS target FROM f),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, (sum(d.size) OVER (
           PARTITION BY d.source ORDER BY ord, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * ((2 * start + size < 2 * target)::INT + (2 * (source_size + start) + size < 2 * target)::INT))::BIGINT AS taken
FROM p"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _kind(kind: str) -> str:
    pattern, group, least = (BASE | WEAK | {"break": (SCOPE_BREAK, 0, 0)})[kind]
    p = _quoted(pattern)
    counts = f"length(measured) >= {least}"
    if kind == "opaque":
        counts += " AND regexp_matches(span, '[0-9]') AND regexp_matches(span, '[a-z]') AND regexp_matches(span, '[A-Z]')"
    return f"""
  SELECT row_id, '{kind}' AS kind, no, length(gap) AS gap, length(span) AS span, {counts} AS counts
  FROM (SELECT row_id, unnest(range(1, len(spans) + 1)) AS no, unnest(spans) AS span, unnest(measures) AS measured,
               unnest(gaps[1:len(spans)]) AS gap
        FROM (SELECT row_id, regexp_extract_all(text, {p}) AS spans, regexp_extract_all(text, {p}, {group}) AS measures,
                     string_split_regex(text, {p}) AS gaps FROM d))"""


_BASE = ", ".join(f"'{k}'" for k in BASE)
_LINKED = " OR ".join(
    f"(kind = '{weak}' AND count(*) FILTER (kind IN ({', '.join(map(_quoted, others))})) OVER near > 0)"
    for weak, others in COMPLEMENTS.items())
_COUNTS = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
_NUMBER = f"list_position([{', '.join(map(_quoted, KINDS))}], kind)"
_SPAN = "kind || ':' || start || ':' || \"end\""

SQL["op10_secret_scan"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({' UNION ALL '.join(_kind(k) for k in (*KINDS, 'break'))}),
a AS (
  SELECT *, sum(gap + span) OVER (PARTITION BY row_id, kind ORDER BY no) AS "end" FROM m),
b AS (
  SELECT row_id, kind, counts, ("end" - span)::BIGINT AS start, "end"::BIGINT AS "end", count(*) FILTER (kind = 'break') OVER (
           PARTITION BY row_id ORDER BY "end" - span) AS scope FROM a),
c AS (
  SELECT *, coalesce(max(CASE WHEN kind IN ({_BASE}) THEN "end" END) OVER behind, -1) <= start
         AND coalesce(min(CASE WHEN kind IN ({_BASE}) THEN start END) OVER ahead >= "end", true) AS free
  FROM b WHERE counts AND kind <> 'break'
  WINDOW behind AS (PARTITION BY row_id ORDER BY start RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY row_id ORDER BY start RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
e AS (
  SELECT *, {_LINKED} AS linked FROM c WHERE free OR kind IN ({_BASE})
  WINDOW near AS (PARTITION BY row_id, scope ORDER BY start RANGE BETWEEN 300 PRECEDING AND 300 FOLLOWING)),
f AS (
  SELECT row_id, {_COUNTS},
         string_agg({_SPAN}, ',' ORDER BY start, {_NUMBER}) FILTER (kind IN ({_BASE})) AS base,
         string_agg({_SPAN}, ',' ORDER BY start, {_NUMBER}) AS spans
  FROM e WHERE linked OR kind IN ({_BASE}) GROUP BY row_id)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0)::BIGINT AS n_{k}' for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN f USING (row_id)"""

SQL["op6_line_dedup"] = r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS no, unnest(parts) AS line FROM d),
s AS (
  SELECT *, list_sort(list_distinct(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+'))) AS words FROM l),
u AS (
  SELECT words, len(words) AS n, min((doc_id, no)) AS first FROM s WHERE len(words) > 0 GROUP BY words),
matched AS (
  SELECT DISTINCT b.words FROM u a JOIN u b ON a.first < b.first AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n
  WHERE len(list_intersect(a.words, b.words))::DOUBLE / (a.n + b.n - len(list_intersect(a.words, b.words))) >= 0.8::DOUBLE),
k AS (
  SELECT s.doc_id, s.no, s.line, len(s.words) > 0 AND ((s.doc_id, s.no) <> u.first OR m.words IS NOT NULL) AS gone
  FROM s LEFT JOIN u ON s.words = u.words LEFT JOIN matched m ON s.words = m.words),
r AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY no) FILTER (NOT coalesce(gone, false)) AS kept,
         count(*) FILTER (coalesce(gone, false)) AS removed
  FROM k GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.kept, '') END AS text,
       (CASE WHEN d.text IS NULL THEN 0 ELSE len(d.parts) END)::INTEGER AS n_lines,
       (CASE WHEN d.text IS NULL THEN 0 ELSE r.removed END)::INTEGER AS n_removed
FROM d JOIN r USING (doc_id)"""

SQL["op3_embedding_neardup"] = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v,
         sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(
        embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots ON vec_id = node LEFT JOIN counts ON a = vec_id"""

_MARKS = " ".join(f"WHEN '{role}' THEN {sum(map(len, marks))}" for role, marks in MARKS.items())

SQL["op13_chat_format"] = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (
  SELECT *, length(text) + len(regexp_extract_all(text, {_quoted(CONTROL)}))
         + CASE role {_MARKS} ELSE {len(OTHER + NAMED + OTHER_END)} + length(role)
           + len(regexp_extract_all(role, {_quoted(CONTROL)})) END AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, left(text, 64), md5(text))
         FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL["op12_collocations"] = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS pos FROM w),
g AS (SELECT lang, ws[pos:pos + m - 1] AS ph FROM i, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE pos + m - 1 <= len(ws)),
f AS (SELECT lang, ph, len(ph) AS m, count(*) AS f FROM g GROUP BY lang, ph HAVING count(*) >= 30),
t AS (SELECT lang, count(*) AS n FROM i GROUP BY lang),
c AS (
  SELECT a.lang, a.ph, a.f AS a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a.f) // (l.f::HUGEINT + r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) a
  JOIN f l ON l.lang = a.lang AND l.ph = a.ph[1:k] JOIN f r ON r.lang = a.lang AND r.ph = a.ph[k + 1:a.m]),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) AS cut FROM c),
b AS (
  SELECT lang, ph[x:y] AS ph, max(f) AS longer
  FROM (SELECT *, unnest(range(1, m)) AS x FROM f WHERE m > 2) q, (SELECT unnest([2, 3, 4]) AS y) e
  WHERE y > x AND y <= m AND y - x + 1 < m GROUP BY ALL),
o AS (
  SELECT s.lang, array_to_string(s.ph, ' ') AS phrase, a, l, r, score FROM s LEFT JOIN b ON b.lang = s.lang AND b.ph = s.ph
  WHERE cut = 1 AND (longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM z JOIN t USING (lang) WHERE rank <= 2000"""
