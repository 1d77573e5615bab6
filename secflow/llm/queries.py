"""Registered queries of the subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from secflow.llm import line_rules as rules

_QUERIES = {
    "op1_language_id": "secflow.llm.language_id",
    "op2_suffix_dedup": "secflow.llm.suffix_dedup",
    "op3_nearest": "secflow.llm.hnsw",
    "op4_url_filter": "secflow.llm.url_rules",
    "op5_license_scan": "secflow.llm.licenses",
    "op6_main_text": "secflow.llm.html_extract",
    "op7_near_duplicates": "secflow.llm.near_dup",
    "op8_best_fit_packing": "secflow.llm.packing",
    "op9_bpe_round_trip": "secflow.llm.bpe",
    "op10_exact_topk": "secflow.llm.mtree",
    "op11_line_rules": "secflow.llm.line_rules",
    "op12_conversation_repair": "secflow.llm.turns",
    "op13_merkle_manifest": "secflow.llm.merkle",
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLES: dict[str, str] = {
    "op4_url_filter": f"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
tokens AS (
  SELECT *, CASE WHEN host = '' THEN [] ELSE list_distinct(list_concat(
      list_transform(range(1, len(string_split(host, '.')) + 1),
                     lambda i: 'domain=' || array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(regexp_split_to_array(host, '[.-]'), lambda x: 'host=' || x),
      list_transform(list_filter(regexp_split_to_array(lower(path), '[^\\p{{L}}]+'), lambda x: x <> ''),
                     lambda x: 'path=' || x),
      list_transform(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> ''),
                     lambda x: 'query=' || regexp_extract(x, '^([^=]*)', 1)),
      CASE WHEN contains(rest, '#') THEN ['fragment'] ELSE [] END)) END AS t
  FROM split),
subsets AS (
  SELECT t, list_sort(list_filter(t, lambda x, i: (mask >> (i - 1)) & 1 = 1)) AS x
  FROM (SELECT t, unnest(range(1, 1 << len(t))) AS mask FROM (SELECT DISTINCT t FROM tokens WHERE len(t) > 0))),
labelled AS (
  SELECT k.t, (l.toxic = 1 OR l.quality = 0) AS blocked
  FROM tokens k JOIN labels l
    ON l.doc_id = TRY_CAST(NULLIF(regexp_extract(url, '://[^/?#]*/[^?#]*?([0-9]+)', 1), '') AS BIGINT)
  WHERE l.toxic = 1 OR l.quality = 0 OR (l.toxic IS NOT NULL AND l.quality IS NOT NULL)),
rules AS (
  SELECT x FROM labelled JOIN subsets USING (t) GROUP BY x
  HAVING COUNT(*) FILTER (WHERE blocked) >= GREATEST(10, CEIL(0.01 * (SELECT COUNT(*) FROM labelled)))
     AND COUNT(*) FILTER (WHERE blocked) >= 0.5 * COUNT(*)),
mined AS (SELECT DISTINCT t FROM subsets WHERE x IN (SELECT x FROM rules)),
listed AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    t IN (SELECT t FROM mined) AS mined
  FROM tokens)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN mined THEN 'block' ELSE 'allow' END AS verdict, mined
FROM listed""",
    "op7_near_duplicates": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(COALESCE(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, COUNT(*) AS common
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (na + nb - common)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, LEAST(s.doc_id, COALESCE(MIN(r.b), s.doc_id)) AS component_id,
       s.doc_id = LEAST(s.doc_id, COALESCE(MIN(r.b), s.doc_id)) AS kept
FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.s)""",
    "op10_exact_topk": """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
}


def _quoted(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(col: str) -> str:
    return f"list_filter(regexp_split_to_array({col}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


ORACLES["op11_line_rules"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS t, {_words("COALESCE(text, '')")} AS w FROM documents),
windows AS (
  SELECT r, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS x,
         unnest(range(1, len(w) - 6)) AS i
  FROM docs WHERE len(w) >= 8),
twice AS (SELECT r, unnest(list(i)) AS i FROM windows GROUP BY r, x HAVING COUNT(*) > 1),
covered AS (SELECT r, COUNT(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
lines AS (
  SELECT *, {_words("line")} AS w FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
judged AS (
  SELECT r, line, len(w) AS n,
         right(rtrim(line, {_BLANKS} || {_quoted([rules.CLOSING])[1:-1]}), 1) NOT IN {_quoted(rules.SENTENCE_MARKS)}
         OR 100 * len(list_filter(w, lambda x: right(x, 2) IN {_quoted(rules.SHOUTS)})) > {rules.MAX_SHOUTS} * len(w)
         OR 100 * length(regexp_replace(line, '[^{rules.SYMBOLS}]+', '', 'g')) > {rules.MAX_SYMBOLS} * len(w)
         OR (len(list_filter(w, lambda x: x IN {_quoted(rules.SEPARATORS)})) >= 2
             AND 100 * len(list_filter(w, lambda x: x IN {_quoted(rules.SEPARATORS)}))
                 >= {rules.MIN_SEPARATORS} * len(w))
         OR (length(line) < {rules.MAX_CONTROL}
             AND lower(trim(line, {_BLANKS} || '.:!?')) IN {_quoted(rules.CONTROLS)})
         OR len(list_filter([{_quoted(rules.PHRASES)[1:-1]}], lambda p: contains(lower(line), p))) > 0 AS fails
  FROM lines),
texts AS (
  SELECT r, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines, COALESCE(SUM(n) FILTER (WHERE NOT fails), 0) AS words_kept
  FROM judged GROUP BY r),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^{rules.SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(COALESCE(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(COALESCE(words_kept, 0) AS BIGINT) AS words_kept
  FROM docs LEFT JOIN texts USING (r) LEFT JOIN covered c USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND 100 * words_kept >= {rules.MIN_KEPT} * n_words AS kept
FROM counted"""

_LEVELS = 6     # 16 ** 6 rows of a source; the stored form has no such limit


def _field(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN '-' ELSE strlen(CAST({col} AS VARCHAR)) || ':' || {col} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _climb(name: str, start: str) -> str:
    """CTEs of the levels of the trees over ``start`` (key, pos, h): runs of siblings, then their parents."""
    out, nodes = [], start
    for k in range(_LEVELS):
        out.append(f"""{name}_run{k} AS (
  SELECT key, pos // 16 AS run, list(h ORDER BY pos) AS l, any_value(total) = 1 AS alone
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY key) AS total FROM {nodes}) GROUP BY key, pos // 16),
{name}_up{k} AS (SELECT key, run AS pos, CASE WHEN alone THEN l[1] ELSE sha256(array_to_string(l, '')) END AS h
  FROM {name}_run{k})""")
        nodes = f"{name}_up{k}"
    return ",\n".join(out)


def _walk(name: str, start: str) -> str:
    """CTEs that take rows (r, key, p, cur, proof) of ``start`` up the levels of the tree ``name``."""
    out, rows = [], start
    for k in range(_LEVELS):
        out.append(f"""{name}_walk{k} AS (
  SELECT w.r, w.key, w.p // 16 AS p,
         CASE WHEN alone THEN cur
              ELSE sha256(array_to_string(list_concat(l[:w.p % 16], [cur], l[w.p % 16 + 2:]), '')) END AS cur,
         CASE WHEN alone THEN proof
              ELSE proof || array_to_string(list_concat(l[:w.p % 16], l[w.p % 16 + 2:]), '') END AS proof
  FROM {rows} w JOIN {name}_run{k} t ON t.key = w.key AND t.run = w.p // 16)""")
        rows = f"{name}_walk{k}"
    return ",\n".join(out)


_CRC32 = """xor(list_reduce(list_concat([4294967295], list_transform(string_split({}, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
                             lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""

ORACLES["op13_merkle_manifest"] = f"""
WITH leaves AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE('s' || source, '') AS key, {_leaf('text')} AS h,
         CASE WHEN doc_id IS NOT NULL AND {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} ELSE {_leaf('text')} END AS cur
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves),
{_climb("own", "placed")},
subroots AS (SELECT key AS name, '' AS key, row_number() OVER (ORDER BY key) - 1 AS pos, h
             FROM own_up{_LEVELS - 1}),
{_climb("top", "subroots")},
first_rows AS (SELECT r, key, pos AS p, cur, '' AS proof FROM placed),
{_walk("own", "first_rows")},
second_rows AS (SELECT w.r, '' AS key, s.pos AS p, w.cur, w.proof
                FROM own_walk{_LEVELS - 1} w JOIN subroots s ON s.name = w.key),
{_walk("top", "second_rows")}
SELECT d.doc_id, d.h AS leaf, s.h AS subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.cur AS folded_root,
       w.cur = t.h AS verified
FROM placed d JOIN subroots s ON s.name = d.key JOIN top_walk{_LEVELS - 1} w ON w.r = d.r
CROSS JOIN top_up{_LEVELS - 1} t"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(importlib.import_module(module), name) for name, module in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
