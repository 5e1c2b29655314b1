"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import quality

_GRAM = """
g{n} AS (
  SELECT doc_id, i, c, string_agg(w, ' ') OVER g AS gram, count(*) OVER g AS k
  FROM words WINDOW g AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {m} FOLLOWING)),
r{n} AS (
  SELECT doc_id, i, c, k = {n} AND row_number() OVER (PARTITION BY doc_id, k, gram ORDER BY i) > 1 AS later,
         k = {n} AND count(*) OVER (PARTITION BY doc_id, k, gram) > 1 AS twice
  FROM g{n}),
c{n} AS (
  SELECT doc_id, c, max({flag}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {m} PRECEDING AND CURRENT ROW) AS inside
  FROM r{n}),
s{n} AS (SELECT doc_id, sum({value}) FILTER (inside) AS v FROM c{n} GROUP BY doc_id)"""


def _quality_sql() -> str:
    base = quality.BASE_WINDOW
    grams = [_GRAM.format(n=base, m=base - 1, flag="twice", value="1")]
    grams += [_GRAM.format(n=n, m=n - 1, flag="later", value="c") for n in quality.NGRAM_LIMITS]
    joins = " ".join(f"LEFT JOIN s{n} ON s{n}.doc_id = d.doc_id" for n in (base, *quality.NGRAM_LIMITS))
    cover = " OR ".join(f"coalesce(s{n}.v, 0) > {share} * word_chars" for n, share in quality.NGRAM_LIMITS.items())
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
words AS (SELECT doc_id, w, length(w) AS c, i FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d)),
lines AS (
  SELECT doc_id, i, l AS l,
         list_sum([length(x) for x in regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')]) AS c
  FROM (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS l
        FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d))),
ranked AS (
  SELECT doc_id, c, row_number() OVER (PARTITION BY doc_id, l ORDER BY i) > 1 AS later FROM lines WHERE c > 0),
line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (later) AS n_dup_lines,
         coalesce(sum(c) FILTER (later), 0) AS dup_line_chars FROM ranked GROUP BY doc_id),
{",".join(grams)},
m AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(list_sum([length(x) for x in ws]), 0) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(s{base}.v, 0) AS n_repeat_words,
         coalesce(n_dup_lines, 0) > {quality.LINE_SHARE} * coalesce(n_lines, 0)
         OR coalesce(dup_line_chars, 0) > {quality.LINE_CHAR_SHARE} * word_chars OR {cover} AS repetitive
  FROM d LEFT JOIN line ON line.doc_id = d.doc_id {joins})
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words OR repetitive) AS kept
FROM m"""


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lists(table: str, key: str) -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}')"
    return f"SELECT {key}, {words} AS ws FROM {table}"


_BENCHMARK_SQL = f"""
WITH d AS ({_lists('documents', 'doc_id')}), b AS ({_lists('benchmark', 'item_id')}),
windows AS (
  SELECT DISTINCT item_id, n, list_slice(ws, i, i + n - 1) AS win
  FROM (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i
        FROM b WHERE len(ws) > 0)),
spots AS (
  SELECT doc_id, i, n, list_slice(ws, i, i + n - 1) AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)),
found AS (SELECT doc_id, i, s.n, item_id FROM spots s JOIN windows w ON s.win = w.win AND s.n = w.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""

SQL = {"op1_repetition_coverage": _quality_sql(), "op5_benchmark_hits": _BENCHMARK_SQL}
