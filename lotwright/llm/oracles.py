"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

from . import line_dedup as D
from . import quality_rules as Q

_WORD = r"[^\x20\x09-\x0D]+"


def quality_ctes(source: str) -> str:
    """CTEs ending in ``quality_verdict`` over a relation with doc_id, text, lang."""
    hits = ", ".join(f"len(list_filter(ws, lambda w: w = '{w}'))" for w in Q.COMMON_WORDS)
    listed = ", ".join(f"'{w}'" for w in Q.COMMON_WORDS)
    n_bins = len(Q.COMMON_WORDS) + 1
    js = ("sqrt(greatest(list_sum(list_transform(range(1, {n} + 1), lambda i: "
          "CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + "
          "CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)) / 2, 0))")

    def distance(counts, ref, n):
        return js.format(n=n, p=f"({counts}[i] / greatest(list_sum({counts}), 1))",
                         q=f"({ref}[i] / greatest(list_sum({ref}), 1))")

    return rf"""
quality_in AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM {source}),
quality_words AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws FROM quality_in),
quality_windows AS (
  SELECT rid, i, ws[i] || chr(1) || ws[i + 1] || chr(1) || ws[i + 2] AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM quality_words WHERE len(ws) >= 3)),
quality_again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM quality_windows) WHERE c >= 2),
quality_repeat AS (
  SELECT rid, count(DISTINCT i + d) AS n FROM quality_again, (VALUES (0), (1), (2)) v(d) GROUP BY rid),
quality_lines AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM quality_in)
  WHERE regexp_matches(l, '{_WORD}') GROUP BY rid),
quality_counts AS (
  SELECT w.rid, w.doc_id, w.lang, len(ws) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    length(regexp_replace(t, '{Q.NOT_PUNCTUATION.replace(chr(92) * 2, chr(92))}', '', 'g')) AS c_punct,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS c_upper,
    length(regexp_replace(t, '[^0-9]+', '', 'g')) AS c_digit,
    length(regexp_replace(t, '[\x00-\x7F]+', '', 'g')) AS c_wide,
    len(list_filter(ws, lambda w: w IN ({listed}))) AS n_common,
    [{hits}] AS h
  FROM quality_words w LEFT JOIN quality_lines l USING (rid) LEFT JOIN quality_repeat r USING (rid)),
quality_base AS (
  SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    [c_upper, c_digit, n_symbols, c_wide, c_punct,
     word_chars - c_upper - c_digit - n_symbols - c_wide - c_punct] AS chars,
    list_append(h, n_words - n_common) AS hits
  FROM quality_counts),
quality_ref AS (
  SELECT lang, [{", ".join(f"sum(chars[{i + 1}])" for i in range(6))}] AS r_chars,
    [{", ".join(f"sum(hits[{i + 1}])" for i in range(n_bins))}] AS r_hits
  FROM quality_base WHERE NOT base_failed GROUP BY lang HAVING count(*) >= {Q.MIN_REFERENCE_DOCS}),
quality_distance AS (
  SELECT b.*,
    CASE WHEN r.lang IS NULL OR word_chars < {Q.MIN_CHARS} THEN 0 ELSE {distance("chars", "r_chars", 6)} END AS char_distance,
    CASE WHEN r.lang IS NULL OR n_words < {Q.MIN_HISTOGRAM_WORDS} THEN 0 ELSE {distance("hits", "r_hits", n_bins)} END AS word_distance
  FROM quality_base b LEFT JOIN quality_ref r ON b.lang = r.lang),
quality_verdict AS (
  SELECT *, NOT base_failed AND char_distance <= {Q.MAX_CHAR_DISTANCE} AND word_distance <= least({Q.SHORT_WORD_DISTANCE}::DOUBLE,
      greatest({Q.LONG_WORD_DISTANCE}::DOUBLE, {Q.WORD_SPREAD}::DOUBLE / sqrt(greatest(n_words, 1)))) AS kept
  FROM quality_distance)"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR = rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) >= 2 THEN
    list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) ELSE ws END AS s FROM w),
sh AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, b.v FROM reach r JOIN both_ways b ON b.u = r.seen)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept
FROM sets s JOIN (SELECT doc_id, min(seen) AS c FROM reach GROUP BY doc_id) m USING (doc_id)"""

# A line's place is doc_id * 10^6 + line number, which orders the test tables' lines.
LINES = rf"""WITH l0 AS (
  SELECT doc_id, string_split({_LOWER}, chr(10)) AS ls FROM documents),
l1 AS (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM l0),
l AS (SELECT doc_id, i, doc_id * 1000000 + i AS place, regexp_extract_all(line, '{_WORD}') AS w FROM l1),
d AS (SELECT w, min(place) AS place, len(any_value(w)) AS n FROM l WHERE len(w) >= {D.MIN_WORDS} GROUP BY w),
v AS (SELECT place, n, p, w[1:p - 1] AS a, w[p + 1:] AS b FROM (
  SELECT *, unnest(range(1, n + 1)) AS p FROM d WHERE n >= {D.MIN_NEAR_WORDS})),
sub AS (SELECT place, min(place) OVER (PARTITION BY n, p, a, b) AS earliest FROM v),
ins AS (SELECT v.place AS longer, d.place AS shorter FROM v JOIN d ON d.w = list_concat(v.a, v.b) AND d.n >= {D.MIN_NEAR_WORDS}),
near AS (
  SELECT place FROM sub WHERE earliest < place UNION SELECT longer FROM ins WHERE shorter < longer
  UNION SELECT shorter FROM ins WHERE longer < shorter),
gone AS (
  SELECT l.doc_id, l.i FROM l JOIN d ON d.w = l.w WHERE l.place > d.place OR d.place IN (SELECT place FROM near))
SELECT l0.doc_id, len(ls)::BIGINT AS n_lines, coalesce(g.n, 0)::BIGINT AS n_removed, coalesce(g.r, '') AS removed
FROM l0 LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS r FROM gone GROUP BY doc_id) g USING (doc_id)"""


ORACLE = {
    "op4_near_dedup": NEAR,
    "op9_line_dedup": LINES,
    "op3_quality_rules": f"""WITH {quality_ctes("documents")}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, kept,
  round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance
FROM quality_verdict""",
    "op6_topk_search": """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
