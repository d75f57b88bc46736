"""DuckDB oracles of the gate audit and model-log jobs."""

from __future__ import annotations

from lotwright.operators import audit as AU

from .gold import trim_ws
from .views import attempts_sql, q, responses_sql, reviews_sql, sql_texts_sql, trace_steps_sql


def gate_cte() -> str:
    dangerous = " ".join(
        f"WHEN regexp_matches(work, {q('(?i)' + p)}) THEN {q('Dangerous pattern detected: ' + p)}"
        for p in AU.DANGEROUS_PATTERNS)
    allowed = "[" + q(AU.DEFAULT_ALLOWED_TABLE) + "]"
    return f"""texts AS ({sql_texts_sql()}),
g1 AS (SELECT *, {trim_ws('sql_text')} AS stripped FROM texts),
g2 AS (SELECT *, {trim_ws(f"regexp_replace(stripped, {q(AU.COMMENT_REGEX)}, '', 'g')")} AS nc FROM g1),
g3 AS (SELECT *, regexp_replace(regexp_replace(nc, ';+$', ''), '\\s+$', '') AS work FROM g2),
g4 AS (SELECT *, upper(regexp_extract(work, '^\\s*(\\S+)', 1)) AS first_word,
  list_sort(list_filter(list_distinct(list_transform(regexp_extract_all(work, {q(AU.TABLE_REGEX)}, 1), lambda x: lower(x))),
    lambda x: NOT list_contains(list_concat({allowed}, list_transform(regexp_extract_all(work, {q(AU.CTE_ALIAS_REGEX)}, 1), lambda y: lower(y))), x))) AS bad,
  regexp_extract(work, {q(AU.LIMIT_REGEX)}, 1) AS lim FROM g3),
gate AS (SELECT query_id,
  CASE WHEN stripped = '' THEN 'Empty SQL'
       WHEN nc = '' THEN 'Comment-only SQL'
       WHEN contains(work, ';') THEN 'Multiple statements are not allowed (semicolon found)'
       {dangerous}
       WHEN first_word NOT IN ('SELECT', 'WITH') THEN 'Statement type not allowed: ' || first_word
       WHEN len(bad) > 0 THEN 'Tables not allowed: [''' || array_to_string(bad, ''', ''') || ''']'
  END AS reason,
  CASE WHEN lim = '' THEN work || ' LIMIT {AU.DEFAULT_AUTO_LIMIT}'
       WHEN COALESCE(TRY_CAST(lim AS BIGINT) > {AU.DEFAULT_MAX_LIMIT}, true)
       THEN regexp_replace(work, {q(AU.FIRST_LIMIT_REGEX)}, '\\1LIMIT {AU.DEFAULT_MAX_LIMIT}')
       ELSE work END AS cleaned0
FROM g4)"""


def oracles() -> dict[str, str]:
    o = {}
    o["sql_audit"] = (f"WITH {gate_cte()}\nSELECT query_id, reason IS NULL AS passed, reason, "
                      "CASE WHEN reason IS NULL THEN cleaned0 ELSE '' END AS cleaned_sql FROM gate")
    o["sql_audit_summary"] = (
        f"WITH {gate_cte()}\nSELECT CASE WHEN reason IS NULL THEN 'passed' "
        "WHEN starts_with(reason, 'Dangerous pattern') THEN 'dangerous_pattern' "
        "WHEN starts_with(reason, 'Statement type') THEN 'statement_type' "
        "WHEN starts_with(reason, 'Tables not allowed') THEN 'table_not_allowed' "
        "WHEN starts_with(reason, 'Multiple statements') THEN 'stacked_statements' "
        "ELSE 'empty_or_comment' END AS reason_class, count(*) AS n FROM gate GROUP BY 1")
    blk, sel = q(AU.SQL_BLOCK_REGEX), q(AU.SELECT_TAIL_REGEX)
    raw = (f"CASE WHEN regexp_matches(text, {blk}) THEN {trim_ws(f'regexp_extract(text, {blk}, 1)')} "
           f"WHEN regexp_matches(text, {sel}) THEN {trim_ws(f'regexp_extract(text, {sel}, 1)')} END")
    o["sql_from_response"] = (f"WITH r AS ({responses_sql()})\nSELECT response_id, "
                              f"{trim_ws(f'regexp_replace({raw}, {q(';+$')}, {q('')})')} AS sql FROM r")
    rr = q(AU.REASON_REGEX)
    o["verdict_class"] = f"""WITH r AS ({reviews_sql()}),
p AS (SELECT response_id, upper(regexp_extract(text, {q(AU.VERDICT_REGEX)}, 1)) AS verdict,
  CASE WHEN regexp_matches(text, {rr}) THEN {trim_ws(f'regexp_extract(text, {rr}, 1)')}
       ELSE 'No reason provided' END AS reason FROM r)
SELECT response_id, COALESCE(verdict = 'APPROVED', false) AS approved,
  CASE WHEN verdict = '' THEN 'Could not parse reviewer verdict' ELSE reason END AS review_reason,
  CASE WHEN verdict = '' THEN 'correctness' WHEN verdict = 'APPROVED' THEN 'approved'
       WHEN regexp_matches(reason, {q(AU.SAFETY_WORDS_REGEX)}) THEN 'safety'
       WHEN regexp_matches(reason, {q(AU.VALIDITY_WORDS_REGEX)}) THEN 'validity'
       ELSE 'correctness' END AS category FROM p"""
    m = AU.MAX_ITERATIONS
    o["session_outcome"] = f"""WITH a AS ({attempts_sql()}),
l AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY
    generation_error IS NULL AND NOT (safety_passed AND approved) AND iteration < {m},
    CASE WHEN generation_error IS NULL AND NOT (safety_passed AND approved) AND iteration < {m}
         THEN -iteration ELSE iteration END) AS rn,
             count(*) OVER (PARTITION BY session) AS attempts FROM a)
SELECT session, iteration AS iterations, attempts,
  CASE WHEN generation_error IS NOT NULL THEN 'error'
       WHEN safety_passed AND approved THEN CASE WHEN exec_error IS NOT NULL THEN 'error' ELSE 'success' END
       WHEN iteration >= {m} THEN 'rejected' ELSE 'running' END AS status,
  CASE WHEN generation_error IS NOT NULL THEN generation_error
       WHEN safety_passed AND approved THEN exec_error
       WHEN iteration >= {m} THEN COALESCE(feedback, 'Max iterations reached') END AS error
FROM l WHERE rn = 1"""
    roll = ("count(*) AS steps, sum(duration_ms) AS total_duration_ms, "
            "CAST(sum(prompt_tokens) AS BIGINT) AS total_prompt_tokens, "
            "CAST(sum(completion_tokens) AS BIGINT) AS total_completion_tokens, "
            "CAST(sum(total_tokens) AS BIGINT) AS total_tokens, count(*) FILTER (WHERE status = 'error') AS errors")
    o["trace_rollup"] = f"WITH s AS ({trace_steps_sql()})\nSELECT trace_id, {roll} FROM s GROUP BY trace_id"
    o["trace_rollup_by_step"] = (f"WITH s AS ({trace_steps_sql()})\nSELECT trace_id, name, {roll} "
                                 "FROM s GROUP BY trace_id, name")
    return o


def usage_oracles() -> dict[str, str]:
    def get(k):
        return f"COALESCE(TRY_CAST(json_extract_string(usage_metadata, '$.{k}') AS BIGINT), 0)"
    return {"token_usage": (f"WITH s AS ({trace_steps_sql()})\nSELECT trace_id, step, "
                            f"{get('input_tokens')} AS prompt_tokens, {get('output_tokens')} AS completion_tokens, "
                            f"{get('total_tokens')} AS total_tokens FROM s")}
