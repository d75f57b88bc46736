"""SQL-gate audit and model-log jobs over tables of texts (GTE-*, LLM-*, AGG-9).

The gate's checks are string rules; here they are compiled into one staged
projection over a ``queries(query_id, sql_text)`` table, so millions of logged
statements are audited in parallel with no Python per row.  The verdict for a
text equals the per-statement gate: first failing check wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import per_application
from ..functions.names import strip_ws

# Gate configuration, keyword sets and patterns.
DEFAULT_ALLOWED_TABLE = "listings_gold"
DEFAULT_MAX_LIMIT = 1000
DEFAULT_AUTO_LIMIT = 100
DANGEROUS_PATTERNS = [
    r"\bPRAGMA\b",
    r"\bATTACH\b\s+\bDATABASE\b",
    r"\bLOAD\b[\s_]+EXTENSION\b",
    r"\bLOAD_EXTENSION\b",
    r"\bsqlite_master\b",
    r"\bsqlite_schema\b",
]
TABLE_REGEX = r"(?i)(?:\bFROM\b|\bJOIN\b)\s+([A-Za-z_][A-Za-z0-9_]*)"
CTE_ALIAS_REGEX = r"(?i)\b(\w+)\s+AS\s*\("
COMMENT_REGEX = r"(?s)--[^\n]*|/\*.*?\*/"
LIMIT_REGEX = r"(?i)\bLIMIT\s+(\d+)"
FIRST_LIMIT_REGEX = r"(?is)^(.*?)\bLIMIT\s+\d+"

SQL_BLOCK_REGEX = r"(?is)```sql\s*\n(.*?)```"
SELECT_TAIL_REGEX = r"(?is)(SELECT\b.*)"
VERDICT_REGEX = r"(?i)VERDICT:\s*(APPROVED|REJECTED)"
REASON_REGEX = r"(?is)REASON:\s*(.+)"
SAFETY_WORDS_REGEX = (r"(?i)\b(safety|mutation|mutat|write|dangerous|destructive|delete|drop|"
                      r"insert|update|alter|modification|modify)\b")
VALIDITY_WORDS_REGEX = (r"(?i)\b(column|table|syntax|invalid|does not exist|unknown|"
                        r"not found|unrecognized|misspell|typo)\b")
MAX_ITERATIONS = 3


def _rstrip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+$", "")


def sql_gate(df: DataFrame, sql_col: str = "sql_text",
             allowed_tables: list[str] | None = None,
             max_limit: int = DEFAULT_MAX_LIMIT) -> DataFrame:
    """GTE-1..7: add ``passed``, ``reason``, ``cleaned_sql`` for every text.

    Intermediate texts are staged as attributes (computed once each)."""
    allowed = tuple(t.lower() for t in (allowed_tables or [DEFAULT_ALLOWED_TABLE]))
    for name, col in _gate_stages(sql_col, allowed, max_limit):
        df = df.withColumn(name, col)
    return df.drop("_stripped", "_nc", "_work", "_first", "_bad_tables", "_limit")


@per_application
def _gate_stages(sql_col: str, allowed: tuple, max_limit: int) -> list[tuple[str, Column]]:
    c = F.col
    st = [("_stripped", strip_ws(c(sql_col))),
          ("_nc", strip_ws(F.regexp_replace(c("_stripped"), COMMENT_REGEX, ""))),
          ("_work", _rstrip_ws(F.regexp_replace(c("_nc"), ";+$", ""))),
          ("_first", F.upper(F.regexp_extract(c("_work"), r"^\s*(\S+)", 1)))]
    tables = F.array_distinct(F.transform(F.regexp_extract_all(c("_work"), F.lit(TABLE_REGEX), 1),
                                          F.lower))
    ctes = F.transform(F.regexp_extract_all(c("_work"), F.lit(CTE_ALIAS_REGEX), 1), F.lower)
    effective = F.array_union(F.array(*[F.lit(t) for t in allowed]), ctes)
    st += [("_bad_tables", F.array_sort(F.array_except(tables, effective))),
           ("_limit", F.regexp_extract(c("_work"), LIMIT_REGEX, 1))]
    dangerous = None
    for p in DANGEROUS_PATTERNS:
        hit = c("_work").rlike("(?i)" + p)
        msg = F.lit(f"Dangerous pattern detected: {p}")
        dangerous = F.when(hit, msg) if dangerous is None else dangerous.when(hit, msg)
    reason = (F.when(c(sql_col).isNull() | (c("_stripped") == ""), F.lit("Empty SQL"))
              .when(c("_nc") == "", F.lit("Comment-only SQL"))
              .when(c("_work").contains(";"),
                    F.lit("Multiple statements are not allowed (semicolon found)"))
              .otherwise(dangerous))
    stmt = F.when(~c("_first").isin("SELECT", "WITH"),
                  F.concat(F.lit("Statement type not allowed: "), c("_first")))
    tables_msg = F.when(F.size("_bad_tables") > 0, F.concat(
        F.lit("Tables not allowed: ['"), F.array_join("_bad_tables", "', '"), F.lit("']")))
    too_big = F.coalesce(F.when(c("_limit") != "", c("_limit").try_cast("bigint")) > max_limit,
                         F.lit(True))
    cleaned = (F.when(c("_limit") == "", F.concat(c("_work"), F.lit(f" LIMIT {DEFAULT_AUTO_LIMIT}")))
               .when(too_big, F.regexp_replace(c("_work"), FIRST_LIMIT_REGEX, f"$1LIMIT {max_limit}"))
               .otherwise(c("_work")))
    st += [("reason", F.coalesce(reason, stmt, tables_msg)),
           ("passed", c("reason").isNull()),
           ("cleaned_sql", F.when(c("passed"), cleaned).otherwise(F.lit("")))]
    return st


def reason_class(reason: Column) -> Column:
    """Audit bucket of a gate verdict (for ``groupBy(...).count()``)."""
    return (F.when(reason.isNull(), "passed")
            .when(reason.startswith("Dangerous pattern"), "dangerous_pattern")
            .when(reason.startswith("Statement type"), "statement_type")
            .when(reason.startswith("Tables not allowed"), "table_not_allowed")
            .when(reason.startswith("Multiple statements"), "stacked_statements")
            .otherwise("empty_or_comment"))


def extract_sql(text: Column) -> Column:
    """LLM-1: SQL from a model response: a fenced ``sql`` block, else the text
    from the first SELECT; trailing semicolons removed; none -> NULL."""
    block = strip_ws(F.regexp_extract(text, SQL_BLOCK_REGEX, 1))
    tail = strip_ws(F.regexp_extract(text, SELECT_TAIL_REGEX, 1))
    raw = F.when(text.rlike(SQL_BLOCK_REGEX), block).when(text.rlike(SELECT_TAIL_REGEX), tail)
    return strip_ws(F.regexp_replace(raw, ";+$", ""))


def classify_rejection(reason: Column) -> Column:
    """LLM-3: safety words, else validity words, else correctness."""
    return (F.when(reason.rlike(SAFETY_WORDS_REGEX), "safety")
            .when(reason.rlike(VALIDITY_WORDS_REGEX), "validity").otherwise("correctness"))


def parse_review(df: DataFrame, text_col: str = "text") -> DataFrame:
    """LLM-2: add ``approved``, ``review_reason``, ``category``."""
    c = F.col
    d = df.withColumn("_verdict", F.upper(F.regexp_extract(c(text_col), VERDICT_REGEX, 1)))
    d = d.withColumn("_reason", F.when(c(text_col).rlike(REASON_REGEX),
                                       strip_ws(F.regexp_extract(c(text_col), REASON_REGEX, 1)))
                     .otherwise(F.lit("No reason provided")))
    approved = c("_verdict") == "APPROVED"
    d = d.withColumn("approved", F.coalesce(approved, F.lit(False)))
    d = d.withColumn("review_reason", F.when(c("_verdict") == "", F.lit("Could not parse reviewer verdict"))
                     .otherwise(c("_reason")))
    d = d.withColumn("category", F.when(c("_verdict") == "", F.lit("correctness"))
                     .when(approved, F.lit("approved")).otherwise(classify_rejection(c("_reason"))))
    return d.drop("_verdict", "_reason")


def token_usage(usage_json: Column) -> Column:
    """LLM-4: struct(prompt_tokens, completion_tokens, total_tokens) from a
    JSON usage object; missing object or key -> 0."""
    def get(k):
        return F.coalesce(F.get_json_object(usage_json, f"$.{k}").try_cast("bigint"), F.lit(0))
    return F.struct(get("input_tokens").alias("prompt_tokens"),
                    get("output_tokens").alias("completion_tokens"),
                    get("total_tokens").alias("total_tokens"))


def session_outcome(attempts: DataFrame, max_iterations: int = MAX_ITERATIONS) -> DataFrame:
    """LLM-5: final status per session from its ordered attempts.

    The first terminal attempt decides: a generation error, an approved
    attempt that passed the gate (executed: ``success`` or ``error``), or the
    attempt that spends the iteration budget (``rejected``, error = its
    feedback).  Without one the session is still ``running``.  Both candidates
    are partial aggregates (no group is collected)."""
    c = F.col
    row = F.struct(*[c(x) for x in attempts.columns if x != "session"])
    ends = c("generation_error").isNotNull() | (c("safety_passed") & c("approved")) | (c("iteration") >= max_iterations)
    last = attempts.groupBy("session").agg(
        F.coalesce(F.min_by(row, F.when(ends, c("iteration"))), F.max_by(row, c("iteration"))).alias("a"),
        F.count(F.lit(1)).alias("attempts"))
    a = F.col
    status = (F.when(a("a.generation_error").isNotNull(), "error")
              .when(a("a.safety_passed") & a("a.approved"),
                    F.when(a("a.exec_error").isNotNull(), "error").otherwise("success"))
              .when(a("a.iteration") >= max_iterations, "rejected").otherwise("running"))
    error = (F.when(a("a.generation_error").isNotNull(), a("a.generation_error"))
             .when(a("a.safety_passed") & a("a.approved"), a("a.exec_error"))
             .when(a("a.iteration") >= max_iterations,
                   F.coalesce(a("a.feedback"), F.lit("Max iterations reached"))))
    return last.select("session", a("a.iteration").alias("iterations"), "attempts",
                       status.alias("status"), error.alias("error"))


def trace_rollup(steps: DataFrame, by_step: bool = False) -> DataFrame:
    """AGG-9: totals per trace (or per trace and step name): duration, tokens,
    step and error counts."""
    keys = ["trace_id", "name"] if by_step else ["trace_id"]
    return steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("steps"),
        F.sum("duration_ms").alias("total_duration_ms"),
        F.sum("prompt_tokens").alias("total_prompt_tokens"),
        F.sum("completion_tokens").alias("total_completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.count_if(F.col("status") == "error").alias("errors"))
