"""DuckDB oracles of the stored gold questions: whole results, gold as a CTE."""

from __future__ import annotations

from lotwright.plans.query import BOUNDED_LIMIT, QUESTIONS

from .gold import gold_ctes


def oracles() -> dict[str, str]:
    out = {}
    for name, sql in QUESTIONS.items():
        out[name] = (f"WITH {gold_ctes()}, listings_gold AS (SELECT * FROM gold)\n"
                     f"SELECT * FROM ({sql}) q")
    few, cut = "SELECT count(DISTINCT status) FROM gold", "SELECT count(*) FROM gold WHERE brand = 'Toyota'"
    rows = [("few_rows", few, False), ("cut", cut, False), ("empty", "0", False), ("refused", "0", True),
            ("unknown_column", "0", True), ("runtime_error", "0", True), ("recursive", "25", False)]
    parts = " UNION ALL ".join(f"SELECT '{n}' AS statement, CAST(({c}) AS BIGINT) AS row_count, {f} AS failed" for n, c, f in rows)
    out["bounded_results"] = (f"WITH {gold_ctes()}, r AS ({parts}) SELECT statement, least(row_count, {BOUNDED_LIMIT}) AS returned, "
                              f"row_count, row_count > {BOUNDED_LIMIT} AS truncated, failed FROM r")
    return out
