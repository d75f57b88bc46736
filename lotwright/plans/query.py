"""Guarded read-only query surface over the gold table (QRY-1, Q1..Q16).

``guarded_sql`` runs one statement the way the question-answering path does:
gate verdict (the same compiled gate as the audit job) -> a session of its own
that holds the allowed views and nothing else -> ``SELECT * FROM (<sql>) q``
(INSERT/CTAS forms cannot parse inside a subquery, so the surface is read-only)
-> bounded result with a ``truncated`` flag and the full ``row_count``, within a
time limit.  Parse, analysis and runtime errors and timeouts come back as data.
A recursive CTE runs through the same path, within a bound of rows and levels.

The gate's automatic LIMIT is for interactive statements; a stored question
(``answer``) returns its whole result.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..operators import audit as AU

# Fixed value: seconds that a statement may take.
QUERY_TIMEOUT = 10.0
# Rows and levels of a recursive CTE.
RECURSION_ROWS = 1_000_000
RECURSION_LEVELS = 1_000

# Escape routes of Spark that the gate does not know about (T32): quoted
# table names and JVM reflection functions.
_EXTRA_DENY = re.compile(r"(?i)(?:\bFROM\b|\bJOIN\b|,)\s*[`\"]|\b(?:reflect|java_method|try_reflect)\s*\(")


@dataclass
class GuardedResult:
    passed: bool
    reason: str | None
    sql: str
    df: DataFrame | None = None
    error: str | None = None


def gate_one(spark: SparkSession, sql: str, allowed_tables: list[str] | None = None,
             max_limit: int = AU.DEFAULT_MAX_LIMIT) -> tuple[bool, str | None, str]:
    """Verdict for a single statement with the audit job's compiled gate
    (a one-row local relation; the single result row is the only collect)."""
    one = spark.createDataFrame([(sql,)], "sql_text string")
    r = AU.sql_gate(one, "sql_text", allowed_tables, max_limit).select(
        "passed", "reason", "cleaned_sql").first()
    return bool(r["passed"]), r["reason"], r["cleaned_sql"]


def _names_a_database(spark: SparkSession, sql: str) -> bool:
    """Whether the statement names a catalog or database, so that it could
    reach tables besides the allowed views."""
    names = {"global_temp", *(c.name for c in spark.catalog.listCatalogs()),
             *(d.name for d in spark.catalog.listDatabases())}
    return any(re.search(rf"(?i)\b{re.escape(n)}\s*\.", sql) for n in names)


def _private_session(spark: SparkSession, views: dict[str, DataFrame]) -> SparkSession:
    """A session that shares the context but not the caller's views."""
    own = spark.newSession()
    own.conf.set("spark.sql.runSQLOnFiles", "false")
    own.conf.set("spark.sql.cteRecursionRowLimit", str(RECURSION_ROWS))
    own.conf.set("spark.sql.cteRecursionLevelLimit", str(RECURSION_LEVELS))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for name, df in views.items():
        handover = f"handover_{uuid.uuid4().hex}"
        df.createGlobalTempView(handover)
        own.table(f"global_temp.{handover}").createOrReplaceTempView(name)
        spark.catalog.dropGlobalTempView(handover)
    return own


def guarded_sql(spark: SparkSession, sql: str, views: dict[str, DataFrame],
                max_limit: int = AU.DEFAULT_MAX_LIMIT, whole: bool = False) -> GuardedResult:
    """QRY-1: gate, then run on the allowed views only.

    ``whole`` runs the statement as it was given, without the gate's LIMIT."""
    passed, reason, cleaned = gate_one(spark, sql, list(views), max_limit)
    if passed and _EXTRA_DENY.search(cleaned):
        passed, reason = False, "Quoted table names and reflection functions are not allowed"
    if passed and _names_a_database(spark, cleaned):
        passed, reason = False, "Database names are not allowed"
    if not passed:
        return GuardedResult(False, reason, cleaned)
    try:
        own = _private_session(spark, views)
        # Names that no view of this session has may still be tables of the catalog.
        stored = [t.name for t in own.catalog.listTables() if not t.isTemporary]
        if any(re.search(rf"(?i)\b{re.escape(t)}\b", cleaned) for t in stored):
            return GuardedResult(False, "Stored tables are not allowed", cleaned)
        df = own.sql(f"SELECT * FROM ({sql.strip().rstrip(';') if whole else cleaned}) q")
        df.schema  # analysis errors surface here
        return GuardedResult(True, None, cleaned, df)
    except PySparkException as e:
        return GuardedResult(True, None, cleaned, None, f"{type(e).__name__}: {e}")


@contextmanager
def time_limit(spark: SparkSession, seconds: float) -> Iterator[threading.Event]:
    """Tag what this thread runs and interrupt that tag's jobs after ``seconds``.

    Other jobs of the session and the context go on.  The event tells whether
    the time was up; interrupting goes on until the block is left, as a job
    may follow the one that was interrupted."""
    sc, tag = spark.sparkContext, f"guarded_{uuid.uuid4().hex}"
    left, up = threading.Event(), threading.Event()

    def watch() -> None:
        if left.wait(seconds):
            return
        up.set()
        while not left.is_set():
            sc.cancelJobsWithTag(tag)
            left.wait(0.2)

    sc.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield up
    finally:
        left.set()
        watcher.join()
        sc.removeJobTag(tag)


def bounded_rows(res: GuardedResult, max_limit: int = AU.DEFAULT_MAX_LIMIT,
                 with_count: bool = True, timeout: float = QUERY_TIMEOUT) -> dict:
    """TOP-7: at most ``max_limit`` rows, a ``truncated`` flag from fetching one
    more, and the ``row_count`` before the cut (a count of its own, only when
    the result was cut; without ``with_count`` it is then NULL).  A statement
    that takes longer than ``timeout`` seconds is interrupted and is an error."""
    failed = {"rows": [], "columns": [], "row_count": 0, "truncated": False}
    if res.df is None:
        return {**failed, "error": res.error or res.reason}
    with time_limit(res.df.sparkSession, timeout) as up:
        try:
            rows = res.df.limit(max_limit + 1).collect()            # bounded by max_limit + 1
            truncated = len(rows) > max_limit
            count = len(rows) if not truncated else res.df.count() if with_count else None
        except Exception as e:  # noqa: BLE001 - what fails in a statement is data
            if up.is_set():
                return {**failed, "error": f"Query timed out after {timeout}s"}
            if not isinstance(e, (PySparkException, Py4JJavaError)):      # some failures of jobs stay Java's
                raise
            return {**failed, "error": f"{type(e).__name__}: {e}"}
    return {"rows": rows[:max_limit], "columns": res.df.columns, "row_count": count,
            "truncated": truncated, "error": None}


GOLD_VIEW = AU.DEFAULT_ALLOWED_TABLE

# Questions of the gold query surface (Q1..Q16) as SQL over the gold view.
QUESTIONS: dict[str, str] = {
    "q01_count_toyota": "SELECT COUNT(*) AS n FROM listings_gold WHERE brand = 'Toyota'",
    "q02_avg_price_bmw": "SELECT ROUND(AVG(price), 2) AS avg_price FROM listings_gold WHERE brand = 'BMW'",
    "q03_electric_suv_under_100k": ("SELECT COUNT(*) AS n FROM listings_gold WHERE fuel_type = 'Electric' "
                                    "AND vehicle_type = 'SUV' AND price < 100000"),
    "q04_ferrari_stationwagon": ("SELECT listing_id, car_name, price FROM listings_gold "
                                 "WHERE brand = 'Ferrari' AND vehicle_type = 'Stationwagon'"),
    "q05_depreciation_suv_sedan": ("SELECT vehicle_type, ROUND(AVG(depreciation), 2) AS avg_depreciation "
                                   "FROM listings_gold WHERE vehicle_type IN ('SUV', 'Sedan') "
                                   "GROUP BY vehicle_type"),
    "q06_cheapest_five": ("SELECT listing_id, car_name, price FROM listings_gold WHERE status = 'Available' "
                          "AND price IS NOT NULL ORDER BY price, listing_id LIMIT 5"),
    "q07_like_corolla": "SELECT COUNT(*) AS n FROM listings_gold WHERE car_name ILIKE '%corolla%'",
    "q08_mileage_missing": "SELECT COUNT(*) AS n FROM listings_gold WHERE mileage_km IS NULL",
    "q09_count_honda": "SELECT COUNT(*) AS n FROM listings_gold WHERE brand = 'Honda'",
    "q10_top_fuel": ("SELECT fuel_type, COUNT(*) AS n FROM listings_gold WHERE fuel_type IS NOT NULL "
                     "GROUP BY fuel_type ORDER BY n DESC, fuel_type LIMIT 1"),
    "q10_top_brand": ("SELECT brand, COUNT(*) AS n FROM listings_gold GROUP BY brand "
                      "ORDER BY n DESC, brand LIMIT 1"),
    "q10_count_mercedes": "SELECT COUNT(*) AS n FROM listings_gold WHERE brand = 'Mercedes-Benz'",
    "q11_avg_price": "SELECT ROUND(AVG(price), 2) AS avg_price FROM listings_gold",
    "q12_coe_expiring": "SELECT COUNT(*) AS n FROM listings_gold WHERE coe_remaining_months < 24",
    "q12_below_paper_value": "SELECT COUNT(*) AS n FROM listings_gold WHERE price < dereg_value",
    "q12_recent_models": "SELECT COUNT(*) AS n FROM listings_gold WHERE manufactured >= 2023",
    "q12_ratio_bands": ("SELECT CASE WHEN price_to_omv_ratio < 1 THEN 'under_1' "
                        "WHEN price_to_omv_ratio <= 2 THEN '1_to_2' WHEN price_to_omv_ratio <= 5 "
                        "THEN '2_to_5' ELSE 'over_5' END AS band, COUNT(*) AS n FROM listings_gold "
                        "WHERE price_to_omv_ratio IS NOT NULL GROUP BY 1"),
    "q13_median_price": "SELECT MEDIAN(price) AS median_price FROM listings_gold",
    "q14_cte_brands": ("WITH by_brand AS (SELECT brand, COUNT(*) AS n FROM listings_gold GROUP BY brand) "
                       "SELECT brand, n FROM by_brand WHERE n > 100 ORDER BY n DESC, brand"),
    # A recursive walk over the price bands, so that a band without listings shows too.
    "q14_recursive_price_bands": (
        "WITH RECURSIVE bands AS (SELECT 0 AS low UNION ALL SELECT low + 50000 AS low FROM bands WHERE low < 950000) "
        "SELECT b.low, COALESCE(c.n, 0) AS n FROM bands b LEFT JOIN (SELECT CAST(FLOOR(price / 50000) AS INT) * 50000 AS low, "
        "COUNT(*) AS n FROM listings_gold WHERE price >= 0 GROUP BY 1) c ON c.low = b.low"),
    "q15_top_models": ("SELECT brand AS b, model AS m, MAX(price) AS top_price FROM listings_gold "
                       "WHERE status = 'Available' GROUP BY brand, model "
                       "ORDER BY top_price DESC, b, m LIMIT 20"),
    "q16_status_counts": "SELECT status, COUNT(*) AS n FROM listings_gold GROUP BY status",
    "q17_top3_price_per_brand": ("SELECT brand, listing_id, price, r FROM (SELECT brand, listing_id, price, "
                                 "CAST(RANK() OVER (PARTITION BY brand ORDER BY price DESC, listing_id) AS BIGINT) AS r "
                                 "FROM listings_gold WHERE status = 'Available' AND price IS NOT NULL) t "
                                 "WHERE r <= 3 ORDER BY brand, r, listing_id"),
    "q18_below_half_brand_avg": ("SELECT g.listing_id, g.brand, g.price, ROUND(a.avg_price, 2) AS avg_price "
                                 "FROM listings_gold g JOIN (SELECT brand, AVG(price) AS avg_price "
                                 "FROM listings_gold GROUP BY brand) a ON g.brand = a.brand "
                                 "WHERE g.price < a.avg_price * 0.5 ORDER BY g.listing_id LIMIT 50"),
}


def answer(spark: SparkSession, gold: DataFrame, name: str) -> DataFrame:
    """The whole result of a stored question through the guarded surface (an
    error raises, since stored questions must be valid)."""
    res = guarded_sql(spark, QUESTIONS[name], {GOLD_VIEW: gold}, whole=True)
    if res.df is None:
        raise ValueError(f"{name}: {res.reason or res.error}")
    return res.df


# Statements with results of every kind: whole, cut, empty, refused, not analysable, failing at run time.
BOUNDED_LIMIT = 20
BOUNDED_STATEMENTS: dict[str, str] = {
    "few_rows": "SELECT DISTINCT status FROM listings_gold",
    "cut": "SELECT listing_id FROM listings_gold WHERE brand = 'Toyota'",
    "empty": "SELECT listing_id FROM listings_gold WHERE price < 0 AND price > 0",
    "refused": "DROP TABLE listings_gold",
    "unknown_column": "SELECT no_such_column FROM listings_gold",
    "runtime_error": "SELECT CAST(brand AS INT) FROM listings_gold",
    "recursive": ("WITH RECURSIVE n AS (SELECT 1 AS x UNION ALL SELECT x + 1 AS x FROM n WHERE x < 25) SELECT x FROM n"),
}


def bounded_report(spark: SparkSession, gold: DataFrame) -> DataFrame:
    """(statement, returned, row_count, truncated, failed) of BOUNDED_STATEMENTS over gold."""
    rows = []
    for name, sql in BOUNDED_STATEMENTS.items():
        res = guarded_sql(spark, sql, {GOLD_VIEW: gold}, whole=True)
        out = bounded_rows(res, BOUNDED_LIMIT, timeout=600)
        rows.append((name, len(out["rows"]), out["row_count"], out["truncated"], out["error"] is not None))
    return spark.createDataFrame(rows, "statement string, returned long, row_count long, truncated boolean, failed boolean")
