"""SQL gate verdicts and the guarded query surface."""

import pytest
from pyspark.sql import functions as F

from lotwright.operators import audit as AU
from lotwright.plans import query as QRY

CASES = [
    ("", False, "Empty SQL", None),
    ("   ", False, "Empty SQL", None),
    ("-- only a comment", False, "Comment-only SQL", None),
    ("/* a */ -- b", False, "Comment-only SQL", None),
    ("SELECT 1; DROP TABLE listings_gold", False,
     "Multiple statements are not allowed (semicolon found)", None),
    ("SELECT * FROM listings_gold;", True, None, "SELECT * FROM listings_gold LIMIT 100"),
    ("DROP TABLE listings_gold", False, "Statement type not allowed: DROP", None),
    ("delete from listings_gold", False, "Statement type not allowed: DELETE", None),
    ("EXPLAIN SELECT 1", False, "Statement type not allowed: EXPLAIN", None),
    ("PRAGMA table_info(x)", False, r"Dangerous pattern detected: \bPRAGMA\b", None),
    ("SELECT * FROM sqlite_master", False, r"Dangerous pattern detected: \bsqlite_master\b", None),
    ("SELECT * FROM users", False, "Tables not allowed: ['users']", None),
    ("SELECT * FROM b JOIN a ON 1=1 JOIN listings_gold ON 1=1", False, "Tables not allowed: ['a', 'b']", None),
    ("WITH x AS (SELECT * FROM listings_gold) SELECT * FROM x", True, None,
     "WITH x AS (SELECT * FROM listings_gold) SELECT * FROM x LIMIT 100"),
    ("SELECT * FROM listings_gold LIMIT 50", True, None, "SELECT * FROM listings_gold LIMIT 50"),
    ("SELECT * FROM listings_gold LIMIT 9999", True, None, "SELECT * FROM listings_gold LIMIT 1000"),
    ("SELECT * FROM listings_gold LIMIT 1000", True, None, "SELECT * FROM listings_gold LIMIT 1000"),
    ("SELECT * FROM listings_gold LIMIT 0", True, None, "SELECT * FROM listings_gold LIMIT 0"),
    ("SELECT 1", True, None, "SELECT 1 LIMIT 100"),
    ("select * from LISTINGS_GOLD limit 5", True, None, "select * from LISTINGS_GOLD limit 5"),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, sql_text string")
    g = AU.sql_gate(df)
    return {r["i"]: (r["passed"], r["reason"], r["cleaned_sql"]) for r in g.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_gate(verdicts, i):
    sql, passed, reason, cleaned = CASES[i]
    got = verdicts[i]
    assert got[0] == passed and got[1] == reason, sql
    if cleaned is not None:
        assert got[2] == cleaned


def test_extract_sql_and_review(spark):
    df = spark.createDataFrame([
        ("Here:\n```sql\nSELECT 1;\n```",), ("blah SELECT a FROM t;;",), ("nothing",)], "text string")
    got = [r[0] for r in df.select(AU.extract_sql(F.col("text"))).collect()]
    assert got == ["SELECT 1", "SELECT a FROM t", None]
    rv = spark.createDataFrame([("VERDICT: APPROVED\nREASON: ok",), ("verdict: rejected\nreason: would drop a table",),
                                ("VERDICT: REJECTED\nREASON: unknown column x",), ("no verdict",),
                                ("VERDICT: REJECTED",)], "text string")
    out = [(r["approved"], r["review_reason"], r["category"]) for r in AU.parse_review(rv).collect()]
    assert out == [(True, "ok", "approved"), (False, "would drop a table", "safety"),
                   (False, "unknown column x", "validity"),
                   (False, "Could not parse reviewer verdict", "correctness"),
                   (False, "No reason provided", "correctness")]


def test_guarded_surface(spark):
    gold = spark.createDataFrame([(i, f"n{i}", i * 10) for i in range(1, 6)],
                                 "listing_id long, name string, value long")
    ok = QRY.guarded_sql(spark, "SELECT * FROM listings_gold ORDER BY listing_id", {"listings_gold": gold},
                         max_limit=3)
    res = QRY.bounded_rows(ok, 3)
    assert res["truncated"] is True and len(res["rows"]) == 3 and res["row_count"] == 5
    whole = QRY.bounded_rows(QRY.guarded_sql(spark, "SELECT * FROM listings_gold", {"listings_gold": gold}), 3)
    assert whole["truncated"] is True and whole["row_count"] == 5 and len(whole["rows"]) == 3
    bad = QRY.guarded_sql(spark, "INSERT INTO listings_gold VALUES (1)", {"listings_gold": gold})
    assert not bad.passed and bad.reason == "Statement type not allowed: INSERT"
    missing = QRY.guarded_sql(spark, "SELECT nope FROM listings_gold", {"listings_gold": gold})
    assert missing.df is None and missing.error
    ref = QRY.guarded_sql(spark, "SELECT reflect('java.lang.System', 'exit', '0') FROM listings_gold",
                          {"listings_gold": gold})
    assert not ref.passed


def test_guarded_surface_is_closed(spark):
    gold = spark.createDataFrame([(1, 0)], "listing_id long, value long")
    spark.createDataFrame([("s",)], "secret string").createOrReplaceTempView("secret_tbl")
    spark.createDataFrame([("g",)], "secret string").createOrReplaceGlobalTempView("secret_global")
    views = {"listings_gold": gold}
    comma = QRY.guarded_sql(spark, "SELECT secret FROM listings_gold a, secret_tbl b", views)
    assert comma.df is None and (comma.error or comma.reason)
    other = QRY.guarded_sql(spark, "SELECT secret FROM listings_gold a, global_temp.secret_global b", views)
    assert other.df is None and other.reason == "Database names are not allowed"
    zero = QRY.bounded_rows(QRY.guarded_sql(spark, "SELECT 1 / value AS x FROM listings_gold", views))
    assert "DIVIDE_BY_ZERO" in zero["error"] and zero["rows"] == []
    gone = QRY.guarded_sql(spark, "SELECT * FROM nowhere", views)
    assert not gone.passed and "Tables not allowed" in gone.reason
    spark.createDataFrame([(7,)], "mine long").createOrReplaceTempView("listings_gold")
    QRY.guarded_sql(spark, "SELECT * FROM listings_gold", views)
    assert spark.table("listings_gold").columns == ["mine"]          # the caller's view is left alone
    for v in ("secret_tbl", "listings_gold"):
        spark.catalog.dropTempView(v)
    spark.catalog.dropGlobalTempView("secret_global")
