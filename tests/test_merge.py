"""Merged tables, stored history, quarantine life, mixed schemas, discovery and the daily run."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lotwright.plans import pipelines as P
from lotwright.schemas import HISTORY, LISTINGS, QUARANTINE, RUN_EVENTS
from lotwright.sources import snapshots as SN

DAY = dt.datetime(2024, 1, 1)


def batch(spark, recs):
    return spark.createDataFrame([(k, p, s) for k, p, s in recs], "listing_id long, price long, status string")


def files(root, table):
    found = {}
    for folder, _, names in os.walk(os.path.join(root, table)):
        for n in names:
            if n.endswith(".parquet"):
                p = os.path.join(folder, n)
                found[p] = os.stat(p).st_mtime_ns
    return found


def test_a_batch_rewrites_its_key_ranges_only(spark):
    t = P.Tables(tempfile.mkdtemp(prefix="lotwright-merge-"), width=10)
    P.ingest_batch(spark, batch(spark, [(k, 100 + k, "Available") for k in range(1, 50)]), t, 1, DAY)
    before = {**files(t.root, t.listings), **files(t.root, t.history)}
    P.ingest_batch(spark, batch(spark, [(12, 7, "Reserved"), (71, 8, "Available")]), t, 2, DAY + dt.timedelta(days=1))
    after = {**files(t.root, t.listings), **files(t.root, t.history)}
    assert all(after[p] == when for p, when in before.items())             # nothing written again in place
    new = {p.split("range=")[1].split("/")[0] for p in after if p not in before}
    assert new == {"1", "7"}
    live = SN.state(spark, t.root)[1][t.listings]["live"]
    assert live == {"0": 1, "1": 2, "2": 1, "3": 1, "4": 1, "7": 2}
    rows = SN.read_table(spark, t.root, t.listings, LISTINGS)
    assert rows.count() == 50 and rows.where("listing_id = 12").first()["price"] == 7
    history = P.full_history(spark, t)
    assert history.count() == 51 and history.where("is_current").count() == 50
    plan = SN.read_table(spark, t.root, t.listings, LISTINGS, [1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "range#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_ranges_keep_their_width_and_nothing_else_is_replaced(spark):
    root = tempfile.mkdtemp(prefix="lotwright-width-")
    rows = SN.conform(batch(spark, [(1, 1, "x"), (25, 2, "x"), (-3, 3, "x")]), LISTINGS)
    step = SN.Commit(spark, root)
    step.merge(rows, "listings", "listing_id", 10, SN.touched_ranges(rows, "listing_id", 10))
    step.finish()
    assert SN.range_width(spark, root, "listings") == 10
    assert sorted(r["listing_id"] for r in SN.read_table(spark, root, "listings", LISTINGS).collect()) == [-3, 1, 25]
    with pytest.raises(ValueError):
        SN.Commit(spark, root).merge(rows, "listings", "listing_id", 20, [0])
    with pytest.raises(ValueError):
        SN.Commit(spark, root).merge(rows, "listings", "listing_id", 10, [0])
    gone = SN.Commit(spark, root)
    gone.merge(rows.where("false"), "listings", "listing_id", 10, [2])
    gone.finish()
    assert SN.read_table(spark, root, "listings", LISTINGS).count() == 2


def test_stored_history_prunes_months_and_keys(spark):
    t = P.Tables(tempfile.mkdtemp(prefix="lotwright-hist-"), width=10)
    rows = [(k, dt.datetime(2024, m, 5), dt.datetime(2024, m + 1, 5) if m < 6 else None, m == 6)
            for k in range(1, 40) for m in range(1, 7)]
    h = spark.createDataFrame(rows, "listing_id long, valid_from timestamp, valid_to timestamp, is_current boolean")
    P.store_history(spark, h, t)
    recent = P.recent_history(spark, t, dt.datetime(2024, 6, 6), hours=24 * 40)
    assert {r["valid_from"].month for r in recent.collect()} == {5, 6}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    one = P.key_history(spark, t, 25)
    assert [(r["version"], r["valid_from"].month) for r in one.collect()] == [(i, i) for i in range(1, 7)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(listing_id), EqualTo(listing_id,25)" in plan


def test_quarantine_ids_go_on_and_resolutions_fold(spark):
    t = P.Tables(tempfile.mkdtemp(prefix="lotwright-quar-"), width=10)
    P.ingest_batch(spark, batch(spark, [(1, -5, "Available"), (2, 5, "nonsense"), (None, 9, "Sold")]), t, 1, DAY)
    counts = P.ingest_batch(spark, batch(spark, [(3, -1, "bad")]), t, 2, DAY)
    assert counts["quarantined"] == 2
    rows = SN.read_appended(spark, t.root, t.quarantine, QUARANTINE).orderBy("quarantine_id").collect()
    assert [r["quarantine_id"] for r in rows] == [1, 2, 3, 4, 5]
    lost = [r for r in rows if r["rule_name"] == "missing_key"]
    assert len(lost) == 1 and '"price":9' in lost[0]["raw_record"]          # a row without a key is kept whole
    ids = spark.createDataFrame([(2,), (4,)], "quarantine_id long")
    P.resolve_quarantine(spark, t, ids, DAY)
    P.resolve_quarantine(spark, t, ids.where("quarantine_id = 4"), DAY + dt.timedelta(hours=1), resolved=False)
    state = {r["quarantine_id"]: r["resolved"] for r in P.quarantine_state(spark, t).collect()}
    assert state == {1: False, 2: True, 3: False, 4: False, 5: False}


def test_commits_of_different_schemas_read_as_one(spark):
    root = tempfile.mkdtemp(prefix="lotwright-mixed-")
    SN.append_table(spark.createDataFrame([(1, 5)], "listing_id int, price int"), root, "l")
    SN.append_table(spark.createDataFrame([(2, 1 << 40, "x")], "listing_id long, price long, car_name string"), root, "l")
    SN.append_table(spark.createDataFrame([(3, 6)], "listing_id int, price int"), root, "l")
    got = sorted((r["listing_id"], r["price"], r["car_name"]) for r in SN.read_appended(spark, root, "l", LISTINGS).collect())
    assert got == [(1, 5, None), (2, 1 << 40, "x"), (3, 6, None)]


def pages(spark, cards):
    """Listing pages (page_id -> ids)."""
    e = r'\"'
    rows = [(p, "u", '<script>self.__next_f.push([1,"5:[' + ",".join(
        f"{{{e}id{e}:{k},{e}link{e}:{e}https://www.example.com/used-cars/info/p{p}-{k}/{e}}}" for k in ids) + ']"])</script>')
        for p, ids in cards.items()]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_discovery_is_one_commit_that_survives_a_crash(spark, monkeypatch):
    t = P.Tables(tempfile.mkdtemp(prefix="lotwright-disc-"), width=10)
    P.ingest_batch(spark, batch(spark, [(5, 1, "Available"), (31, 2, "Available"), (32, 3, "SOLD")]), t, 1, DAY)
    found = pages(spark, {1: [5, 12], 2: [12, 44]})
    finish = SN.Commit.finish

    def dying(self):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(SN.Commit, "finish", dying)
        with pytest.raises(RuntimeError):
            P.discover_batch(spark, found, t, "www.example.com", DAY, complete=True)
    assert SN.read_table(spark, t.root, t.listings, LISTINGS).count() == 3
    assert finish is SN.Commit.finish
    assert P.discover_batch(spark, found, t, "www.example.com", DAY, complete=True) == {"found": 3, "new": 2, "delisted": 1}
    got = {r["listing_id"]: (r["status"], r["detail_url"]) for r in SN.read_table(spark, t.root, t.listings, LISTINGS).collect()}
    assert got == {5: ("Available", None), 31: ("Delisted", None), 32: ("SOLD", None),
                   12: (None, "/used-cars/info/p1-12"), 44: (None, "/used-cars/info/p2-44")}
    part = P.discover_batch(spark, pages(spark, {1: [5]}), t, "www.example.com", DAY, complete=False)
    assert part == {"found": 1, "new": 0, "delisted": 0}


def test_discovery_sends_no_keys_to_the_driver(spark, monkeypatch):
    """The size of the stored ids was taken far too small, so millions of them were broadcast."""
    t, plans, write = P.Tables(tempfile.mkdtemp(prefix="lotwright-wide-"), width=50), {}, P.materialize
    P.discover_batch(spark, pages(spark, {1: list(range(80))}), t, "www.example.com", DAY, complete=False)

    def seen(df, name, **how):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, **how)
    monkeypatch.setattr(P, "materialize", seen)
    got = P.discover_batch(spark, pages(spark, {2: list(range(40, 90))}), t, "www.example.com", DAY, complete=True)
    assert got == {"found": 50, "new": 10, "delisted": 0}
    assert plans["new-listings"].count("SortMergeJoin") == 2
    assert not any("Broadcast" in plan for plan in plans.values())


@pytest.mark.parametrize("files_per_trigger", [1, 7, 30])
def test_page_stream_keeps_the_first_link(spark, files_per_trigger):
    from lotwright.streaming.ingest import discovery_stream
    base = tempfile.mkdtemp(prefix="lotwright-pages-")
    for i in range(8):
        pages(spark, {i: [i, i + 1, 100 - i]}).coalesce(1).write.mode("append").parquet(f"{base}/src")
    discovery_stream(spark, f"{base}/src", f"{base}/t", f"{base}/c", "www.example.com", DAY,
                     max_files_per_trigger=files_per_trigger, width=20).awaitTermination()
    got = {r["listing_id"]: r["detail_url"] for r in SN.read_table(spark, f"{base}/t", "listings", LISTINGS).collect()}
    want = {}
    for i in range(8):
        for k in (i, i + 1, 100 - i):
            want.setdefault(k, f"/used-cars/info/p{i}-{k}")
    assert got == want


def test_stream_quarantines_rows_without_a_key(spark):
    from lotwright.streaming.ingest import make_batch_step
    root = tempfile.mkdtemp(prefix="lotwright-null-")
    rows = spark.createDataFrame([(None, 1, 5, "x"), (7, 2, -5, "y")], "listing_id long, seq long, price long, other string")
    make_batch_step(root, "seq", DAY, width=10)(rows, 0)
    bad = SN.read_appended(spark, root, "quarantine", QUARANTINE)
    assert sorted(r["rule_name"] for r in bad.collect()) == ["missing_key", "price_range"]
    assert SN.read_table(spark, root, "listings", LISTINGS).first()["price"] is None


def test_time_limit_stops_one_statement_only(spark):
    import threading
    from lotwright.plans import query as QRY
    slow = spark.range(1 << 40).selectExpr("sum(hash(id)) AS x")
    other = {}
    thread = threading.Thread(target=lambda: other.update(n=spark.range(20_000_000).selectExpr("max(hash(id))").count()))
    thread.start()
    out = QRY.bounded_rows(QRY.GuardedResult(True, None, "", slow), timeout=1.0)
    thread.join()
    assert out["error"] == "Query timed out after 1.0s" and out["rows"] == [] and other == {"n": 1}
    quick = QRY.bounded_rows(QRY.GuardedResult(True, None, "", spark.range(3)), timeout=60)
    assert quick["row_count"] == 3 and quick["error"] is None


def test_recursion_is_bounded(spark, monkeypatch):
    from lotwright.plans import query as QRY
    gold = spark.createDataFrame([(1,)], "listing_id long")
    endless = "WITH RECURSIVE n AS (SELECT 1 AS x UNION ALL SELECT x + 1 AS x FROM n) SELECT COUNT(*) AS c FROM n"
    monkeypatch.setattr(QRY, "RECURSION_LEVELS", 20)
    res = QRY.guarded_sql(spark, endless, {QRY.GOLD_VIEW: gold}, whole=True)
    assert res.passed and QRY.bounded_rows(res, timeout=120)["error"] is not None
    fine = QRY.guarded_sql(spark, endless.replace("FROM n)", "FROM n WHERE x < 9)"), {QRY.GOLD_VIEW: gold}, whole=True)
    assert QRY.bounded_rows(fine)["rows"][0]["c"] == 9


def test_history_schema_of_an_empty_store(spark):
    t = P.Tables(tempfile.mkdtemp(prefix="lotwright-none-"))
    assert P.full_history(spark, t).columns == HISTORY.fieldNames()
    assert SN.run_state(SN.read_appended(spark, t.root, t.runs, RUN_EVENTS)).where(F.lit(True)).count() == 0


def test_many_narrow_ranges_are_stored_together(spark, monkeypatch):
    monkeypatch.setattr(SN, "MAX_STORED", 4)
    t = P.Tables(tempfile.mkdtemp(prefix="lotwright-joined-"), width=10)

    def listings():
        return {r["listing_id"]: r["price"] for r in SN.read_table(spark, t.root, t.listings, LISTINGS).collect()}
    P.ingest_batch(spark, batch(spark, [(k, k, "Available") for k in range(1, 31)]), t, 1, DAY)
    assert set(SN.state(spark, t.root)[1][t.listings]["live"]) == {"0", "1", "2", "3"}         # few: stored one by one
    P.ingest_batch(spark, batch(spark, [(k, 1000 + k, "Available") for k in range(25, 400, 10)]), t, 2, DAY)
    want = {**{k: k for k in range(1, 31)}, **{k: 1000 + k for k in range(25, 400, 10)}}
    assert listings() == want
    for table in (t.listings, t.history):
        entry = SN.state(spark, t.root)[1][table]
        assert entry["width"] == 10 and len(entry["live"]) <= 4
    assert len(files(t.root, t.listings)) <= 4 + 4
    # One range of a stored group: its neighbours keep their rows, the other groups their files.
    P.ingest_batch(spark, batch(spark, [(12, 7, "Reserved"), (395, 9, "Available")]), t, 3, DAY + dt.timedelta(days=1))
    assert listings() == {**want, 12: 7, 395: 9}
    assert sorted(SN.state(spark, t.root)[1][t.listings]["live"].values()) == [2, 3, 3]
    history = P.full_history(spark, t)
    assert history.where("is_current").count() == len(want) and P.key_history(spark, t, 12).count() == 2
    h = spark.createDataFrame([(395, DAY, None, True)], "listing_id long, valid_from timestamp, valid_to timestamp, is_current boolean")
    P.store_history(spark, h, t)                                             # replaces its own range only
    assert P.full_history(spark, t).where("is_current").count() == len(want)
