"""Driver contract and a pipeline round trip on snapshot tables."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from paths import SMALL


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 35
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_snapshots_and_ledger(spark):
    from lotwright.schemas import LISTINGS
    from lotwright.sources import snapshots as SN
    root = tempfile.mkdtemp(prefix="lotwright-snap-")
    assert SN.read_table(spark, root, "listings", LISTINGS).count() == 0
    a = spark.createDataFrame([(1, "x")], "listing_id long, car_name string")
    assert SN.write_table(a, root, "listings") == 1
    assert SN.write_table(a.union(a), root, "listings") == 2
    t = SN.read_table(spark, root, "listings", LISTINGS)
    assert t.count() == 2 and t.columns == [f.name for f in LISTINGS.fields]   # additive migration
    for ev in [SN.run_event(spark, 1, "running", dt.datetime(2024, 1, 1)),
               SN.run_event(spark, 1, "completed", dt.datetime(2024, 1, 1, 1), 7, 10),
               SN.run_event(spark, 2, "running", dt.datetime(2024, 1, 2))]:
        SN.append_table(ev, root, "runs")
    from lotwright.schemas import RUN_EVENTS
    ev = SN.read_appended(spark, root, "runs", RUN_EVENTS)
    st = {r["run_id"]: r["status"] for r in SN.run_state(ev).collect()}
    assert st == {1: "completed", 2: "running"}
    with open(os.path.join(root, "_commits", "99"), "w"):
        pass                                        # a marker cut off while written is no commit
    assert SN.state(spark, root)[0] == 5 and SN.read_table(spark, root, "listings", LISTINGS).count() == 2
    big = spark.createDataFrame([(1, 1 << 40)], "listing_id long, owners long")
    assert SN.conform(big, LISTINGS).first()["owners"] is None
    assert SN.last_run(ev).first()["run_id"] == 2
    assert SN.resume_page(ev).first()["resume_page"] == 1
    assert not SN.export_parquet(spark.createDataFrame([], LISTINGS), os.path.join(root, "x"))


def test_ingest_and_gold_pipeline(spark):
    from lotwright.plans import pipelines as P
    from lotwright.sources import testviews as TV
    t = P.Tables(root=tempfile.mkdtemp(prefix="lotwright-pipe-"))
    silver = TV.silver(spark, SMALL).drop("scraped_at")
    counts = P.ingest_batch(spark, silver, t, 1, dt.datetime(2002, 7, 1))
    n = silver.count()
    assert counts["new"] == n - silver.where(F.col("listing_id") == 0).count()
    assert counts["quarantined"] > 0
    stats = P.rebuild_gold(spark, t, dt.date(2002, 6, 30))
    assert stats["gold_rows"] + stats["excluded_commercial"] == stats["total_silver"]


def test_run_daily_records_phases(spark):
    from lotwright.plans import pipelines as P
    from lotwright.schemas import LISTINGS, RUN_EVENTS
    from lotwright.sources import snapshots as SN
    from test_pages import DETAIL, EMPTY, FALLBACK, LISTING
    t = P.Tables(root=tempfile.mkdtemp(prefix="lotwright-daily-"))
    listing_pages = spark.createDataFrame([(1, "u", LISTING)], "page_id long, url string, html string")
    out = P.run_daily(spark, t, listing_pages, None, "www.example.com", dt.datetime(2024, 3, 1), run_id=1,
                      complete_crawl=True)
    urls = {r["listing_id"]: "https://www.example.com" + r["detail_url"]
            for r in SN.read_table(spark, t.root, t.listings, LISTINGS).collect()}
    first = sorted(urls)[0]
    # The record's key is the work list's, whatever the page's number; pages of no entry give no record.
    detail_pages = spark.createDataFrame([(900, urls[first], DETAIL), (901, "https://nowhere", FALLBACK), (902, "u", EMPTY)],
                                         "page_id long, url string, html string")

    def broken():
        raise OSError("disk")
    out = P.run_daily(spark, t, listing_pages, detail_pages, "www.example.com", dt.datetime(2024, 3, 2), run_id=2,
                      complete_crawl=True, more=[("export", broken)])
    got = {r["phase"]: (r["status"], r["error"], r["counts"]) for r in out.collect()}
    assert got["discover"][2]["new"] == 0 and got["details"][2]["total"] == 1
    assert got["export"][:2] == ("failed", "OSError: disk") and got["gold"][0] == "completed"
    scraped = SN.read_table(spark, t.root, t.listings, LISTINGS).where("price IS NOT NULL").collect()
    assert [r["listing_id"] for r in scraped] == [first]
    ev = SN.read_appended(spark, t.root, t.runs, RUN_EVENTS)
    assert {r["run_id"]: r["status"] for r in SN.run_state(ev).collect()} == {1: "completed", 2: "failed"}


def test_discovery_that_finds_nothing_delists_nothing(spark):
    from lotwright.operators import lifecycle as LC
    listings = spark.createDataFrame([(1, "Available"), (2, "Reserved")], "listing_id long, status string")
    none = LC.delist_unseen(listings, listings.where("false"))
    assert [r["status"] for r in none.orderBy("listing_id").collect()] == ["Available", "Reserved"]
    assert none.where("_delisted").count() == 0


def test_overflowing_values_do_not_fail(spark):
    from lotwright.functions import scalars as SC
    rows = spark.createDataFrame([("99999999999y",), ("9223372036854775807y 9m",), ("5y 3m",)], "t string")
    assert [r[0] for r in rows.select(SC.coe_months(F.col("t"))).collect()] == [None, None, 63]
