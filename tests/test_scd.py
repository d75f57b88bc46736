"""SCD-2 and coalescing upsert: sequential batches vs. the set-based replay."""

import datetime as dt

from pyspark.sql import functions as F

from paths import SMALL
from lotwright.operators import scd as SCD
from lotwright.schemas import HISTORY, LISTINGS
from lotwright.sources import testviews as TV
from lotwright.sources.tables import empty_table, materialize

COLS = ["price", "depreciation", "status", "detail_url", "owners"]


def _listing_frame(spark, recs):
    base = {f.name: None for f in LISTINGS.fields}
    out = []
    for r in recs:
        b = dict(base)
        b.update(r)
        out.append(tuple(b[f.name] for f in LISTINGS.fields))
    return spark.createDataFrame(out, LISTINGS)


def _batch(spark, recs):
    return spark.createDataFrame([(r["listing_id"], r.get("price"), r.get("status"), i)
                                  for i, r in enumerate(recs)],
                                 "listing_id long, price long, status string, seq long")


def _history(before, res):
    """Closed rows stay; the batch's closed rows and the new current part join them."""
    return before.where("NOT is_current").unionByName(res.closed).unionByName(res.current)


def test_price_drop_chain(spark):
    listings, history = empty_table(spark, LISTINGS), empty_table(spark, HISTORY)
    for day, price in enumerate([90000, 85000, 80000], start=1):
        res = SCD.scd2_apply(listings, history, _batch(spark, [{"listing_id": 200, "price": price}]),
                             dt.datetime(2024, 1, day), day)
        listings, history = materialize(res.listings, "l"), materialize(_history(history, res), "h")
    h = history.orderBy("valid_from").collect()
    assert [r["price"] for r in h] == [90000, 85000, 80000]
    assert [r["is_current"] for r in h] == [False, False, True]
    assert h[0]["valid_to"] == h[1]["valid_from"] and h[2]["valid_to"] is None


def test_unchanged_is_idempotent_and_null_means_keep(spark):
    listings, history = empty_table(spark, LISTINGS), empty_table(spark, HISTORY)
    b = _batch(spark, [{"listing_id": 1, "price": 100, "status": "Available"}])
    res = SCD.scd2_apply(listings, history, b, dt.datetime(2024, 1, 1), 1)
    listings, history = materialize(res.listings, "l"), materialize(_history(history, res), "h")
    res2 = SCD.scd2_apply(listings, history, b, dt.datetime(2024, 1, 2), 2)
    assert res2.counts.first().asDict() == {"new": 0, "changed": 0, "unchanged": 1, "total": 1}
    res3 = SCD.scd2_apply(listings, history, _batch(spark, [{"listing_id": 1}]), dt.datetime(2024, 1, 3), 3)
    assert res3.counts.first()["unchanged"] == 1
    assert materialize(res3.listings, "l").first()["price"] == 100   # NULL incoming keeps the value


def test_existing_listing_counts_as_changed(spark):
    # a listing first discovered with a URL only is "changed" when details arrive
    listings = _listing_frame(spark, [{"listing_id": 5, "detail_url": "/used-cars/info/5"}])
    res = SCD.scd2_apply(listings, empty_table(spark, HISTORY),
                         _batch(spark, [{"listing_id": 5, "price": 10}]), dt.datetime(2024, 1, 1), 1)
    assert res.counts.first()["changed"] == 1


def test_sequential_daily_batches_equal_replay(spark):
    feed = TV.feed(spark, SMALL).select("listing_id", "day", "seq", *COLS)
    run_ts = F.col("day").cast("timestamp") + F.expr("INTERVAL 1 DAY")
    replay = SCD.history_from_replay(SCD.scd2_replay(feed, "day", "seq", run_ts,
                                                     F.lit(None).cast("bigint")))
    want = sorted((r["listing_id"], r["valid_from"], r["valid_to"], r["is_current"], r["price"], r["status"])
                  for r in replay.collect())
    days = sorted(r["day"] for r in feed.select("day").distinct().collect())
    listings, history = empty_table(spark, LISTINGS), empty_table(spark, HISTORY)
    for d in days:
        batch = feed.where(F.col("day") == d).drop("day")
        ts = dt.datetime.combine(d, dt.time()) + dt.timedelta(days=1)
        res = SCD.scd2_apply(listings, history, batch, ts, None)
        listings, history = materialize(res.listings, "l"), materialize(_history(history, res), "h")
    got = sorted((r["listing_id"], r["valid_from"], r["valid_to"], r["is_current"], r["price"], r["status"])
                 for r in history.collect())
    assert got == want
    one_current = history.where("is_current").groupBy("listing_id").count().where("count > 1").count()
    assert one_current == 0
    # the final listings state does not depend on the batch split
    whole = SCD.collapse_batch(feed.drop("day"), ["listing_id"], "seq")
    a = sorted(tuple(r) for r in listings.select("listing_id", *COLS).collect())
    b = sorted(tuple(r) for r in whole.select("listing_id", *COLS).collect())
    assert a == b


def test_history_violations_detects_breaks(spark):
    from lotwright.operators import stats as ST
    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    rows = [
        (1, t[0], t[1], False), (1, t[1], None, True),            # sound chain
        (2, t[0], t[1], False), (2, t[2], None, True),            # gap: t1 is never a start
        (3, t[0], None, True), (3, t[1], None, True),             # two current rows
        (4, t[0], None, True),                                    # no listing
    ]
    h = spark.createDataFrame(rows, "listing_id long, valid_from timestamp, valid_to timestamp, is_current boolean")
    listings = spark.createDataFrame([(1,), (2,), (3,)], "listing_id long")
    got = sorted(tuple(r) for r in ST.history_violations(h, listings).collect())
    assert got == [("broken_chain", 2), ("multiple_current", 3), ("orphan_history", 4)]


def test_first_wins_and_history_of(spark):
    from lotwright.operators import lifecycle as LC
    df = spark.createDataFrame([(7, 2, 0, "b"), (7, 1, 5, "a"), (7, 1, 3, "c"), (8, 1, 0, "z")],
                               "listing_id long, page int, pos int, url string")
    got = {r["listing_id"]: r["url"] for r in LC.first_wins(df, "listing_id", ["page", "pos"]).collect()}
    assert got == {7: "c", 8: "z"}
    t = [dt.datetime(2024, 1, d) for d in (3, 1, 2)]
    h = spark.createDataFrame([(1, t[0], None, True), (1, t[1], t[2], False), (1, t[2], t[0], False),
                               (2, t[1], None, True)],
                              "listing_id long, valid_from timestamp, valid_to timestamp, is_current boolean")
    r = SCD.history_of(h, 1).collect()
    assert [x["version"] for x in r] == [1, 2, 3] and [x["valid_from"] for x in r] == sorted(t)
