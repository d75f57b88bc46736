"""Streaming ingest: micro-batches give the batch result; replays are skipped."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from paths import SMALL
from lotwright.operators import scd as SCD
from lotwright.plans import pipelines as P
from lotwright.schemas import LISTINGS
from lotwright.sources import snapshots as SN
from lotwright.sources import testviews as TV
from lotwright.streaming.ingest import ingest_stream, make_batch_step

COLS = ["price", "depreciation", "status", "detail_url", "owners"]


def _written_daily(feed, path):
    for day in [r[0] for r in feed.select("day").distinct().orderBy("day").collect()]:
        feed.where(F.col("day") == F.lit(day)).write.mode("append").parquet(path)


@pytest.mark.parametrize("files", [7, 30])
def test_stream_equals_batch_and_replay_is_skipped(spark, files):
    base = tempfile.mkdtemp(prefix="lotwright-stream-")
    feed = TV.feed(spark, SMALL).select("listing_id", "day", "seq", *COLS)
    _written_daily(feed, f"{base}/src")
    schema = spark.read.parquet(f"{base}/src").schema
    ts = dt.datetime(2024, 2, 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest_stream(spark, f"{base}/src", schema, f"{base}/t", f"{base}/ckpt", "seq", ts,
                      max_files_per_trigger=files * 4).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = SN.read_table(spark, f"{base}/t", "listings", LISTINGS).select("listing_id", *COLS)
    # Key 0 breaks its range rule, so its rows are in quarantine only.
    valid = feed.where("listing_id <> 0")
    want = SCD.collapse_batch(valid.drop("day"), ["listing_id"], "seq").select("listing_id", *COLS)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    hist = P.full_history(spark, P.Tables(f"{base}/t"))
    assert hist.where("is_current").groupBy("listing_id").count().where("count > 1").count() == 0
    # a micro-batch replayed after its commit is not applied twice
    n_hist = hist.count()
    step = make_batch_step(f"{base}/t", "seq", ts)
    step(feed.where(F.col("day") == feed.agg(F.min("day")).first()[0]).drop("day"), 0)
    assert P.full_history(spark, P.Tables(f"{base}/t")).count() == n_hist


@pytest.mark.parametrize("crash_after", [1, 2, 3, 4, 5])
def test_crash_before_the_commit_and_replay(spark, monkeypatch, crash_after):
    """A job that dies after any of its writes leaves no trace once replayed."""
    root = tempfile.mkdtemp(prefix="lotwright-crash-")
    rows = spark.createDataFrame([(1, 10, 100), (2, 11, 200)], "listing_id long, seq long, price long")
    more = spark.createDataFrame([(1, 20, 150), (3, 21, 300)], "listing_id long, seq long, price long")
    make_batch_step(root, "seq", dt.datetime(2024, 1, 1))(rows, 0)
    step = make_batch_step(root, "seq", dt.datetime(2024, 1, 2))
    done = [0]

    def dying(write):
        def run(self, *args, **kw):
            write(self, *args, **kw)
            done[0] += 1
            if done[0] == crash_after:
                raise RuntimeError("killed")
        return run
    with monkeypatch.context() as m:
        m.setattr(SN.Commit, "append", dying(SN.Commit.append))      # quarantine, closed history, run event
        m.setattr(SN.Commit, "merge", dying(SN.Commit.merge))        # current history, listings
        with pytest.raises(RuntimeError):
            step(more, 1)
    assert SN.read_table(spark, root, "listings", LISTINGS).count() == 2       # the state before
    step(more, 1)
    step(more, 1)
    history = P.full_history(spark, P.Tables(root))
    assert history.count() == 4 and history.where("is_current").count() == 3
    assert history.where("is_current").groupBy("listing_id").count().where("count > 1").count() == 0
    closed = history.where("NOT is_current").first()
    assert (closed["listing_id"], closed["valid_from"], closed["valid_to"]) == (
        1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
