"""Structured Streaming ingest of listing records and of pages (STR-1 .. STR-3, SRC-5).

A file source with a fixed schema feeds ``foreachBatch``; every micro-batch
runs the batch job's own step (``plans.pipelines``) against the committed tables:
records are validated, failures and rows without a key go to quarantine, history
and listings are merged by key range.  The query's checkpoint (in the shared
checkpoint folder) fixes what each batch holds; quarantine, history, listings, the
run event and the batch's number are one commit, so a batch replayed after a
crash either finds its number committed and is skipped, or starts again from the
state before it.
No streaming state store is used: the unbounded "seen ids" state lives in the
listings table itself (an anti join of a batch's ids with the key ranges they
fall in).

Later batches overwrite earlier ones, so the source must bring its files in the
order of their records (Spark takes files by modification time).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans import pipelines as P
from ..sources import snapshots as SN

RunTime = dt.datetime | Callable[[DataFrame], dt.datetime]
LAST_BATCH = "stream_batch"
LAST_PAGES = "page_stream_batch"

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType())])


def _once(t: P.Tables, note: str, run_id_base: int, runs_table: str,
          work: Callable[[DataFrame, SN.Commit, int], dict]):
    """The ``foreachBatch`` function that does ``work`` in one commit with the batch's number."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commit = SN.Commit(spark, t.root)
        if commit.content.get(note, -1) >= batch_id:
            return                                   # replayed after its commit: no double apply
        rid = run_id_base + batch_id
        done = work(batch, commit, rid)
        commit.append(SN.run_event(spark, rid, "completed", done["as_of"], listings_count=done["total"]), runs_table)
        commit.note(note, batch_id)
        commit.finish()
    return step


def make_batch_step(root: str, seq: str, run_ts: RunTime, track_history: bool = True,
                    run_id_base: int = 1_000_000, runs_table: str = "stream_runs", width: int = P.Tables.width):
    """STR-1 / VAL-9: validate, quarantine and SCD-2 (or upsert) of one micro-batch of records.

    ``run_ts`` is one time for all batches, or gives each batch its own."""
    t = P.Tables(root, width)

    def work(batch: DataFrame, commit: SN.Commit, run_id: int) -> dict:
        return P.ingest_batch(batch.sparkSession, batch, t, run_id, run_ts, track_history, seq, commit)
    return _once(t, LAST_BATCH, run_id_base, runs_table, work)


def make_page_step(root: str, host: str, run_ts: RunTime, run_id_base: int = 2_000_000,
                   runs_table: str = "page_runs", width: int = P.Tables.width):
    """STR-2 / SRC-5: discovery in one micro-batch of listing pages; ids already in the listings
    table are dropped by the anti join of ``discover_batch``."""
    t = P.Tables(root, width)

    def work(batch: DataFrame, commit: SN.Commit, run_id: int) -> dict:
        at = run_ts(batch) if callable(run_ts) else run_ts
        counts = P.discover_batch(batch.sparkSession, batch, t, host, at, complete=False, commit=commit)
        return {"as_of": at, "total": counts["found"]}
    return _once(t, LAST_PAGES, run_id_base, runs_table, work)


def _start(spark: SparkSession, source_dir: str, schema: T.StructType, step, checkpoint: str,
           max_files_per_trigger: int, available_now: bool):
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingest_stream(spark: SparkSession, source_dir: str, schema: T.StructType, root: str,
                  checkpoint: str, seq: str, run_ts: RunTime, max_files_per_trigger: int = 1,
                  track_history: bool = True, available_now: bool = True, width: int = P.Tables.width):
    """STR-1: start the streaming ingest; returns the StreamingQuery.
    ``available_now`` processes what is there and stops (scheduled runs)."""
    return _start(spark, source_dir, schema, make_batch_step(root, seq, run_ts, track_history, width=width),
                  checkpoint, max_files_per_trigger, available_now)


def discovery_stream(spark: SparkSession, source_dir: str, root: str, checkpoint: str, host: str,
                     run_ts: RunTime, max_files_per_trigger: int = 1, available_now: bool = True,
                     width: int = P.Tables.width):
    """STR-2: start the discovery over a folder of listing pages; returns the StreamingQuery."""
    return _start(spark, source_dir, PAGES, make_page_step(root, host, run_ts, width=width),
                  checkpoint, max_files_per_trigger, available_now)
