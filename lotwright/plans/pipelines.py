"""Pipeline compositions over committed tables (PIP-2 .. PIP-5).

Each step is one commit: what it reads is the state the commit starts from, and
quarantine, history, listings and the run's event appear together or not at all.
Listings and current history are merged tables: a step reads and rewrites the
key ranges that its keys touch.  Closed history is appended by month of
``valid_from`` and sorted by key, so lookups prune months and row groups.
Intermediate frames that feed two sinks are written once (cut lineage).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold as G
from ..operators import lifecycle as LC
from ..operators import quality as Q
from ..operators import scd as SCD
from ..schemas import HISTORY, LISTING_COLUMNS, LISTINGS, PHASES, QUARANTINE, QUARANTINE_EVENTS
from ..sources import pages as PG
from ..sources import snapshots as SN
from ..sources.tables import empty_table, materialize

#: Closed history is partitioned by the month in which a row became valid.
MONTH = T.StructType([T.StructField("month", T.StringType())])
QUARANTINE_ORDER = ["listing_id", "field_name", "field_value", "reason"]


@dataclass
class Tables:
    """Locations of the pipeline's tables under one root folder."""
    root: str
    width: int = 1_000_000                       # keys of a range of listings and current history
    listings: str = "listings"
    history: str = "listings_history"            # current rows only
    closed: str = "listings_history_closed"      # closed rows, appended by month
    quarantine: str = "quarantine"
    resolutions: str = "quarantine_events"
    runs: str = "run_events"
    gold: str = "gold"


def ingest_batch(spark: SparkSession, batch: DataFrame, t: Tables, run_id: int,
                 as_of: dt.datetime | Callable[[DataFrame], dt.datetime], track_history: bool = True,
                 seq: str | None = None, commit: SN.Commit | None = None) -> dict:
    """PIP-2: validate -> quarantine -> SCD-2 (or plain upsert) -> counters.

    ``batch`` holds listing records (any subset of the 28 columns; others are
    not stored).  Rows without a key go to quarantine only.  ``as_of`` may be
    taken from the batch.  With a ``commit`` the step becomes part of it, and
    the caller finishes it."""
    if seq is None:
        batch = batch.withColumn("_seq", F.monotonically_increasing_id())
        seq = "_seq"
    step = commit or SN.Commit(spark, t.root)     # quarantine, history and listings as one change
    validated = materialize(Q.validate(batch), "validated")      # feeds two sinks
    as_of = as_of(validated) if callable(as_of) else as_of
    validated = validated.select(*[c for c in validated.columns if c in {*LISTING_COLUMNS, seq, "_failures"}])
    records, failures = Q.split_validated(validated)
    quarantined = Q.to_quarantine(failures.unionByName(Q.keyless(validated), allowMissingColumns=True), run_id, as_of)
    before = step.content.get(f"{t.quarantine}.quarantine_id", 0)
    step.append_numbered(quarantined, t.quarantine, "quarantine_id", QUARANTINE_ORDER)
    keyed = records.where(F.col("listing_id").isNotNull())
    ranges = SN.touched_ranges(keyed, "listing_id", t.width)
    listings = step.read(t.listings, LISTINGS, ranges)
    if track_history:
        res = SCD.scd2_apply(listings, step.read(t.history, HISTORY, ranges), keyed, as_of, run_id, seq)
        counts = res.counts.first().asDict()
        append_closed(step, res.closed, t)
        step.merge(res.current, t.history, "listing_id", t.width, ranges)
        step.merge(res.listings, t.listings, "listing_id", t.width, ranges)
    else:
        inc = materialize(SCD.collapse_batch(keyed, ["listing_id"], seq).drop(seq), "incoming")
        step.merge(SCD.upsert_coalesce(listings, inc, as_of), t.listings, "listing_id", t.width, ranges)
        counts = {"upserted": inc.count(), "total": validated.count()}
    if commit is None:
        step.finish()
    counts["as_of"] = as_of
    counts["quarantined"] = step.content[f"{t.quarantine}.quarantine_id"] - before
    return counts


# ---------------------------------------------------------------------------
# History as stored (FIL-7, FIL-8).
# ---------------------------------------------------------------------------
def append_closed(step: SN.Commit, closed: DataFrame, t: Tables) -> None:
    """Closed rows by month, sorted by key within each file."""
    rows = closed.withColumn("month", F.date_format("valid_from", "yyyy-MM"))
    rows = rows.hint("rebalance", "month").sortWithinPartitions("month", "listing_id", "valid_from")
    step.append(rows, t.closed, ["month"])


def store_history(spark: SparkSession, history: DataFrame, t: Tables) -> int:
    """Backfill: a whole history (current and closed rows) as one commit."""
    rows = materialize(SN.conform(history, HISTORY), "backfill")
    step = SN.Commit(spark, t.root)
    current = rows.where(F.col("is_current"))
    append_closed(step, rows.where(~F.col("is_current")), t)
    ranges = SN.touched_ranges(current, "listing_id", t.width)
    kept = SN.outside(step.read(t.history, HISTORY, ranges), "listing_id", t.width, ranges)   # ranges stored with them
    step.merge(kept.unionByName(current), t.history, "listing_id", t.width, ranges)
    return step.finish()


def full_history(spark: SparkSession, t: Tables) -> DataFrame:
    """Closed and current rows of the history."""
    return closed_history(spark, t).unionByName(SN.read_table(spark, t.root, t.history, HISTORY))


def closed_history(spark: SparkSession, t: Tables, since: dt.datetime | None = None) -> DataFrame:
    """Closed rows, of the months from ``since`` on if given."""
    rows = SN.read_appended(spark, t.root, t.closed, HISTORY, MONTH)
    if since is not None:
        rows = rows.where(F.col("month") >= since.strftime("%Y-%m"))
    return rows.drop("month")


def recent_history(spark: SparkSession, t: Tables, as_of: dt.datetime, hours: int = 24) -> DataFrame:
    """FIL-8 on the stored history: the months that can hold recent rows."""
    since = as_of - dt.timedelta(hours=hours)
    rows = closed_history(spark, t, since).unionByName(SN.read_table(spark, t.root, t.history, HISTORY))
    return SCD.recent_changes(rows.where(F.col("valid_from") >= F.lit(since).cast("timestamp")), as_of, hours)


def key_history(spark: SparkSession, t: Tables, listing_id: int, limit: int | None = None) -> DataFrame:
    """FIL-7 / WIN-5 on the stored history: one key range of the current rows, and the
    row groups of the closed ones that can hold the key."""
    current = SN.read_table(spark, t.root, t.history, HISTORY, [listing_id // t.width])
    rows = closed_history(spark, t).unionByName(current).where(F.col("listing_id") == listing_id)
    return SCD.history_of(rows, listing_id, limit)


# ---------------------------------------------------------------------------
# Quarantine life (SNK-3, FIL-6).
# ---------------------------------------------------------------------------
def resolve_quarantine(spark: SparkSession, t: Tables, ids: DataFrame, at: dt.datetime, resolved: bool = True) -> int:
    """Mark quarantine rows (quarantine_id) resolved, or open again: an appended event per row."""
    events = ids.select(F.col("quarantine_id").cast("long").alias("quarantine_id"),
                        F.lit(at).cast("timestamp").alias("event_ts"), F.lit(resolved).alias("resolved"))
    return SN.append_table(SN.conform(events, QUARANTINE_EVENTS), t.root, t.resolutions)


def quarantine_state(spark: SparkSession, t: Tables) -> DataFrame:
    """Quarantine rows with the newest of their events (partial aggregates on the id)."""
    rows = SN.read_appended(spark, t.root, t.quarantine, QUARANTINE)
    events = SN.read_appended(spark, t.root, t.resolutions, QUARANTINE_EVENTS)
    last = events.groupBy("quarantine_id").agg(F.max_by("resolved", "event_ts").alias("_resolved"))
    return (rows.join(last, "quarantine_id", "left")
            .withColumn("resolved", F.coalesce("_resolved", "resolved")).drop("_resolved"))


# ---------------------------------------------------------------------------
# Discovery, gold, reports.
# ---------------------------------------------------------------------------
def discover_batch(spark: SparkSession, listing_pages: DataFrame, t: Tables, host: str,
                   as_of: dt.datetime, complete: bool, commit: SN.Commit | None = None) -> dict:
    """PIP-3: links -> first-wins dedupe -> new ids only -> upsert -> delist unseen, as one commit.

    Delisting runs only when the caller states the crawl was ``complete``; a
    partial crawl would delist everything it did not reach.  New ids read the
    keys of the ranges they fall in; delisting reads key and status of the
    table; only ranges with new or delisted rows are rewritten."""
    step = commit or SN.Commit(spark, t.root)
    found = materialize(PG.discover_links(listing_pages, host), "discovered")
    seen = step.read(t.listings, LISTINGS, SN.touched_ranges(found, "listing_id", t.width))
    new = materialize(found.join(LC.sorted_side(LC.new_only(found, seen)), "listing_id"), "new-listings")
    gone = materialize(LC.unseen(step.read(t.listings, LISTINGS), found), "gone") if complete else \
        empty_table(spark, T.StructType([LISTINGS["listing_id"]]))
    counts = {"found": found.count(), "new": new.count(), "delisted": gone.count()}
    ranges = SN.touched_ranges(new.select("listing_id").unionByName(gone), "listing_id", t.width)
    if ranges:
        state = SCD.upsert_coalesce(step.read(t.listings, LISTINGS, ranges), new, as_of)
        step.merge(LC.delist(state, gone), t.listings, "listing_id", t.width, ranges)
    if commit is None:
        step.finish()
    return counts


def ingest_details(spark: SparkSession, detail_pages: DataFrame, t: Tables, run_id: int, as_of: dt.datetime,
                   track_history: bool = True, host: str = "https://www.example.com",
                   commit: SN.Commit | None = None) -> dict:
    """Phase 2 of a run: the records of the fetched pages, keyed by the work list they were
    fetched for, through PIP-2.  A page of no entry gives no record."""
    step = commit or SN.Commit(spark, t.root)
    listings = step.read(t.listings, LISTINGS)
    work = LC.worklist_union(listings) if track_history else LC.worklist_missing(listings)
    records = PG.detail_records(detail_pages, work, host)
    counts = ingest_batch(spark, records, t, run_id, as_of, track_history, commit=step)
    if commit is None:
        step.finish()
    return {"pending": work.count(), **counts}


def rebuild_gold(spark: SparkSession, t: Tables, as_of: dt.date) -> dict:
    """PIP-1 as a job: read silver, write a new gold snapshot, return stats."""
    silver = SN.read_table(spark, t.root, t.listings, LISTINGS)
    gold = G.gold_transform(silver, as_of)
    SN.write_table(gold, t.root, t.gold)
    return G.transform_stats(silver).first().asDict()


def stats_report(spark: SparkSession, t: Tables) -> DataFrame:
    """PIP-5: coverage and price statistics of the current silver snapshot."""
    from ..operators import stats as ST
    return ST.stats_report(SN.read_table(spark, t.root, t.listings, LISTINGS))


def run_phases(spark: SparkSession, t: Tables, phases: list[tuple[str, Callable[[], dict]]], run_id: int,
               as_of: dt.datetime, pages_fetched: int | None = None) -> DataFrame:
    """PIP-4: run the phases one after the other; a phase that fails is a row, and the next one still runs.

    Returns (phase_no, phase, status, error, counts); the run ledger gets the
    run's start and outcome."""
    SN.append_table(SN.run_event(spark, run_id, "running", as_of), t.root, t.runs)
    rows = []
    for i, (name, run) in enumerate(phases):
        try:
            counts = {k: v for k, v in run().items() if isinstance(v, int)}
            rows.append((i, name, "completed", None, counts))
        except Exception as failure:  # noqa: BLE001 - a phase failure is data here
            rows.append((i, name, "failed", f"{type(failure).__name__}: {failure}".splitlines()[0], {}))
    failed = any(r[2] == "failed" for r in rows)
    listings = SN.read_table(spark, t.root, t.listings, LISTINGS).count()
    SN.append_table(SN.run_event(spark, run_id, "failed" if failed else "completed", as_of,
                                 pages_fetched, listings), t.root, t.runs)
    return spark.createDataFrame(rows, PHASES)


def run_daily(spark: SparkSession, t: Tables, listing_pages: DataFrame | None,
              detail_pages: DataFrame | None, host: str, as_of: dt.datetime, run_id: int,
              complete_crawl: bool = False, track_history: bool = True,
              more: list[tuple[str, Callable[[], dict]]] | None = None) -> DataFrame:
    """PIP-4: discovery -> detail ingest -> gold (and ``more`` phases before gold), as ``run_phases``."""
    phases: list[tuple[str, Callable[[], dict]]] = []
    if listing_pages is not None:
        phases.append(("discover", lambda: discover_batch(spark, listing_pages, t, host, as_of, complete_crawl)))
    if detail_pages is not None:
        phases.append(("details", lambda: ingest_details(spark, detail_pages, t, run_id, as_of, track_history,
                                                         f"https://{host}")))
    phases += more or []
    phases.append(("gold", lambda: rebuild_gold(spark, t, as_of.date())))
    pages = listing_pages.count() if listing_pages is not None else 0
    return run_phases(spark, t, phases, run_id, as_of, pages)
