"""Coalescing upsert and SCD Type 2 history (MRG-1/2, SCD-1..5, AGG-6/8, FIL-7/8).

Plain Parquet has no MERGE, so every operator returns the *new* table state
as a DataFrame; writers put it in a new snapshot folder (``sources.snapshots``)
and readers resolve the newest one.  Two forms of SCD-2:

* ``scd2_apply`` -- one batch against the current state (the daily job).
  Only the ``is_current`` rows are joined and rewritten; the rows it closes
  come back on their own, to be appended to the closed history.
* ``scd2_replay`` -- many batches at once (backfill).  A window per key over
  the per-(key, batch) collapsed records gives exactly the rows that applying
  the batches one after the other would give.  Hot keys are collapsed per
  batch first (map-side partial aggregation), so a key's window holds at most
  one row per batch.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as LK
from ..functions.scalars import values_equal
from ..sources.tables import materialize

KEY = "listing_id"


def collapse_batch(batch: DataFrame, group: list[str], seq: str,
                   cols: list[str] | None = None) -> DataFrame:
    """MRG-2: per group, the last non-NULL value of every column by ``seq`` --
    what applying the rows one by one with COALESCE(new, old) leaves.
    ``max_by`` is a partial aggregate, so a hot key is combined map-side."""
    cols = cols or [c for c in batch.columns if c not in group and c != seq]
    return batch.groupBy(*group).agg(
        *[F.expr(f"max_by(`{c}`, CASE WHEN `{c}` IS NOT NULL THEN `{seq}` END) AS `{c}`") for c in cols],
        F.max(seq).alias(seq))


def upsert_coalesce(listings: DataFrame, batch: DataFrame, as_of: dt.datetime | Column,
                    key: str = KEY) -> DataFrame:
    """MRG-1: insert new keys, update existing ones column by column with
    COALESCE(incoming, existing); ``scraped_at`` keeps the first insert time.
    ``batch`` must hold one row per key (see ``collapse_batch``) and may
    carry a subset of the columns.

    Plan: the batch is written once, so its real size is known to the planner;
    one full outer join on the key then updates and inserts."""
    inc_cols = [c for c in batch.columns if c in listings.columns and c not in (key, "scraped_at")]
    inc = materialize(batch.select(key, *[F.col(c).alias(f"_in_{c}") for c in inc_cols]), "batch")
    ts = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    old = listings.withColumn("_old", F.lit(True))
    joined = old.join(inc, key, "full_outer").withColumn("_now", ts)
    out = []
    for f in listings.schema.fields:
        c, kind = f.name, f.dataType.simpleString()
        value = (f"coalesce(`_in_{c}`, `{c}`)" if c in inc_cols else
                 f"CASE WHEN _old THEN `{c}` ELSE _now END" if c == "scraped_at" else f"`{c}`")
        out.append(f"CAST({value} AS {kind}) AS `{c}`")
    return joined.selectExpr(*out)


def changes(cur: dict, inc: dict, tracked: list[str] = LK.SCD_TRACKED_FIELDS) -> Column:
    """SCD-1: ARRAY<STRUCT<field, old, new>> of tracked fields that changed
    (values as text).  ``cur``/``inc`` map field -> Column."""
    items = [F.when(~values_equal(cur[f], inc[f], f == "power"),
                    F.struct(F.lit(f).alias("field"), cur[f].cast("string").alias("old"),
                             inc[f].cast("string").alias("new")))
             for f in tracked]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def any_change(cur: dict, inc: dict, tracked: list[str] = LK.SCD_TRACKED_FIELDS) -> Column:
    return reduce(lambda a, b: a | b,
                  [~values_equal(cur[f], inc[f], f == "power") for f in tracked])


@dataclass
class ScdResult:
    listings: DataFrame      # new listings state (coalesced)
    current: DataFrame       # new current part of the history
    closed: DataFrame        # rows that this batch closed (closed rows never change again)
    actions: DataFrame       # (listing_id, _action) per incoming key
    counts: DataFrame        # one row: new, changed, unchanged, total


def scd2_apply(listings: DataFrame, history: DataFrame, batch: DataFrame, run_ts: dt.datetime,
               run_id: int | None, seq: str = "seq",
               tracked: list[str] = LK.SCD_TRACKED_FIELDS) -> ScdResult:
    """SCD-2 for one batch.

    Duplicate keys in the batch are collapsed first (last non-NULL wins), so
    every key gets at most one new history row and keeps one current row.
    NULL keys are skipped (they belong in quarantine).  The history row holds
    the *incoming* record, not the coalesced one.  Only the current rows of
    ``history`` are read: closed rows are appended to and never rewritten."""
    b = batch.where(F.col(KEY).isNotNull())
    inc = collapse_batch(b, [KEY], seq) if seq in b.columns else b
    if seq in b.columns:
        rows = b.groupBy(KEY).agg(F.count(F.lit(1)).alias("_rows"))
        inc = inc.join(rows, KEY)
    else:
        inc = inc.withColumn("_rows", F.lit(1))
    inc = materialize(inc, "incoming")
    inc_cols = [c for c in inc.columns if c not in (KEY, seq, "_rows")]
    cur = listings.select(KEY, *[F.col(f).alias(f"_cur_{f}") for f in tracked]) \
        .withColumn("_exists", F.lit(True))
    # The batch keys are written, so the planner knows their size when it picks
    # how to look them up in the listings table (SRC-4).
    hits = cur.join(inc.select(KEY), KEY, "left_semi")
    j = inc.join(hits, KEY, "left")
    cur_map = {f: F.col(f"_cur_{f}") for f in tracked}
    inc_map = {f: F.col(f) if f in inc_cols else F.lit(None) for f in tracked}
    action = (F.when(F.col("_exists").isNull(), "new")
              .when(any_change(cur_map, inc_map, tracked), "changed").otherwise("unchanged"))
    j = materialize(j.withColumn("_action", action), "actions")
    ts = F.lit(run_ts).cast("timestamp")
    hist_cols = history.columns
    kinds = {f.name: f.dataType.simpleString() for f in history.schema.fields}

    def row(values: dict[str, str], other) -> list[str]:
        return [f"CAST({values.get(c) or other(c)} AS {kinds[c]}) AS `{c}`" for c in hist_cols]

    new_rows = j.where(F.col("_action").isin("new", "changed")).withColumn("_now", ts).selectExpr(*row(
        {"valid_from": "_now", "is_current": "true", "scrape_run_id": "NULL" if run_id is None else str(run_id)},
        lambda c: f"`{c}`" if c in inc_cols or c == KEY else "NULL"))
    changed_keys = j.where(F.col("_action") == "changed").select(KEY) \
        .withColumn("_close", F.lit(True))
    current = history.where(F.col("is_current")).join(changed_keys, KEY, "left")
    closing = F.col("_close")
    closed = current.where(closing).withColumn("_now", ts).selectExpr(*row(
        {"valid_to": "_now", "is_current": "false"}, lambda c: f"`{c}`"))
    still = current.where(closing.isNull()).select(*hist_cols)
    new_listings = upsert_coalesce(listings, inc.drop(seq, "_rows"), run_ts)
    counts = j.agg(F.count_if(F.col("_action") == "new").alias("new"),
                   F.count_if(F.col("_action") == "changed").alias("changed"),
                   F.count_if(F.col("_action") == "unchanged").alias("unchanged"),
                   F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"))
    return ScdResult(new_listings, still.unionByName(new_rows), closed, j.select(KEY, "_action"), counts)


def scd2_replay(feed: DataFrame, batch_col: str, seq: str, run_ts: Column, run_id: Column,
                tracked: list[str] = LK.SCD_TRACKED_FIELDS) -> DataFrame:
    """SCD-2 over every batch of ``feed`` at once, starting from empty state.

    Returns the collapsed batch records with ``_action`` (new / changed /
    unchanged) and, for history rows, ``valid_from``/``valid_to``/``is_current``/
    ``scrape_run_id``.  ``run_ts``/``run_id`` are Columns over ``batch_col``."""
    feed = feed.where(F.col(KEY).isNotNull())
    cols = [c for c in feed.columns if c not in (KEY, batch_col, seq)]
    b = feed.groupBy(KEY, batch_col).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in cols],
        F.max(seq).alias(seq), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(KEY).orderBy(batch_col).rowsBetween(
        Window.unboundedPreceding, -1)
    prev = {f: F.last(F.col(f), ignorenulls=True).over(before) for f in tracked}
    b = b.select("*", *[prev[f].alias(f"_prev_{f}") for f in tracked],
                 F.count(F.lit(1)).over(before).alias("_n_before"))
    cur_map = {f: F.col(f"_prev_{f}") for f in tracked}
    inc_map = {f: F.col(f) for f in tracked}
    action = (F.when(F.col("_n_before") == 0, "new")
              .when(any_change(cur_map, inc_map, tracked), "changed").otherwise("unchanged"))
    b = b.withColumn("_action", action).withColumn("valid_from", run_ts) \
        .withColumn("scrape_run_id", run_id)
    return b.drop(*[f"_prev_{f}" for f in tracked], "_n_before")


def history_from_replay(replayed: DataFrame) -> DataFrame:
    """History rows of a replay: new/changed batches, each valid until the
    next history row of its key."""
    h = replayed.where(F.col("_action").isin("new", "changed"))
    w = Window.partitionBy(KEY).orderBy("valid_from")
    h = h.withColumn("valid_to", F.lead("valid_from").over(w))
    return h.withColumn("is_current", F.col("valid_to").isNull()).drop("_action", "_rows")


def replay_counts(replayed: DataFrame, batch_col: str) -> DataFrame:
    """AGG-8 per batch: new, changed, unchanged keys; ``total`` incoming rows."""
    a = F.col("_action")
    return replayed.groupBy(batch_col).agg(
        F.count_if(a == "new").alias("new"), F.count_if(a == "changed").alias("changed"),
        F.count_if(a == "unchanged").alias("unchanged"), F.sum("_rows").alias("total"))


def versions(listings: DataFrame, history: DataFrame, min_versions: int = 2) -> DataFrame:
    """AGG-6 / J-1: current listings with more than one history row, most
    versions first.  History is pre-aggregated per key before the join."""
    per_key = history.groupBy(KEY).agg(F.count(F.lit(1)).alias("versions"))
    cols = [c for c in ("car_name", "price") if c in listings.columns]
    return (listings.select(KEY, *cols).join(per_key, KEY)
            .where(F.col("versions") >= min_versions).orderBy(F.desc("versions"), KEY))


def recent_changes(history: DataFrame, as_of: dt.datetime | Column, hours: int = 24) -> DataFrame:
    """FIL-8: history rows that started in the ``hours`` before ``as_of``,
    newest first (explicit as-of instead of "now")."""
    ts = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return (history.where(F.col("valid_from") >= ts - F.make_interval(hours=F.lit(hours)))
            .orderBy(F.desc("valid_from"), KEY))


def history_of(history: DataFrame, listing_id: int, limit: int | None = None) -> DataFrame:
    """FIL-7 / WIN-5 / TOP-5: one key's history, oldest first, with a version
    number; ``limit`` keeps the first versions."""
    w = Window.partitionBy(KEY).orderBy("valid_from")
    out = (history.where(F.col(KEY) == listing_id)
           .withColumn("version", F.row_number().over(w)).orderBy("valid_from"))
    return out.limit(limit) if limit else out


def current_rows(history: DataFrame) -> DataFrame:
    """FIL-7: the current row of every key (partition-pruned on ``is_current``
    when history is written partitioned by it)."""
    return history.where(F.col("is_current"))
