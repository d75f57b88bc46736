"""Worklists, discovery and lifecycle operators (FIL-2/3, SET-1, J-2, J-3, WIN-4).

All key-set operations are joins on ``listing_id`` (anti / semi / left), so
they shuffle once on the key or broadcast a side whose size AQE has measured;
no id set is ever collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as LK


def worklist_missing(listings: DataFrame, limit: int | None = None) -> DataFrame:
    """FIL-2: (listing_id, detail_url) with a URL whose details were never
    fetched (price NULL) or were reset (accessories NULL).  ``limit`` 0/None
    means no limit."""
    c = F.col
    w = listings.where(c("detail_url").isNotNull()
                       & (c("price").isNull() | c("accessories").isNull()))
    out = w.select("listing_id", "detail_url").orderBy("listing_id")
    return out.limit(limit) if limit else out


def worklist_active(listings: DataFrame) -> DataFrame:
    """FIL-3: fully scraped listings still active (status NULL or not one of
    the inactive statuses), for price-change re-scrapes."""
    c = F.col
    w = listings.where(c("detail_url").isNotNull() & c("price").isNotNull()
                       & c("accessories").isNotNull()
                       & (c("status").isNull() | ~c("status").isin(*LK.INACTIVE_STATUSES)))
    return w.select("listing_id", "detail_url").orderBy("listing_id")


def worklist_union(listings: DataFrame, limit: int | None = None) -> DataFrame:
    """SET-1: missing-details first, then active; a key listed in both keeps
    its first (missing) entry.  One scan: the priority is computed per row,
    so no union and no per-key aggregation are needed."""
    c = F.col
    missing = c("detail_url").isNotNull() & (c("price").isNull() | c("accessories").isNull())
    active = (c("detail_url").isNotNull() & c("price").isNotNull() & c("accessories").isNotNull()
              & (c("status").isNull() | ~c("status").isin(*LK.INACTIVE_STATUSES)))
    out = (listings.select("listing_id", "detail_url",
                           F.when(missing, 0).when(active, 1).alias("priority"))
           .where(c("priority").isNotNull()).orderBy("priority", "listing_id"))
    return out.limit(limit) if limit else out


def first_wins(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """WIN-4: first row per key by ``order_cols`` (deterministic, unlike
    ``dropDuplicates``).  ``min_by`` is a partial aggregate: a hot key is
    combined map-side before the shuffle."""
    others = [c for c in df.columns if c != key]
    ordering = F.struct(*[F.col(c) for c in order_cols])
    packed = F.struct(*[F.col(c) for c in others])
    return (df.groupBy(key).agg(F.min_by(packed, ordering).alias("_row"))
            .select(key, "_row.*"))


def sorted_side(keys: DataFrame) -> DataFrame:
    """Keys that a join must sort, not send to the driver for a broadcast.

    Spark takes a written table's bytes by the share of the columns read, at their
    default widths.  One long of a compressed table whose other columns are mostly
    NULL comes out far too small, so millions of keys would be broadcast."""
    return keys.hint("merge")


def new_only(incoming_ids: DataFrame, seen: DataFrame, key: str = "listing_id") -> DataFrame:
    """J-2 / FIL-4 / SET-2: distinct incoming keys not yet seen (left anti join)."""
    return incoming_ids.select(key).distinct().join(sorted_side(seen.select(key)), key, "left_anti")


def delist_unseen(listings: DataFrame, active_ids: DataFrame,
                  key: str = "listing_id") -> DataFrame:
    """J-3 / LIF-1: listings not found by a *complete* discovery run become
    ``Delisted`` when their status is active; NULL or other statuses are
    kept (three-valued logic).  Returns the whole table with a
    ``_delisted`` flag.  The caller must only pass the ids of a complete run.
    A run that found nothing delists nothing."""
    hits = active_ids.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_hit", F.lit(True))
    if active_ids.where(F.col(key).isNotNull()).isEmpty():
        return listings.withColumn("_delisted", F.lit(False))
    j = listings.join(hits, key, "left")
    st = F.col("status")
    flag = F.col("_hit").isNull() & (st != "Delisted") & st.isin(*LK.DELISTABLE_STATUSES)
    flag = F.coalesce(flag, F.lit(False))
    return (j.withColumn("_delisted", flag)
            .withColumn("status", F.when(F.col("_delisted"), F.lit("Delisted")).otherwise(st))
            .drop("_hit"))


def unseen(listings: DataFrame, active_ids: DataFrame, key: str = "listing_id") -> DataFrame:
    """LIF-1 as a key set: active listings that a *complete* discovery run did not find (one anti
    join over key and status).  A run that found nothing has nothing to say: no row."""
    hits = active_ids.where(F.col(key).isNotNull()).select(key).distinct()
    st = F.col("status")
    live = listings.where((st != "Delisted") & st.isin(*LK.DELISTABLE_STATUSES)).select(key)
    gone = live.join(sorted_side(hits), key, "left_anti")
    return gone.where(F.lit(False)) if hits.isEmpty() else gone


def delist(listings: DataFrame, gone: DataFrame, key: str = "listing_id") -> DataFrame:
    """The listings with the status of the ``gone`` keys set to ``Delisted``."""
    marked = listings.join(sorted_side(gone.select(key).withColumn("_gone", F.lit(True))), key, "left")
    status = F.when(F.col("_gone"), F.lit("Delisted")).otherwise(F.col("status"))
    return marked.withColumn("status", status).select(*listings.columns)


def absolute_url(url, host: str = "https://www.example.com"):
    """SCR-14: prefix the host unless the URL already starts with ``http``."""
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(host), url))
