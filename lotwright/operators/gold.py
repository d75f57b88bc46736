"""Silver -> gold: commercial exclusion, 35-column projection, value score.

PIP-1 as one lazy plan: ``scan -> commercial filter (pushed into the scan) ->
brand/model/trim struct (computed once) -> project -> score sub-plan -> left
join on key``.  The only exchanges are the
score's pre-aggregation/rank shuffles on narrow (key, metric, value) rows and
the join of scores back onto gold by ``listing_id``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as LK
from ..functions import names as N
from ..functions import scalars as SC
from ..functions.cache import per_application
from ..schemas import GOLD_COLUMNS
from ..sources.tables import materialize
from .ranking import percentile_rank, rank_table

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def with_commercial_flag(silver: DataFrame) -> DataFrame:
    """Add ``_commercial`` (FIL-1).  It needs the brand only, not model/trim,
    so the exclusion filter is small and Catalyst pushes it into the scan:
    excluded rows never reach the model/trim parse."""
    return silver.withColumn("_commercial", N.commercial_flag("vehicle_type", "car_name"))


def tag_silver(silver: DataFrame) -> DataFrame:
    """Consumer rows of ``silver`` with ``_bmt`` = struct(brand, model, trim)."""
    consumer = with_commercial_flag(silver).where(~F.col("_commercial")).drop("_commercial")
    # The name's stages see the other columns as one value: carried one by one through every stage
    # they make a generated method so large that the JIT does badly (measured 2.4x on the projection).
    others = [c for c in consumer.columns if c != "car_name"]
    narrow = consumer.select("car_name", F.struct(*others).alias("_row"))
    parsed = N.with_brand_model_trim(narrow, "car_name", "_bmt")
    return parsed.select(*["car_name" if c == "car_name" else F.col(f"_row.{c}").alias(c) for c in consumer.columns], "_bmt")


def project_gold(tagged: DataFrame, as_of: dt.date, keep_delisted: bool = False) -> DataFrame:
    """PRJ-1/PRJ-2/PRJ-3: the 35 gold columns (``value_score`` still NULL).

    Values used twice (posted date, COE total, seen text) are staged as
    attributes first so each is computed once per row."""
    staged = tagged.select("*", *_gold_stage())
    return staged.select(*_gold_columns(as_of, keep_delisted))


@per_application
def _gold_stage() -> list:
    c = F.col
    return [SC.posted_day(c("posted_date")).alias("_posted"),
            SC.coe_total_months(c("coe_remaining")).alias("_coe_total"),
            F.date_format(c("scraped_at"), TS_TEXT).alias("_seen")]


@per_application
def _gold_columns(as_of: dt.date, keep_delisted: bool) -> list:
    c = F.col
    seen = c("_seen")
    cols = {
        "listing_id": c("listing_id"),
        "brand": c("_bmt.brand"),
        "model": c("_bmt.model"),
        "trim": c("_bmt.trim"),
        "car_name": c("car_name"),
        "price": c("price"),
        "installment": c("installment"),
        "depreciation": c("depreciation"),
        "dereg_value": c("dereg_value"),
        "manufactured": c("manufactured"),
        "age_years": SC.age_years(c("manufactured"), as_of),
        "mileage_km": c("mileage_km"),
        "engine_cap_cc": c("engine_cap_cc"),
        "transmission": c("transmission"),
        "fuel_type": SC.normalize_fuel(c("fuel_type")),
        "power": c("power"),
        "curb_weight": c("curb_weight"),
        "reg_date": SC.reg_date_iso(c("reg_date")),
        "coe": c("coe"),
        "coe_remaining_months": SC.coe_months(c("coe_remaining"), c("_coe_total")),
        "road_tax": c("road_tax"),
        "omv": c("omv"),
        "arf": c("arf"),
        "vehicle_type": SC.normalize_vehicle_type(c("vehicle_type")),
        "listing_type": c("listing_type"),
        "owners": c("owners"),
        "days_on_market": SC.days_on_market(c("posted_date"), as_of, c("_posted")),
        "features": c("features"),
        "accessories": c("accessories"),
        "detail_url": c("detail_url"),
        "price_to_omv_ratio": SC.price_to_omv_ratio(c("price"), c("omv")),
        "value_score": F.lit(None).cast("double"),
        "status": SC.normalize_status(c("status"), keep_delisted),
        "first_seen_at": seen,
        "last_seen_at": seen,
    }
    return [v.alias(k) for k, v in cols.items()]


def _score_expr(rank_cols: dict, coe_higher_is_better: bool) -> F.Column:
    """Weighted mean of reversed ranks over the metrics a row has, summed in the
    fixed metric order (so doubles match a sequential sum), x100, half-even 1."""
    num = F.lit(0.0)
    den = F.lit(0.0)
    for m, w in LK.SCORE_METRICS:
        r = rank_cols[m]
        if not (m == "coe_remaining_months" and coe_higher_is_better):
            r = F.lit(1.0) - r
        num = num + F.coalesce(r * F.lit(w), F.lit(0.0))
        den = den + F.when(r.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
    return F.when(den > 0, F.bround(num / den * F.lit(100.0), 1))


def _metric_rows(scored: DataFrame) -> DataFrame:
    stack = "stack({n}, {args}) as (metric, v)".format(
        n=len(LK.SCORE_METRICS),
        args=", ".join(f"'{m}', cast({m} as double)" for m, _ in LK.SCORE_METRICS))
    return scored.select("listing_id", F.expr(stack))


def value_scores(gold: DataFrame, coe_higher_is_better: bool = False,
                 n_buckets: int | None = None) -> DataFrame:
    """WIN-1/WIN-2 (shuffle form): (listing_id, value_score) for ``gold`` rows.

    Unpivot to narrow (listing_id, metric, v) rows, exact percentile rank,
    pivot back per listing.  Used when the rank table is too large to
    broadcast; every step is a key-partitioned shuffle (AQE splits skew)."""
    ranked = percentile_rank(_metric_rows(gold), "listing_id", "metric", "v", n_buckets)
    pivot = ranked.groupBy("listing_id").agg(*[
        F.max(F.when(F.col("metric") == m, F.col("rank"))).alias(f"_r_{m}")
        for m, _ in LK.SCORE_METRICS])
    score = _score_expr({m: F.col(f"_r_{m}") for m, _ in LK.SCORE_METRICS},
                        coe_higher_is_better)
    return pivot.select("listing_id", score.alias("value_score"))


# Largest rank table (distinct metric values, two doubles each) attached by
# broadcast joins.  Both forms give the same scores; beyond the bound the
# shuffle form runs, e.g. when unvalidated ratios take very many values.
MAX_BROADCAST_RANK_ROWS = 2_000_000


def with_value_score(gold: DataFrame, coe_higher_is_better: bool = False,
                     n_buckets: int | None = None,
                     max_broadcast_rows: int = MAX_BROADCAST_RANK_ROWS) -> DataFrame:
    """Set ``value_score`` on ``Available`` rows of ``gold`` (others NULL)."""
    metrics = [m for m, _ in LK.SCORE_METRICS]
    avail = gold.where(F.col("status") == "Available").select("listing_id", *metrics)
    ranks = rank_table(_metric_rows(avail), "metric", "v", n_buckets)
    if ranks.count() <= max_broadcast_rows:
        # Size checked above: five broadcast hash joins, gold is not shuffled.
        out = gold
        for m in metrics:
            dim = ranks.where(F.col("metric") == m).select(
                F.col("v").alias(f"_v_{m}"), F.col("rank").alias(f"_r_{m}"))
            out = out.join(F.broadcast(dim), F.col(m).cast("double") == F.col(f"_v_{m}"), "left")
        is_avail = F.col("status") == "Available"
        score = _score_expr({m: F.when(is_avail, F.col(f"_r_{m}")) for m in metrics},
                            coe_higher_is_better)
        return out.withColumn("value_score", F.when(is_avail, score)).select(*GOLD_COLUMNS)
    scores = value_scores(avail, coe_higher_is_better, n_buckets)
    return gold.drop("value_score").join(scores, "listing_id", "left").select(*GOLD_COLUMNS)


def gold_transform(silver: DataFrame, as_of: dt.date, keep_delisted: bool = False,
                   coe_higher_is_better: bool = False, n_buckets: int | None = None,
                   max_broadcast_rows: int = MAX_BROADCAST_RANK_ROWS) -> DataFrame:
    """PIP-1: the gold table (35 columns) for ``silver`` as of ``as_of``.

    The projection is written once: the ranks are taken from its stored metrics
    and joined to its stored rows, so a name is parsed once."""
    gold = materialize(project_gold(tag_silver(silver), as_of, keep_delisted), "gold-unscored", wide=True)
    return with_value_score(gold, coe_higher_is_better, n_buckets, max_broadcast_rows)


def transform_stats(silver: DataFrame, keep_delisted: bool = False) -> DataFrame:
    """AGG-7: total_silver, excluded_commercial, gold_rows, available, sold (one pass)."""
    t = with_commercial_flag(silver).select(
        "_commercial", SC.normalize_status(F.col("status"), keep_delisted).alias("_st"))
    consumer = ~F.col("_commercial")
    return t.agg(
        F.count(F.lit(1)).alias("total_silver"),
        F.count_if(F.col("_commercial")).alias("excluded_commercial"),
        F.count_if(consumer).alias("gold_rows"),
        F.count_if(consumer & (F.col("_st") == "Available")).alias("available"),
        F.count_if(consumer & (F.col("_st") == "Sold")).alias("sold"),
    )
