"""Aggregate reports over silver/gold/history (AGG-1..4, Q16, I-C1, PIP-5).

Each report is a single scan with one aggregation: per-column counts are
computed together and unpivoted afterwards, never one query per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as LK
from ..schemas import LISTING_COLUMNS


def listing_counts(silver: DataFrame) -> DataFrame:
    """AGG-1 + AGG-2: row count and the cheap "missing details" count
    (price NULL with a detail URL; narrower than the FIL-2 worklist)."""
    return silver.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("price").isNull() & F.col("detail_url").isNotNull())
        .alias("missing_details"))


def field_coverage(df: DataFrame, columns: list[str] = LISTING_COLUMNS) -> DataFrame:
    """AGG-3: (field_name, non_null, total, pct) for every column in one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("_total"),
                  *[F.count(F.col(c)).alias(f"_nn_{c}") for c in columns])
    stack = "stack({n}, {args}) as (field_name, non_null)".format(
        n=len(columns), args=", ".join(f"'{c}', `_nn_{c}`" for c in columns))
    long = wide.select(F.col("_total").alias("total"), F.expr(stack))
    pct = F.when(F.col("total") > 0,
                 F.bround(F.col("non_null").cast("double") * 100.0 / F.col("total"), 1))
    return long.select("field_name", "non_null", "total", pct.alias("pct"))


def price_stats(df: DataFrame) -> DataFrame:
    """AGG-4: count/min/max/mean (mean truncated to an integer) of non-null
    prices; no row when there is none."""
    p = F.col("price")
    s = df.where(p.isNotNull()).agg(
        F.count(F.lit(1)).alias("count"), F.min(p).alias("min"), F.max(p).alias("max"),
        F.avg(p).cast("bigint").alias("mean"))
    return s.where(F.col("count") > 0)


def stats_report(silver: DataFrame) -> DataFrame:
    """PIP-5: coverage and price statistics as one (metric, value) table."""
    cov = field_coverage(silver).select(
        F.concat(F.lit("coverage."), F.col("field_name")).alias("metric"),
        F.col("non_null").cast("double").alias("value"))
    ps = price_stats(silver)
    price = ps.select(F.expr("stack(4, 'price.count', cast(count as double), "
                             "'price.min', cast(min as double), 'price.max', cast(max as double), "
                             "'price.mean', cast(mean as double)) as (metric, value)"))
    return cov.unionByName(price)


PROFILE_DIMENSIONS = ["brand", "fuel_type", "vehicle_type", "status", "listing_type"]


def profile_counts(gold: DataFrame, dims: list[str] = PROFILE_DIMENSIONS) -> DataFrame:
    """Q16: counts per value of each profile dimension, from one scan
    (unpivot then one grouped count)."""
    stack = "stack({n}, {args}) as (dimension, value)".format(
        n=len(dims), args=", ".join(f"'{d}', cast({d} as string)" for d in dims))
    return (gold.select(F.expr(stack)).groupBy("dimension", "value")
            .agg(F.count(F.lit(1)).alias("n")))


PROFILE_NUMERICS = ["price", "depreciation", "mileage_km", "age_years", "coe_remaining_months",
                    "price_to_omv_ratio", "value_score"]


def profile_numeric(gold: DataFrame, cols: list[str] = PROFILE_NUMERICS) -> DataFrame:
    """Q16: min / max / mean (2 places) / null count / distinct brands-models."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.count_distinct("brand").alias("distinct_brands"),
            F.count_distinct("brand", "model").alias("distinct_models")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max"),
                 F.bround(F.avg(x), 2).alias(f"{c}_avg"),
                 F.count_if(F.col(c).isNull()).alias(f"{c}_nulls")]
    return gold.agg(*aggs)


def gold_violations(gold: DataFrame) -> DataFrame:
    """I-C1 on gold: (check, listing_id) for duplicate keys, NULL brand and
    status outside the allowed set.  Empty when the table is sound."""
    dup = (gold.groupBy("listing_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .select(F.lit("duplicate_key").alias("check"), "listing_id"))
    bad = gold.select(
        F.when(F.col("brand").isNull(), "null_brand")
        .when(~F.col("status").isin(*LK.GOLD_STATUS_VALUES) | F.col("status").isNull(),
              "status_not_allowed").alias("check"), "listing_id").where(F.col("check").isNotNull())
    return dup.unionByName(bad)


def history_violations(history: DataFrame, listings: DataFrame) -> DataFrame:
    """I-C1 on history: keys with more than one current row, history keys with
    no listing (left anti join), and broken chains (a closed row with no row
    of the same key starting at its ``valid_to``).  The chain check is an
    anti join on (key, timestamp), so a key with very many versions is spread
    over many join keys instead of forming one window partition."""
    multi = (history.where("is_current").groupBy("listing_id").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.lit("multiple_current").alias("check"), "listing_id"))
    orphan = (history.select("listing_id").distinct()
              .join(listings.select("listing_id"), "listing_id", "left_anti")
              .select(F.lit("orphan_history").alias("check"), "listing_id"))
    starts = history.select("listing_id", F.col("valid_from").alias("valid_to"))
    chain = (history.where(F.col("valid_to").isNotNull()).select("listing_id", "valid_to")
             .join(starts, ["listing_id", "valid_to"], "left_anti")
             .select(F.lit("broken_chain").alias("check"), "listing_id"))
    return multi.unionByName(orphan).unionByName(chain)
