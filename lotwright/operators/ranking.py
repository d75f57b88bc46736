"""Exact global percentile rank without a single-partition window.

``percent_rank() OVER (ORDER BY v)`` has no partition key, so Spark runs it in
one task.  The plan here keeps the exact definition
``r(v) = #{x < v} / max(n - 1, 1)`` (ties share the lowest rank) and spreads the
work:

1. pre-aggregate ``(metric, v) -> cnt``: map-side combine; a value held by a
   third of all rows becomes one row, so hot values never form a hot group;
2. cut points per metric from ``percentile_approx`` over the distinct values
   (one bounded array per metric -> broadcast has a proven size);
3. ``bucket`` = number of cut points below ``v``; equal values share a bucket;
4. per-(metric, bucket) totals (at most metrics x buckets rows, broadcast) give
   each bucket's offset by a running sum;
5. inside a bucket a running sum ordered by ``v`` gives the exact count below.

Only approximate *split points* are used, never approximate ranks: any cut
points give the same exact answer, they only balance the buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize


ROWS_PER_BUCKET = 1_000_000


def count_below(values: DataFrame, metric: str, value: str, n_buckets: int | None = None,
                accuracy: int = 10000, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(metric, value) rows -> (metric, value, below, n) per distinct value.

    ``below`` = number of rows of the same metric with a strictly smaller
    value, ``n`` = number of non-null rows of the metric.  The bucket count
    defaults to ceil(distinct values / ``rows_per_bucket``), so every bucket's
    sort is bounded; a small table uses one bucket per metric and needs no
    cut points at all."""
    vals = values.where(F.col(value).isNotNull())
    # The distinct-value table feeds three branches below; write it once to
    # the shared checkpoint folder instead of re-running the input plan per
    # branch.  Its size is the number of distinct values, not of rows.
    dist = materialize(vals.groupBy(metric, value).agg(F.count(F.lit(1)).alias("_cnt")),
                       "rank-dist")
    if n_buckets is None:
        n_buckets = max(1, -(-dist.count() // rows_per_bucket))   # count of written files: cheap
    totals_n = dist.groupBy(metric).agg(F.sum("_cnt").alias("n"))
    if n_buckets == 1:
        with_bucket = dist.join(F.broadcast(totals_n), metric).withColumn("_bucket", F.lit(0))
    else:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        cuts = dist.groupBy(metric).agg(
            F.percentile_approx(value, probs, accuracy).alias("_cuts"), F.sum("_cnt").alias("n"))
        # One row per metric, n_buckets-1 doubles each: a fixed, proven bound.
        with_bucket = (dist.join(F.broadcast(cuts), metric)
                       .withColumn("_bucket", F.size(F.filter("_cuts", lambda c: c < F.col(value))))
                       .drop("_cuts"))
    totals = with_bucket.groupBy(metric, "_bucket").agg(F.sum("_cnt").alias("_bcnt"))
    prior = Window.partitionBy(metric).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(metric, "_bucket",
                            F.coalesce(F.sum("_bcnt").over(prior), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(metric, "_bucket").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1)
    # At most metrics x n_buckets rows: a fixed, proven bound.
    return (with_bucket.join(F.broadcast(offsets), [metric, "_bucket"])
            .select(metric, value, "n",
                    (F.col("_offset") + F.coalesce(F.sum("_cnt").over(inside), F.lit(0)))
                    .alias("below")))


def rank_table(values: DataFrame, metric: str, value: str, n_buckets: int | None = None) -> DataFrame:
    """(metric, value) rows -> (metric, value, rank): one row per distinct
    non-null value, rank = #below / max(n - 1, 1).  Written once: it is read
    by a size check and then joined."""
    ranks = count_below(values, metric, value, n_buckets)
    r = F.col("below") / F.greatest(F.col("n") - 1, F.lit(1))
    return materialize(ranks.select(metric, value, r.alias("rank")), "rank-table")


def percentile_rank(values: DataFrame, key: str, metric: str, value: str,
                    n_buckets: int | None = None) -> DataFrame:
    """(key, metric, value) -> (key, metric, rank) with rank in [0, 1]; NULL
    values keep a NULL rank.  Equal to ``percent_rank()`` per metric."""
    ranks = count_below(values, metric, value, n_buckets)
    r = F.col("below") / F.greatest(F.col("n") - 1, F.lit(1))
    joined = values.join(ranks, [metric, value], "left")
    return joined.select(key, metric, F.when(F.col(value).isNotNull(), r).alias("rank"))
