"""Written tables whose rows are co-located by a key, so that a later join on it moves neither side."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Spark's own bound on the buckets of a table.
MAX_BUCKETS = 100_000


def buckets_of(df: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions, which grow with the data."""
    return max(1, min(MAX_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


@contextmanager
def shuffles_end_with_the_write(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a write when the write is done: its rows are in the written table."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bucketed(df: DataFrame, key: str, name: str, buckets: int) -> DataFrame:
    """Write ``df`` in ``buckets`` buckets of ``key`` to the shared scratch folder and read it back.

    Joins and cogroups of such tables on ``key`` need no exchange of the side
    that is bucketed.  The table's name lives in the session's catalog and its
    files among the other scratch tables.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    with shuffles_end_with_the_write(spark):
        (df.write.format("parquet").option("path", scratch_path(spark, table)).option("compression", "zstd")
         .bucketBy(buckets, key).saveAsTable(table))
    return spark.table(table)
