"""Table access helpers: empty-with-schema, written intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """SNK-6: the "create if absent" form of a table: an empty frame with its schema."""
    return spark.createDataFrame([], schema)


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Bytecode size beyond which HotSpot never compiles a method, unless told to.
JIT_LIMIT = 8000


@contextmanager
def compilable(spark: SparkSession) -> Iterator[None]:
    """Within the block, Spark fuses operators only into methods that the JVM compiles.

    One fused method over the wide rows of this library is larger than that and
    stays interpreted; operator by operator Spark cuts the same expressions into
    small methods.  A limit of the session below ``JIT_LIMIT`` stays."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, str(min(int(before), JIT_LIMIT)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def materialize(df: DataFrame, name: str, compression: str | None = None, wide: bool = False) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder (``spark.checkpoint.dir``) and reading it back.

    One job (an eager ``checkpoint()`` computes and then writes in a second
    job); the files survive executor loss; the read-back relation carries real
    size statistics for the planner.  Each call gets a fresh folder.
    ``compression`` is Parquet's; the session's default if not given.  ``wide``
    rows with many expressions are written ``compilable``."""
    import uuid

    from ..session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    with compilable(spark) if wide else nullcontext():
        df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)
