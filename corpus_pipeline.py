"""Corpus pipeline: documents through five operators, each on what the one before it kept.

1. quality: documents that the quality rules reject go.
2. lines: lines that repeat an earlier line go, and documents left without words.
3. near: one document of each group of near duplicates stays (five-word
   shingles, similarity 0.8 or more).
4. pii: personal data in the texts is replaced by its kind.
5. pack: the documents are packed into sequences; one row per piece.

All but the last return the columns of ``documents``.  Null and empty tables
and repeated rows are handled as each operator states.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lotwright.llm import line_dedup, near_dedup, packing, pii, quality_rules
from lotwright.llm.shipping import ship
from lotwright.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, size=5, percent=80)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("pii", personal), ("pack", pack)]

#: Trained decoding and sequential packing have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return docs
