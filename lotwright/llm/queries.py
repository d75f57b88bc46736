"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame.

Each query reads its whole table and derives the digest columns from the
operator's own result.  ``ORACLE`` holds the DuckDB twin where SQL can express
the operator.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import materialize
from . import (centroids, html_extract, line_dedup, lm_scoring, near_dedup, oracles, packing, piece_dropout, pii, quality_rules,
               token_store, topk_search, whitening, word_bpe)
from .shipping import ship

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(oracles.ORACLE)


def register(name: str):
    def keep(fn):
        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        REGISTRY[name] = query
        return query
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op3_quality_rules")
def op3_quality_rules(spark, sf_dir):
    return quality_rules.report(table(spark, sf_dir, "documents"))


@register("op10_token_store")
def op10_token_store(spark, sf_dir):
    import public_tokenizers
    return token_store.encode_and_digest(table(spark, sf_dir, "documents"),
                                         public_tokenizers.path("word_bpe_49k.json"))


@register("op6_topk_search")
def op6_topk_search(spark, sf_dir):
    rows = materialize(topk_search.quantised(table(spark, sf_dir, "embeddings")), "topk-vectors")
    return topk_search.search(rows, rows.where("id % 50 = 0"))


@register("op9_line_dedup")
def op9_line_dedup(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


@register("op5_bestfit_packing")
def op5_bestfit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op4_near_dedup")
def op4_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


@register("op8_lm_scoring")
def op8_lm_scoring(spark, sf_dir):
    return lm_scoring.train_and_score(table(spark, sf_dir, "documents"))


@register("op1_pii")
def op1_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@register("op2_html_extract")
def op2_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@register("op7_piece_dropout")
def op7_piece_dropout(spark, sf_dir):
    import public_tokenizers
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_dropout.encode(table(spark, sf_dir, "documents"), model)
    return piece_dropout.decode(encoded, model).selectExpr(
        "doc_id", "variant", "CAST(size(ids) AS BIGINT) AS n_pieces", "xxhash64(ids) AS ids_hash",
        "decoded = coalesce(text, '') AS lossless")


@register("op11_word_bpe")
def op11_word_bpe(spark, sf_dir):
    import public_tokenizers
    out = word_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                 digest=True)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


@register("op12_centroids")
def op12_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings")).rows()


@register("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
