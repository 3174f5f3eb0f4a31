"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import bpe, line_dedup, mixing, ngram_join, pii, quality, secrets, suffix_dedup, toxicity, webp
from .common import documents


def queries():
    return {
        "op1_line_dedup": lambda spark, d: line_dedup.line_dedup(documents(spark, d)),
        "op2_toxicity": lambda spark, d: toxicity.toxicity(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")),
        "op3_source_mixing": lambda spark, d: mixing.mix_sources(documents(spark, d)),
        "op4_ngram_jaccard_join": lambda spark, d: ngram_join.ngram_jaccard_join(documents(spark, d)),
        "op5_bpe": lambda spark, d: bpe.bpe_encode(documents(spark, d)),
        "op6_suffix_array_dedup": lambda spark, d: suffix_dedup.repeated_passages(documents(spark, d)),
        "op7_quality_rules": lambda spark, d: quality.quality_rules(documents(spark, d)),
        "op8_webp": lambda spark, d: webp.decode_column(webp.thumbnails(spark.read.parquet(f"{d}/embeddings.parquet"))),
        "op9_personal_data": lambda spark, d: pii.personal_data(documents(spark, d)),
        "op10_secret_scan": lambda spark, d: secrets.secret_scan(documents(spark, d)),
    }


def oracle_sql():
    return {
        "op1_line_dedup": line_dedup.SQL,
        "op3_source_mixing": mixing.SQL,
        "op7_quality_rules": quality.SQL,
    }
