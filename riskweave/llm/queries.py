"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import (
    bpe,
    chat,
    decontaminate,
    hard_negatives,
    jaccard,
    language,
    licenses,
    line_dedup,
    quality,
    ranked_search,
    sharding,
    token_counts,
    wrappers,
)
from riskweave.llm.common import read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op1(read(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.op2(spark, read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op3(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op4(read(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op5(read(spark, sf_dir, "documents"))


def op6_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.op6(spark, read(spark, sf_dir, "pages"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op7(spark, read(spark, sf_dir, "conversations"))


def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op8(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op9(read(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op10(read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.op11(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op12(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.op13(read(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # At call time, since the module at the top of the repository imports this package.
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_hilbert_sharding": op4_hilbert_sharding,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_html_wrappers": op6_html_wrappers,
    "op7_chat_format": op7_chat_format,
    "op8_latent_decontamination": op8_latent_decontamination,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_license_scan": op10_license_scan,
    "op11_ranked_search": op11_ranked_search,
    "op12_token_counts": op12_token_counts,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}
ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op5_ngram_jaccard": jaccard.OP5_SQL,
    "op11_ranked_search": ranked_search.OP11_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
