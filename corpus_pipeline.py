"""Corpus preparation in five stages, each over all that the stage before kept.

Quality rules drop documents, line dedup cuts lines, the Jaccard join keeps one document of
each group, decontamination drops documents with benchmark passages, and the last stage
encodes what is left. All stages but the last return the columns of ``documents``.

The learned and graph stages have no SQL form, so ``ORACLE_SQL`` is None; the tests hold
every stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe, decontaminate, jaccard, line_dedup, quality
from riskweave.llm.common import read, ship
from riskweave.session import materialize

ORACLE_SQL = None


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", length)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go; null texts are among them."""
    rules = quality.learn(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).where("kept").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller id also holds go; a document without lines left stays, empty."""
    return _with_length(line_dedup.dedup_lines(docs).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the document with the smallest id stays.

    Texts without words, and rows without an id, are in no group and stay.
    """
    ship(spark)
    return jaccard.keep_smallest(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    leaks = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return decontaminate.without_leaks(docs, leaks).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left."""
    ship(spark)
    return bpe.op9(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{k}")
    return docs
