"""From raw documents to a training mix: each stage works on all that its predecessor kept.

Defined results of every stage: null and empty texts have no words, so the quality rules reject them, and the
later stages keep such rows where they get any; texts are judged whole, however long; rows without a doc_id are
judged each by its own text and never grouped; repeated rows get equal verdicts; an empty table stays empty; all
columns of the documents come through, also those named like an operator's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, jaccard, mixing, quality, secret_scan, sql
from tickloom.llm.common import stored, table
from tickloom.llm.queries import mix_domain

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the learned list reject; without labels of both kinds, the base rules alone."""
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of five-word shingle sets at 0.8 and more.

    Of equal rows with one doc_id one stays; rows without a doc_id or without words all stay.
    """
    return jaccard.keep_one(docs, width=5, percent=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs; items without words match nothing."""
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), into="_contamination")
    return judged.where("NOT _contamination.contaminated").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by their kind; every document stays, with its new length (null stays null)."""
    return secret_scan.redact(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document and epoch of the production mix; null languages and sources are leaves of their own."""
    return mixing.mix(docs, mix_domain(), sql.MIX_WEIGHTS, sql.MIX_SHARE, sql.MIX_EPOCHS, sql.MIX_SEED)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", without_benchmarks),
    ("secret_scans", mask_secrets), ("source_mix", mix_sources),
]

#: Learned rules, masking and similarity joins have no SQL form; tests hold the run against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
