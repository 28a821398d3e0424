"""Registered queries of the operators: ``name -> f(spark, sf_dir)``, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, jaccard, langid, licences, main_text, mixing, personal, quality, repair, secret_scan, sql, tokens, trie, urls
from tickloom.llm.common import stored, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = sql.QUERIES
#: The vocabulary whose pieces are counted: a file beside its tokenizer's library, never copied.
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[f.__name__] = f
    return f


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan(docs).select("doc_id", "secrets.*")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).select(
        "doc_id", *(F.col(f"counts.{n}") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "base_failed", "kept", "rule")


@query
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs).select("doc_id", "licence.*")


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, VOCABULARY).select("doc_id", "tokens.*")


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.main_text(pages).select("page_id", "url", "main.*")


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held_out)
    texts = langid.training_texts(docs.where(~F.col("held_out")))
    return langid.identify(docs, texts).select("doc_id", "held_out", "language.*")


def mix_domain() -> Column:
    out = F.lit("curated")
    for name, sources in sql.MIX_DOMAINS.items():
        out = F.when(F.col("source").isin(*sources), F.lit(name)).otherwise(out)
    return out


@query
def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix(docs, mix_domain(), sql.MIX_WEIGHTS, sql.MIX_SHARE, sql.MIX_EPOCHS, sql.MIX_SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.decontaminate(docs, items).select("doc_id", "contamination.*")


@query
def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.classes(docs, width=4, percent=85)


@query
def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    proposed = stored(personal.propose(docs).drop("text"), "personal-candidates")
    return personal.decide(proposed, personal.fit(proposed)).select("doc_id", "personal.*")


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with drops, repeats and changed rows, by a hash of each row's place; nulls are one space."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                        (F.crc32(place.cast("binary")) % 20).alias("code")).where("code != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.repaired(damaged(turns), turns)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*trie.rebuilt(table(spark, sf_dir, "conversations")))
