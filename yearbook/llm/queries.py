"""One query for each operator, over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearbook.llm.conversations import damaged, digests, repair
from yearbook.llm.decontam import leaks
from yearbook.llm.jaccard import near_duplicates
from yearbook.llm.language import languages
from yearbook.llm.oracle import ORACLE_SQL
from yearbook.llm.packing import pack
from yearbook.llm.privacy import KINDS, digest, sensitive_spans
from yearbook.llm.quality import repetition, verdicts
from yearbook.llm.sharding import shard
from yearbook.llm.tables import bounded, new_folder
from yearbook.llm.tokencount import token_counts
from yearbook.llm.tokenfile import read_tokens, write_tokens
from yearbook.llm.toxicity import toxicity
from yearbook.llm.urls import Rule, judge_urls
from yearbook.llm.whitening import quantised, whiten
from yearbook.session import temporary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sensitive_spans(_table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    base = digest(F.filter("spans", lambda s: s["kind"].isin(*KINDS)))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    read = read_tokens(spark, temporary(spark, folder))
    n = (F.octet_length("ids") / 4).cast("bigint")
    return read.select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = verdicts(repetition(_table(spark, sf_dir, "documents")))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*first, *(c for c in found.columns if c not in first))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(_table(spark, sf_dir, "documents"), shards=16)
    columns = ("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
    return placed.select(*columns)


def op7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _beside(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that may be null."""
    other = right.withColumnRenamed(key, "other_key")
    return left.join(other, left[key].eqNullSafe(other["other_key"]), "left").drop("other_key")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    report, repaired = repair(damaged(rows))
    found = _beside(_beside(rows.select("conv_id").distinct(), report, "conv_id"), digests(repaired), "conv_id")
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


#: The rules of ``op12_url_filters``.
URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(quantised(_table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_privacy": op1_privacy,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_token_files": op4_token_files,
    "op5_quality": op5_quality,
    "op6_sharding": op6_sharding,
    "op7_languages": op7_languages,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_conversations": op11_conversations,
    "op12_url_filters": op12_url_filters,
    "op13_whitening": op13_whitening,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
