"""The training-corpus pipeline: quality, near duplicates, benchmark leaks, privacy, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All stages but the last return the
columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearbook.llm.decontam import keep_unleaked
from yearbook.llm.jaccard import keep_one
from yearbook.llm.packing import pack
from yearbook.llm.privacy import sanitised
from yearbook.llm.quality import keep_clean
from yearbook.llm.tables import bounded, written

TOKENIZER = "word_bpe_49k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep. Null, empty and blank texts go; each repeated row is judged for itself; an empty table stays empty."""
    return keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that of the smallest id; of equal rows one. Null and blank texts link with nothing and stay; an empty table stays empty."""
    return keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the table ``benchmark``. Null and blank texts hold none; repeated rows go or stay together; empty tables are taken."""
    return keep_unleaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what gives it away masked; ``n_chars`` follows. Null texts stay null; repeated rows stay; an empty table stays empty."""
    masked = sanitised(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.select(*(F.length("text").cast(kind).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))
    return masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their token ids. Null and empty texts are the end id alone; repeated rows are documents of their own; an empty table has no pieces."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


def _bounded(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(bounded(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", _bounded(quality_rules)),
    ("near duplicates", _bounded(near_duplicates)),
    ("benchmark decontamination", _bounded(benchmark_leaks)),
    ("privacy", _bounded(privacy)),
    ("packing", _bounded(packing)),
]

#: Tokenizing and shingle components can't be written in SQL; tests hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    name, stage = STAGES[-1]
    return written(stage(spark, docs, sf_dir), f"pipeline-{name}")[0]
