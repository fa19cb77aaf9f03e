"""The corpus pipeline: stages over documents, each written as Parquet and reread by the next.

Quality rules drop bad texts, the n-gram join keeps one document of each group of near copies, benchmark
decontamination drops texts that hold benchmark passages, the secret scan takes secrets out of texts,
and best-fit packing turns what is left into sequences. Every stage but the last returns the columns of
``documents``. Null texts fail the quality rules; an empty table stays empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import ngram_join, packing, quality, secret_ledger, winnow
from sensorloom.llm.common import small_batches, table, written
from sensorloom.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near-duplicate stages work on five words and a similarity of 0.8.
NEAR_COPIES = ngram_join.Join(size=5, least=80, over=100)


def _ready(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    small_batches(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return quality.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return ngram_join.one_of_each(docs, NEAR_COPIES)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return secret_ledger.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("secret scans", secrets),
    ("best-fit packing", packing_stage),
]
#: SQL expresses neither the tokenizer nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last written and read again."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
