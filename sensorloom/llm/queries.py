"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and SQL for some of them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import (
    bloom_lm,
    collocations,
    feistel_pii,
    html_main,
    lang_cnn,
    ngram_join,
    packing,
    quality,
    secret_ledger,
    topk,
    turns,
    warc,
    winnow,
)
from sensorloom.llm.common import small_batches, table
from sensorloom.session import ship_package

#: Any text; whoever knows it can undo the pseudonyms. A real run takes it from its own secret store.
PSEUDONYM_KEY = "key of the queries on synthetic tables"

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        small_batches(spark)
        return build(spark, sf_dir)

    LLM_QUERIES[build.__name__] = run
    return run


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.digest(ngram_join.joined(table(spark, sf_dir, "documents")))


@query
def op2_secret_ledger(spark, sf_dir):
    ledger = secret_ledger.BlobLedger(spark)
    paths = ledger.update(table(spark, sf_dir, "documents"))
    return secret_ledger.digest(ledger.findings(paths))


@query
def op3_quality_divergence(spark, sf_dir):
    return quality.verdicts(table(spark, sf_dir, "documents"))


@query
def op4_feistel_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return feistel_pii.pseudonymised(docs, PSEUDONYM_KEY)


@query
def op5_byte_cnn(spark, sf_dir):
    return lang_cnn.identified(table(spark, sf_dir, "documents"))


@query
def op6_bloom_lm(spark, sf_dir):
    return bloom_lm.scored(table(spark, sf_dir, "documents"))


@query
def op7_vector_best_fit(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_warc_dictionary(spark, sf_dir):
    return warc.digest(warc.archived(table(spark, sf_dir, "pages")))


@query
def op9_winnowing(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return winnow.digest(*winnow.judged(docs, items))


@query
def op10_text_tag_ratio(spark, sf_dir):
    return html_main.extracted(table(spark, sf_dir, "pages"))


@query
def op11_collocation_tiles(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_histogram_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op13_viterbi_repair(spark, sf_dir):
    return turns.repaired(table(spark, sf_dir, "conversations"))
