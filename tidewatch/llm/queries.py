"""The operators applied to the sample tables, one query for each, and SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    collocations, conversation_trie, decontamination, embedding_dedup, minhash_dedup, mixing, oracles, packing, pii,
    quality, substring_dedup, suffix_dedup, token_counts, url_filter,
)
from tidewatch.staging import stage

#: The model file whose pieces op5 counts; another one may be named in the session.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
#: The model file of op12; another one may be named in the session.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.vocabulary(spark.conf.get("tidewatch.tokenizer", TOKENIZER))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("mark")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), spark.conf.get("tidewatch.byte_bpe", BYTE_BPE))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = stage(conversation_trie.paths(table(spark, sf_dir, "conversations")), "paths")
    return conversation_trie.trie(conversation_trie.grafted(own))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality, op2_pii, op3_suffix_dedup, op4_mixing, op5_token_counts, op6_url_filter,
            op7_decontamination, op8_embedding_dedup, op9_minhash_dedup, op10_substring_dedup,
            op11_collocations, op12_packing, op13_conversation_trie,
        )
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
