"""A corpus from raw documents, in stages that each read what the one before has written.

1. quality: documents that the byte-level network rejects go;
2. near_duplicates: of a group of near copies the document with the smallest id stays;
3. decontamination: documents that hold a benchmark item go;
4. pii: personal data become their kind in brackets;
5. mixture: the mix is written, in a folder for each output shard; the stage's table is each document
   with the words that the mix takes of it.

All stages but the last keep the columns of documents. Nulls, empty texts and repeated rows are treated
as the operators state; a null ``doc_id`` has no near copies, and rows that share an id stay or go as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontamination, minhash_dedup, mixing, pii, quality
from tidewatch.staging import stage

#: The model is numpy's and links are confirmed on sets of hashes; tests compare with brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(docs)
    gone = stage(found.where("not kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["doc_id"], "left_anti")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str, out: str | None = None) -> DataFrame:
    return mixing.mix(docs, out)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", redacted),
    ("mixture", mixed),
]


def run(spark: SparkSession, sf_dir: str, out: str | None = None) -> DataFrame:
    """All stages over the documents of a folder; the mix is written to ``out``, or beside the stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir, out) if step is mixed else step(spark, docs, sf_dir), name)
    return docs
