"""A training corpus from `documents`: without toxic documents, near-duplicates and repeated passages,
mixed to target weights, encoded."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import bpe, mixing, simhash, substrings, toxicity
from roadpulse.llm.common import scratch_dir
from roadpulse.llm.vocabularies import byte_bpe


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more under a model of the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked by 2 bits or fewer."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of 13 words or more that a document of smaller doc_id has as well."""
    return substrings.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions of their weights, documents repeated up to three times."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document, as often as the mix has it."""
    found = bpe.round_trip(docs, byte_bpe())
    decoded = F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", decoded)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL has neither the learned model nor XXH64 nor the tokenizer's merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written to the shared scratch folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{scratch_dir(spark)}/corpus-{uuid.uuid4()}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
