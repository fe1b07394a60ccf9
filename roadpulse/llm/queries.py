"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import (
    bpe, chat, digest, embeddings, html, infill, language, mixing, negatives, simhash, substrings, token_counts, toxicity,
)
from roadpulse.llm.common import held_out
from roadpulse.llm.vocabularies import byte_bpe


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


def op2_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op3_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe())
    return found.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.compare_with_next(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, F.size("offending").alias("n_offending"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.round_trip(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), byte_bpe())


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_embeddings, op2_perspectives, op3_weighted_mix, op4_substrings, op5_simhash, op6_main_text, op7_language, op8_bpe,
        op9_digest, op10_toxicity, op11_infill, op12_token_counts, op13_hard_negatives,
    )
    return {x.__name__: x for x in found}
