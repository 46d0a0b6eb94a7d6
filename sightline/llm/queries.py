"""The registered queries of the operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import (
    alignment,
    chat,
    contamination,
    language,
    licences,
    mixing,
    neardup,
    oracles,
    packing,
    ring,
    topk,
    urls,
    warc,
    whitening,
)
from sightline.llm.common import table


def op1_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, folder, "pages"))


def op2_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return language.documents_languages(table(spark, folder, "documents"))


def op3_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    return ring.shard_documents(table(spark, folder, "documents"))


def op5_mix_flow(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(table(spark, folder, "documents"))


def op4_licence_digests(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    return found.withColumn("notices", F.array_join("notices", ","))


def op6_url_aliases(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages")).drop("alias_of")


def op7_leaks_by_edits(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_minhash_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), words=4)


def op9_topk_terms(spark: SparkSession, folder: str) -> DataFrame:
    return topk.nearest_vectors(table(spark, folder, "embeddings"))


# A conversation whose texts look like turn marks.
TRICKY = r"\### Assistant: </turn> ok"


def op10_chat_events(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    return chat.format_conversations(turns.unionByName(said))


def op11_match_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return packing.pack_documents(table(spark, folder, "documents"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of both tokenizers, per document."""
    return alignment.align_documents(table(spark, folder, "documents"))


def op13_feast_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Four whitened components of every usable vector."""
    return whitening.whiten_embeddings(table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The registered queries by name."""
    registered = (
        op1_warc_bundles,
        op2_language_mixture,
        op3_ring_shards,
        op4_licence_digests,
        op5_mix_flow,
        op6_url_aliases,
        op7_leaks_by_edits,
        op8_minhash_bayes,
        op9_topk_terms,
        op10_chat_events,
        op11_match_packing,
        op12_token_alignment,
        op13_feast_whitening,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return oracles.oracle_sql()
