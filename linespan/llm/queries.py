"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan.llm import (
    byte_bpe, exact_dedup, importance, language_id, line_dedup, mixing, near_dedup, quality_rules, sharding,
    substring_dedup, token_files, url_filter, whitening,
)
from linespan.llm.common import CODEC, documents, settle
from linespan.llm.oracle import ORACLE

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def op1_differencing_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return sharding.assign(docs, identifier=F.col("doc_id"), text=F.col("text")).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """A page's outcome is the label of the document its url numbers."""
    pages = documents(spark, folder, "pages").select("page_id", "url")
    labels = documents(spark, folder, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.coalesce("quality", "toxic").isNotNull(), 0
    )
    tail = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '/([0-9]+)[^/]*/?$', 1)"
    numbered = pages.select("page_id", F.expr(f"try_cast({tail} AS BIGINT)").alias("number"))
    outcomes = numbered.join(
        labels.select(F.col("doc_id").alias("number"), bad.alias("bad")).where("bad IS NOT NULL"), "number"
    ).select("page_id", "bad")
    return url_filter.judged(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op3_stream_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    _, verdicts = exact_dedup.deduplicate(documents(spark, folder).select("doc_id", "text"))
    return verdicts.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op4_bloom_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.deduplicate(documents(spark, folder), identifier=F.col("doc_id"), text=F.col("text"))
    return kept.select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op5_block_anchor_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.deduplicate(documents(spark, folder), identifier=F.col("doc_id"), text=F.col("text"))
    return kept.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op6_setsketch_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    stored = settle(
        documents(spark, folder).select(
            F.monotonically_increasing_id().alias("row_key"), F.col("doc_id").alias("id"), "text"
        ),
        "near-docs", CODEC,
    )
    groups = near_dedup.near_groups(stored)
    return groups.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    encoded = byte_bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN)
    ids = encoded.select("doc_id", "ids")
    return byte_bpe.decode(ids, VOCABULARY).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        byte_bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_ftrl_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Learn where crc32(doc_id) mod 4 is not 2; the language column is a label only."""
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs = documents(spark, folder)
    training = docs.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("label")
    )
    rows = docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out"))
    return language_id.predict(rows, language_id.trained(training), key=["doc_id", "held_out"], text=F.col("text"))


def op9_line_frequency_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select(
        F.struct(F.monotonically_increasing_id().alias("row"), "doc_id").alias("row_key"), "text", "source"
    )
    verdicts = quality_rules.judged(rows, key="row_key", text=F.col("text"), host=F.col("source"))
    return verdicts.select(F.col("row_key.doc_id").alias("doc_id"), "*").drop("row_key")


def op10_sainte_lague_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return mixing.mix(
        docs, key=["doc_id"], text=F.col("text"), source=F.col("source"), identifier=F.col("doc_id")
    ).select("doc_id", "size", "source_size", "target", "taken")


def op11_lanczos_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Deviations beyond a long, which need vectors far from any usual scale, are null."""
    vectors = documents(spark, folder, "embeddings")
    return whitening.whitened(vectors, key=["vec_id"], vector=F.col("embedding")).withColumn(
        "deviation", F.expr("try_cast(deviation AS BIGINT)")
    )


def op12_plane_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write(
        documents(spark, folder), identifier=F.col("doc_id"), text=F.col("text"), tokenizer=WORD_TOKENIZER,
        end_id=END_ID, drops_white=True,
    )
    return token_files.read(files).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op13_importance_resample(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(
        documents(spark, folder), documents(spark, folder, "benchmark"), key=["doc_id"],
        identifier=F.col("doc_id"), text=F.col("text"), target_text=F.col("text"),
    ).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    query.__name__: query
    for query in (
        op1_differencing_shards, op2_host_reputation, op3_stream_exact_dedup, op4_bloom_line_dedup,
        op5_block_anchor_dedup, op6_setsketch_near_dedup, op7_byte_bpe, op8_ftrl_language_id,
        op9_line_frequency_quality, op10_sainte_lague_mix, op11_lanczos_whitening, op12_plane_token_files,
        op13_importance_resample,
    )
}

__all__ = ["ORACLE", "QUERIES"]
