"""A corpus pipeline of five stages over documents.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps, with the
columns of documents; the last returns tokens. The stages are written to the
shared folder one by one, so lost executors cost a re-read.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan.llm import byte_bpe, exact_dedup, mixing, near_dedup, quality_rules
from linespan.llm.common import collecting, delete_folder, discard, documents, settle
from linespan.llm.queries import VOCABULARY


# Folders whose stage result nobody holds any more.
_released: list[str] = []


def stage(work: Callable) -> Callable:
    """Tie the folders a stage writes to the frame it returns.

    They are deleted by the first stage called after that frame is gone; so keep it while frames made
    from it are read. Results of other calls, over the same or other documents, are not touched.
    """

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _released:
            delete_folder(spark, _released.pop())
        with collecting() as made:
            rows = work(spark, docs, sf_dir)
        # A lazy result may still read the documents.
        rows.read_from = docs
        weakref.finalize(rows, _released.extend, tuple(made))
        return rows

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.kept_rows(docs)


@stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.kept_rows(docs)


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.kept_rows(docs)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of what they decode to."""
    rows = docs.select("doc_id", "lang", "source", "text")
    encoded = byte_bpe.encode(rows, VOCABULARY, public_tokenizers.PATTERN).drop("text")
    return byte_bpe.decode(encoded, VOCABULARY).select(
        "doc_id", "lang", "source", "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        byte_bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing to target weights", mixed),
    ("byte-level BPE", tokens),
]

# Token ids and the streaming state have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    for number, (_, work) in enumerate(STAGES, 1):
        before, rows = rows, work(spark, rows, sf_dir)
        if number < len(STAGES):
            rows = settle(rows, f"pipeline-{number}")
            if number > 1:
                discard(before)
    return rows
