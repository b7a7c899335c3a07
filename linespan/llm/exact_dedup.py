"""Exact deduplication with keyed streaming state.

The documents are stored once with a digest of their normalised text and a
content locator (the row's number in the stored copy). A stream over that copy
keeps, per digest and without expiry, the number of rows and the identifier
and locator of the row that stays. The state is on disk (RocksDB) and in the
checkpoint, so a lost executor or a restart loses nothing. Where the state
reports a hit, the full normalised bytes are compared with those the locator
points to (rows of a hot digest in several tasks, each with the head row); rows whose bytes differ in spite of equal digests are grouped by
their bytes.

The text with every character of ``[\\x20\\x09-\\x0D]`` deleted decides
equality; null counts as empty. Of equal texts the row with the most code
points stays, then the smallest identifier (null last), then the row stored
first, so of repeated rows exactly one stays. An empty table gives no rows.
Very long texts are compared whole. Names in ``docs`` cannot clash: its
columns are kept in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.llm.common import WHITE_CLASS, scratch_folder, setting, settle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# An instance preallocates files; closed after its commit, only those at work hold any.
UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"
# Micro-batches a run takes, about, at every size; later ones meet the stored state.
BATCHES = 4
# Rows of one digest that meet their head in one task: this many, or this share of all rows.
SALTED_ROWS, SALTED_SHARE = 100, 1 / 4096

RANK = "struct<shorter: bigint, no_id: boolean, id: {id}, locator: bigint>"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_CLASS, "")


def _rank() -> Column:
    """The smallest is the row that stays."""
    return F.struct(
        (-F.col("points")).alias("shorter"), F.col("id").isNull().alias("no_id"), "id", "locator"
    )


def store(docs: DataFrame, digest, *, text: str = "text", identifier: str = "doc_id") -> str:
    """Write the located copy of the documents and return its folder."""
    content = F.col(f"`{text}`")
    located = docs.select(
        F.monotonically_increasing_id().alias("locator"),
        F.col(f"`{identifier}`").alias("id"),
        F.char_length(F.coalesce(content, F.lit(""))).cast("long").alias("points"),
        F.sha2(normalised(content), 256).alias("text_sha256"),
        F.struct("*").alias("doc"),
    )
    folder = scratch_folder(docs.sparkSession, "exact-copy")
    located.withColumn("digest", digest(normalised(F.col(f"doc.`{text}`")), F.col("text_sha256"))).write.parquet(
        folder
    )
    return folder


def trigger_bytes(stored: DataFrame, batches: int = BATCHES) -> int:
    """Bytes of a micro-batch so that the stored files give about ``batches`` of them."""
    files = stored.select("_metadata.file_path", "_metadata.file_size").distinct()
    return -(-(files.agg(F.sum("file_size")).first()[0] or 1 << 30) // batches)


def digest_state(spark, folder: str, bytes_per_trigger: int | None = None) -> DataFrame:
    """Run the stream to the end of the stored copy; one row per digest.

    Without ``bytes_per_trigger`` the copy is taken in about ``BATCHES`` parts.

    Every micro-batch adds the digests it changed, under its own number, so a
    batch that runs again replaces its rows. Counts only grow, so a digest's
    row with the highest count is its state.
    """
    stored = spark.read.parquet(folder)
    thin = stored.select("digest", "points", "id", "locator")
    bytes_per_trigger = bytes_per_trigger or trigger_bytes(stored)
    arriving = (
        spark.readStream.schema(thin.schema).option("maxBytesPerTrigger", str(bytes_per_trigger)).parquet(folder)
    )
    state = arriving.groupBy("digest").agg(F.count(F.lit(1)).alias("seen"), F.min(_rank()).alias("stays"))
    changed = scratch_folder(spark, "exact-state")
    empty = spark.createDataFrame([], state.schema)
    empty.write.parquet(f"{changed}/batch=-1")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changed}/batch={number}")

    with setting(spark, PROVIDER, ROCKSDB), setting(spark, UNLOAD, "true"):
        run = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", scratch_folder(spark, "exact-checkpoint"))
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
        run.awaitTermination()
    written = spark.read.schema(state.schema).parquet(changed)
    return written.groupBy("digest").agg(
        F.max("seen").alias("seen"), F.max_by("stays", "seen").alias("stays")
    )


def _to_salts(rows: DataFrame) -> DataFrame:
    """Each row once for every salt of its digest."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))


def sha256_digest(content: Column, hexed: Column) -> Column:
    return F.unhex(hexed)


def deduplicate(
    docs: DataFrame, *, text: str = "text", identifier: str = "doc_id", digest=sha256_digest,
    bytes_per_trigger: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Return the located copy of the documents and one verdict per row of it.

    Verdicts: locator, id, text_sha256, keep_id, keep_locator, group_size, kept.
    """
    spark = docs.sparkSession
    folder = store(docs, digest, text=text, identifier=identifier)
    stored = spark.read.parquet(folder)
    state = digest_state(spark, folder, bytes_per_trigger)
    # A hot digest is dealt to several salts, and its one head row goes to each of them.
    share = max(SALTED_ROWS, int(stored.count() * SALTED_SHARE))
    hits = settle(
        state.where("seen > 1").select(
            "digest", F.col("stays.locator").alias("head_locator"),
            F.ceil(F.col("seen") / share).cast("int").alias("salts"),
        ),
        "exact-heads",
    )
    # Fewer than 1 / SALTED_SHARE digests hold more rows than the share.
    hot = F.broadcast(hits.where("salts > 1").select("digest", "salts"))
    place = F.pmod(F.xxhash64("locator"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt")
    members = settle(
        stored.select("digest", "locator", "id", "points", normalised(F.col(f"doc.`{text}`")).alias("content"))
        .join(hot, "digest", "left")
        .select("digest", "locator", "id", "points", "content", place)
        .join(_to_salts(hits).hint("merge"), ["digest", "salt"]),
        "exact-hits",
    )
    heads = members.where("locator = head_locator").select(
        "digest", "salts", F.col("content").alias("head_content")
    )
    checked = settle(
        members.drop("salts").join(_to_salts(heads), ["digest", "salt"]).select(
            "digest", "salt", "salts", "locator", "id", "points",
            F.when(F.col("content") != F.col("head_content"), F.col("content")).alias("variant"),
        ),
        "exact-checked",
    )
    groups = settle(
        checked.groupBy("digest", "variant").agg(
            F.count(F.lit(1)).alias("group_size"), F.min(_rank()).alias("stays"), F.max("salts").alias("salts")
        ),
        "exact-groups",
    )
    dealt = _to_salts(groups).hint("merge")
    same = (
        (checked["digest"] == dealt["digest"]) & (checked["salt"] == dealt["salt"])
        & checked["variant"].eqNullSafe(dealt["variant"])
    )
    assigned = checked.join(dealt, same).select(
        checked["locator"], "group_size",
        F.col("stays.id").alias("keep_id"), F.col("stays.locator").alias("keep_locator"),
    )
    rows = stored.select("locator", "id", "text_sha256").join(assigned, "locator", "left")
    alone = F.col("group_size").isNull()
    verdicts = rows.select(
        "locator", "id", "text_sha256",
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("keep_locator", "locator").alias("keep_locator"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_locator") == F.col("locator"))).alias("kept"),
    )
    return stored, verdicts


def kept_rows(docs: DataFrame, *, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """Return the rows that stay, with the columns of ``docs``."""
    stored, verdicts = deduplicate(docs, text=text, identifier=identifier)
    return stored.join(verdicts.where("kept"), "locator", "left_semi").select("doc.*")


__all__ = ["deduplicate", "digest_state", "kept_rows", "normalised", "sha256_digest", "store", "trigger_bytes"]
