"""Landing publications: identity of archives, members as text files, sidecar metadata.

Archives are opened by tasks where they lie, as streams: neither an archive nor a
member is ever held as one value, so their size is not limited. The unit of work is
one archive for its identity and one member for its text; after that Spark's
CSV reader splits the text files.
"""

from __future__ import annotations

import hashlib
import shutil
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linespan.functions.columns import feed_date
from linespan.schemas import FEED_COLUMNS

BLOCK = 1 << 20
IDENTITY_SCHEMA = (
    "path STRING, file_name STRING, file_size_bytes BIGINT, sha256 STRING, tables ARRAY<STRING>"
)
MEMBER_SCHEMA = "sha256 STRING, table_name STRING, text_path STRING, text_bytes BIGINT"
SIDECAR_SCHEMA = (
    "source_url STRING, downloaded_at_utc STRING, file_name STRING, file_size_bytes BIGINT, "
    "sha256 STRING, last_modified STRING, etag STRING"
)
HTTP_DATE = "dd MMM yyyy HH:mm:ss z"
HAS_OFFSET = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and place of a path as Spark names it."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path)


def _opened(path: str) -> pa.NativeFile:
    files, place = _place(path)
    return files.open_input_file(place)


def archive_identity(spark: SparkSession, path: str) -> DataFrame:
    """Path, name, size, SHA-256 and feed tables of each landed archive.

    Bytes are hashed in blocks; the tables come from the archive's directory.
    """

    def identified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name in batch["path"]:
                digest, size = hashlib.sha256(), 0
                with _opened(name) as source:
                    while block := source.read(BLOCK):
                        digest.update(block)
                        size += len(block)
                    source.seek(0)
                    with zipfile.ZipFile(source) as archive:
                        members = set(archive.namelist())
                tables = [table for table in FEED_COLUMNS if f"{table}.txt" in members]
                rows.append((name, name.rsplit("/", 1)[-1], size, digest.hexdigest(), tables))
            yield pd.DataFrame(rows, columns=["path", "file_name", "file_size_bytes", "sha256", "tables"])

    # Without its content column the source lists files and reads none.
    listed = spark.read.format("binaryFile").load(path).select("path")
    return listed.mapInPandas(identified, IDENTITY_SCHEMA)


def unpacked(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """Inflate every feed member of the archives to a text file below ``folder``.

    ``archives``: sha256, path, tables. Each member is one task. A member is inflated
    block by block, and its checksum is verified at its end. Names are new in
    every attempt; the rows returned, once written, name the files of those that succeeded.
    """

    def inflated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = _place(folder)
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                own = f"{row.sha256}/{row.table_name}-{uuid.uuid4().hex}.txt"
                files.create_dir(f"{root}/{row.sha256}", recursive=True)
                with _opened(row.path) as source, zipfile.ZipFile(source) as archive:
                    with archive.open(f"{row.table_name}.txt") as member:
                        with files.open_output_stream(f"{root}/{own}") as target:
                            shutil.copyfileobj(member, target, BLOCK)
                    size = archive.getinfo(f"{row.table_name}.txt").file_size
                rows.append((row.sha256, row.table_name, f"{folder}/{own}", size))
            yield pd.DataFrame(rows, columns=["sha256", "table_name", "text_path", "text_bytes"])

    members = archives.groupBy("sha256").agg(F.min_by(F.struct("path", "tables"), "path").alias("first")).select(
        "sha256", "first.path", F.explode("first.tables").alias("table_name")
    )
    # A few short rows; as many tasks as members.
    return members.repartition(max(1, members.count())).mapInPandas(inflated, MEMBER_SCHEMA)


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Download metadata written beside each archive."""
    return spark.read.schema(SIDECAR_SCHEMA).option("multiLine", True).json(path)


def utc_moment(text: Column) -> Column:
    """Zone-less UTC timestamp from ISO text or an HTTP date; blank is NULL.

    ISO text without an offset is taken as UTC.
    """
    given = F.nullif(F.trim(text), F.lit(""))
    plain = given.try_cast("timestamp_ntz")
    zoned = F.coalesce(
        given.try_cast("timestamp"),
        F.try_to_timestamp(F.substring(given, 6, 40), F.lit(HTTP_DATE)),
    )
    in_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), zoned.cast("timestamp_ntz"))
    named_day = given.rlike("^[A-Za-z]{3}, ")
    return F.when(given.rlike(HAS_OFFSET) | named_day, in_utc).otherwise(plain)


def first_feed_info(feed_info: DataFrame) -> DataFrame:
    """Feed dates and version from the first feed_info record of each file.

    ``feed_info`` has ``sha256`` and ``source_row_number`` beside its columns.
    """
    return feed_info.groupBy("sha256").agg(
        F.min_by(
            F.struct(
                feed_date("feed_start_date").alias("feed_start_date"),
                feed_date("feed_end_date").alias("feed_end_date"),
                F.nullif("feed_version", F.lit("")).alias("feed_version"),
            ),
            "source_row_number",
        ).alias("info")
    ).select("sha256", "info.*")
