from __future__ import annotations

import hashlib
import json
import os
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from linespan.schemas import FEED_COLUMNS
from linespan.sources import catalogue, feed, landing, profile


def write(folder, table, text):
    path = os.path.join(folder, f"{table}.txt")
    with open(path, "w", encoding="utf-8", newline="") as handle:
        handle.write(text)
    return str(folder)


EXCEPTIONS = "service_id,date,exception_type\nV1,20240101,1\n V2 ,20240102,\n"


def test_read_by_name_with_bom_extra_and_reordered_columns(spark, tmp_path):
    text = '﻿extra,exception_type,service_id,date\nx,1,"V,1",20240101\ny,,"say ""hi""",20240102\n'
    rows = feed.read_feed(spark, write(tmp_path, "calendar_dates", text), "calendar_dates")
    assert rows.columns == list(FEED_COLUMNS["calendar_dates"])
    assert {tuple(r) for r in rows.collect()} == {
        ("V,1", "20240101", "1"), ('say "hi"', "20240102", None),
    }


def test_quoted_line_break_is_one_record(spark, tmp_path):
    text = 'service_id,date,exception_type\n"V\n1",20240101,1\nV2,20240102,2\n'
    folder = write(tmp_path, "calendar_dates", text)
    rows = feed.stage(spark, folder, "calendar_dates", 7).collect()
    assert {(r.source_row_number, r.service_id, r.date) for r in rows} == {
        (2, "V\n1", "20240101"), (3, "V2", "20240102"),
    }


def test_files_of_different_column_order(spark, tmp_path):
    folder = tmp_path / "calendar_dates.txt"
    folder.mkdir()
    (folder / "a.csv").write_text("service_id,date,exception_type\nV1,20240101,1\n")
    (folder / "b.csv").write_text('exception_type,service_id,date\n2,"V\n2",20240102\n')
    rows = feed.read_feed(spark, str(tmp_path), "calendar_dates")
    assert {tuple(r) for r in rows.collect()} == {("V1", "20240101", "1"), ("V\n2", "20240102", "2")}
    staged = feed.stage(spark, str(tmp_path), "calendar_dates", 1)
    assert {(r.service_id, r.source_row_number) for r in staged.collect()} == {("V1", 2), ("V\n2", 2)}


def test_missing_column_is_an_error(spark, tmp_path):
    folder = write(tmp_path, "calendar_dates", "service_id,date\nV1,20240101\n")
    with pytest.raises(feed.FeedError, match="exception_type"):
        feed.read_feed(spark, folder, "calendar_dates")


def test_malformed_records_are_found_and_stop_the_load(spark, tmp_path):
    text = EXCEPTIONS + "V3,20240103\nV4,20240104,1,extra\n"
    folder = write(tmp_path, "calendar_dates", text)
    scanned = feed.scan(spark, f"{folder}/calendar_dates.txt")
    assert {r.service_id for r in feed.malformed_rows(scanned).collect()} == {"V3", "V4"}
    with pytest.raises(PySparkException, match="malformed"):
        feed.read_feed(spark, folder, "calendar_dates").collect()
    shape = profile.profile_structure(spark, folder, ["calendar_dates"]).first()
    assert (shape.row_count, shape.malformed_row_count, shape.column_count) == (4, 2, 3)
    assert shape.uncompressed_bytes == os.path.getsize(f"{folder}/calendar_dates.txt")


def test_lineage_of_staged_rows(spark, tmp_path):
    folder = write(tmp_path, "calendar_dates", EXCEPTIONS)
    rows = feed.stage(spark, folder, "calendar_dates", 7).orderBy("source_row_number").collect()
    assert [r.source_row_number for r in rows] == [2, 3]
    assert rows[1].exception_type is None and rows[1].service_id == " V2 "
    assert rows[1].row_hash == hashlib.sha256(b" V2 \x1f20240102\x1f").hexdigest()
    assert {r.snapshot_key for r in rows} == {7}


def test_row_numbers_across_file_splits(spark, tmp_path):
    lines = [f"V{i},20240101,1" for i in range(20000)]
    folder = write(tmp_path, "calendar_dates", "service_id,date,exception_type\n" + "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = feed.stage(spark, folder, "calendar_dates", 1)
        wrong = rows.where(
            F.col("source_row_number") != F.substring("service_id", 2, 9).cast("int") + 2
        )
        assert feed.scan(spark, f"{folder}/calendar_dates.txt").rdd.getNumPartitions() > 4
        assert rows.count() == 20000 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_row_numbers_do_not_depend_on_later_splits(spark, tmp_path):
    """Files are split otherwise between planning and reading; an aggregate of numbers alone works."""
    lines = [f"V{i},20240101,1" for i in range(30000)]
    folder = write(tmp_path, "calendar_dates", "service_id,date,exception_type\n" + "\n".join(lines))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "70000")
        rows = feed.stage(spark, folder, "calendar_dates", 1)
        spark.conf.set(key, "31000")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
        numbers = rows.agg(
            F.count("source_row_number"), F.min("source_row_number"), F.max("source_row_number"),
            F.count_distinct("source_row_number"),
        ).first()
        assert tuple(numbers) == (30000, 2, 30001, 30000)
        assert rows.where(F.col("source_row_number") != F.substring("service_id", 2, 9).cast("int") + 2).count() == 0
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_column_profile(spark, tmp_path):
    folder = write(tmp_path, "calendar_dates", EXCEPTIONS + "V333,20240103, \n")
    scanned = feed.scan(spark, f"{folder}/calendar_dates.txt")
    got = {r.column_name: r for r in profile.profile_columns(scanned, "calendar_dates").collect()}
    assert (got["service_id"].max_length, got["service_id"].blank_count) == (4, 0)
    assert got["exception_type"].blank_count == 2
    assert float(got["exception_type"].blank_percentage) == 66.6667
    assert profile.missing_files(["agency.txt", "stops.txt"])[0] == "calendar.txt"


def archive(folder, name, members):
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as target:
        for member, text in members.items():
            target.writestr(member, text.encode("utf-8"))
    return path


def test_archives_land_as_rows_and_register_once(spark, tmp_path):
    info = "feed_publisher_name,feed_publisher_url,feed_lang,feed_start_date,feed_end_date,feed_version\n"
    many = "service_id,date,exception_type\n" + "".join(
        f'V{i},20240101,"1"\n' for i in range(25000)
    )
    path = archive(
        tmp_path, "feed_1.zip",
        {"calendar_dates.txt": "﻿" + many,
         "feed_info.txt": info + "P,u,en,20240101,20240401,v9\nP,u,en,19990101,,v0\n",
         "notes.md": "ignored"},
    )
    digest = hashlib.sha256(open(path, "rb").read()).hexdigest()
    sidecar = {"source_url": "https://feed.example", "downloaded_at_utc": "2024-01-02T03:04:05+00:00",
               "file_name": "feed_1.zip", "file_size_bytes": os.path.getsize(path), "sha256": digest,
               "last_modified": "Mon, 01 Jan 2024 22:53:08 GMT", "etag": '"abc"'}
    (tmp_path / "feed_1.json").write_text(json.dumps(sidecar))

    identity = landing.archive_identity(spark, f"{tmp_path}/*.zip")
    assert identity.first().sha256 == digest and identity.first().file_size_bytes == os.path.getsize(path)
    assert identity.first().tables == ["calendar_dates", "feed_info"]
    members = landing.unpacked(spark, identity, f"{tmp_path}/text").collect()
    paths = {r.table_name: r.text_path for r in members}
    assert sorted(paths) == ["calendar_dates", "feed_info"]
    table = feed.stage_path(spark, paths["calendar_dates"], "calendar_dates", 1)
    assert table.count() == 25000
    assert table.agg(F.max("source_row_number")).first()[0] == 25001
    assert table.where("exception_type = '1'").count() == 25000
    names = {r.text_path: r.text_bytes for r in members}
    assert names[paths["calendar_dates"]] == os.path.getsize(paths["calendar_dates"])

    meta = landing.sidecars(spark, f"{tmp_path}/*.json").drop("file_name", "file_size_bytes")
    info_rows = feed.stage_path(spark, paths["feed_info"], "feed_info", 0).withColumn("sha256", F.lit(digest))
    registered = spark.createDataFrame([(41, "other")], "snapshot_key bigint, sha256 string")
    landed = identity.join(meta, "sha256")
    row = catalogue.snapshot_register(landed, info_rows, registered, "Example").first()
    assert (row.snapshot_key, row.feed_version, str(row.feed_start_date)) == (42, "v9", "2024-01-01")
    assert str(row.downloaded_at_utc) == "2024-01-02 03:04:05"
    assert str(row.source_last_modified_utc) == "2024-01-01 22:53:08"
    known = spark.createDataFrame([(42, digest)], "snapshot_key bigint, sha256 string")
    assert catalogue.snapshot_register(landed, info_rows, known, "Example").count() == 0
