from __future__ import annotations

import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from linespan.operators.governance import now_utc
from linespan.plans import landed, refresh
from linespan.schemas import FEED_COLUMNS, RUN_SCHEMA, STAGE_EXPORT
from linespan.session import run_folder
from linespan.sources import catalogue, feed, landing
from linespan.sources.store import Store


def land(folder, name, day, route):
    """One archive with a row in every table, and the metadata beside it."""
    path = folder / f"{name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for table, columns in FEED_COLUMNS.items():
            values = [route if c == "route_id" else "20240101" if "date" in c else "1" for c in columns]
            archive.writestr(f"{table}.txt", ",".join(columns) + "\n" + ",".join(values) + "\n")
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    sidecar = {
        "source_url": "https://feed.example", "downloaded_at_utc": f"2024-01-{day:02d}T03:04:05Z",
        "file_name": path.name, "file_size_bytes": path.stat().st_size, "sha256": digest,
        "last_modified": "", "etag": "",
    }
    (folder / f"{name}.json").write_text(json.dumps(sidecar))


def test_landed_archives_are_refreshed_in_order_and_skipped_when_done(spark, tmp_path, monkeypatch):
    store, calls, unpacked, scanned = Store(spark, run_folder(spark, "wh")), [], [], []
    inflate, scans = landing.unpacked, feed.scans

    def counted(spark, archives, folder):
        unpacked.append(archives.count())
        return inflate(spark, archives, folder)

    monkeypatch.setattr(landing, "unpacked", counted)
    monkeypatch.setattr(feed, "scans", lambda spark, path: scanned.append(path) or scans(spark, path))

    def exported(spark, store, snapshot, feed, root, force=False, as_of=None):
        """Gate and registry of the real refresh; the export is recorded, not made."""
        registered = refresh.register(store, snapshot)
        key = snapshot.first().snapshot_key
        runs = store.read(refresh.RUN_EVENTS) if store.exists(refresh.RUN_EVENTS) else spark.createDataFrame([], RUN_SCHEMA)
        if catalogue.snapshot_gate(snapshot.select("sha256"), registered, runs, force).first().action == "SKIP":
            return None
        calls.append((key, feed(key, "routes").select("route_id", "source_row_number").collect()))
        row = [(len(calls), key, STAGE_EXPORT, "Spark", None, "SUCCEEDED", now_utc(), now_utc(), 1, 1, 0, None)]
        store.append(refresh.RUN_EVENTS, spark.createDataFrame(row, RUN_SCHEMA))
        return snapshot

    def run(**options):
        return landed.refresh_landed(
            spark, store, str(tmp_path), "Example", "/unused", refresh=exported, **options
        )

    land(tmp_path, "later", 9, "R9")
    land(tmp_path, "first", 2, "R2")
    assert list(run()) == [1, 2]
    assert [(k, [tuple(r) for r in rows]) for k, rows in calls] == [(1, [("R2", 2)]), (2, [("R9", 2)])]
    profiles = store.read(landed.PROFILES)
    assert profiles.count() == 2 * sum(map(len, FEED_COLUMNS.values()))

    # Nothing new: both are skipped, and no file is unpacked or read. A third archive is the only one that runs.
    assert unpacked == [2]
    scanned.clear()
    assert run() == {1: None, 2: None} and len(calls) == 2
    assert unpacked == [2] and scanned == []
    land(tmp_path, "third", 20, "R20")
    done = run()
    assert [k for k, v in done.items() if v is not None] == [3] and len(calls) == 3
    assert store.read(refresh.SNAPSHOTS).select("snapshot_key").distinct().count() == 3
    run(force=True)
    assert [k for k, _ in calls[3:]] == [1, 2, 3]
    assert unpacked == [2, 1]
    # Without its export a publication resumes from the files unpacked before.
    store.remove(refresh.RUN_EVENTS)
    assert all(v is not None for v in run().values()) and unpacked == [2, 1]


def test_members_of_one_archive_are_separate_tasks(spark, tmp_path):
    land(tmp_path, "feed", 2, "R1")
    members = landing.unpacked(spark, landing.archive_identity(spark, f"{tmp_path}/*.zip"), str(tmp_path / "text"))
    tasks = members.select("table_name", F.spark_partition_id().alias("task")).collect()
    assert len(tasks) == len(FEED_COLUMNS) and len({r.task for r in tasks}) > len(FEED_COLUMNS) // 2


def test_archives_without_metadata_or_members_are_refused(spark, tmp_path):
    land(tmp_path, "feed", 2, "R1")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as archive:
        archive.writestr("agency.txt", "agency_id\n1\n")
    store = Store(spark, run_folder(spark, "wh"))
    with pytest.raises(landed.LandingError, match="no metadata for empty.zip"):
        landed.refresh_landed(spark, store, str(tmp_path), "Example", "/unused")
    digest = hashlib.sha256((tmp_path / "empty.zip").read_bytes()).hexdigest()
    (tmp_path / "empty.json").write_text(
        json.dumps({"downloaded_at_utc": "2024-01-02T00:00:00Z", "sha256": digest})
    )
    with pytest.raises(landed.LandingError, match="calendar.txt"):
        landed.refresh_landed(spark, store, str(tmp_path), "Example", "/unused")
    assert landed.landed_archives(spark, str(tmp_path)).where(F.col("file_name") == "empty.zip").count() == 1
