"""What one task of a corpus operator holds at once, and what its steps move and keep on disk."""

from __future__ import annotations

import os
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from linespan.llm import byte_bpe, near_dedup
from linespan.llm.common import collecting


def test_encoder_holds_small_matrices_and_gives_the_same_ids(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abab": 257}
    encoder = byte_bpe.Encoder(ranks, r"\S+|\s+")
    cells, merge = [], encoder._merge_matrix

    def recorded(pieces):
        cells.append(len(pieces) * max(map(len, pieces)))
        return merge(pieces)

    monkeypatch.setattr(encoder, "_merge_matrix", recorded)
    words = [f"ab{number:010d}abab" for number in range(40_000)]
    (ids,) = encoder.encode([" ".join(words)])
    assert max(cells) <= 1 << 18
    assert len(cells) > 1
    first = [256, *b"0000000000", 257]
    assert ids[: len(first)].tolist() == first
    assert len(ids) == 40_000 * len(first) + 39_999
    assert ids.dtype == np.int32
    assert byte_bpe.TEXT_AT_ONCE <= 1 << 20 and byte_bpe.CACHED_PIECES <= 120_000


def test_near_dedup_moves_no_sketch_of_a_text_without_copies(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(400)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(9)] + [(2000, None), (2001, " "), (None, rows[0][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    joined, join = [], type(frame).join

    def recorded(left, right, *keys):
        joined.extend(side.count() for side in (left, right) if "sketch" in side.columns)
        return join(left, right, *keys)

    stored = near_dedup.settle(
        frame.select(F.monotonically_increasing_id().alias("row_key"), F.col("doc_id").alias("id"), "text"), "t"
    )
    monkeypatch.setattr(type(frame), "join", recorded)
    with collecting() as made:
        groups = near_dedup.near_groups(stored)
    assert joined and sum(joined) < 40
    got = Counter(map(tuple, groups.select("id", "n_shingles", "component_id").collect()))
    want = Counter((i, 36, i) for i in range(400)) + Counter((1000 + i, 36, i % 3) for i in range(9))
    assert got == want + Counter([(2000, 0, 2000), (2001, 0, 2001), (None, 36, 0)])
    # Sketches are gone from the shared folder when the groups are returned.
    kept = {os.path.basename(p).rpartition("-")[0] for p in made if os.path.exists(p.removeprefix("file:"))}
    assert "near-sketches" not in kept and "near-representatives" not in kept


def test_near_dedup_keeps_its_copy_of_the_rows_in_zstd(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    with collecting() as made:
        assert near_dedup.kept_rows(frame).count() == 2
    (path,) = (p for p in made if "near-docs" in p)
    assert spark.read.parquet(path).inputFiles()[0].endswith(".zstd.parquet")
