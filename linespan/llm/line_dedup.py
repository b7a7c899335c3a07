"""Line deduplication with two Bloom filters.

The first pass puts the hash of every line key of a document into a once-seen
and a twice-seen filter. The second pass sends only lines whose hash is in the
twice filter, the suspected repeats, through a shuffle, where they are counted
by their full key. Keys found in at least ``min_documents`` rows are confirmed;
their lines go from every document (``keep="none"``) or from all but the first
occurrence (``keep="first"``: smallest identifier, null last, then the row
stored first).

A key is a line without white space at both ends, with A-Z in lower case.
Empty keys are never dropped. A null or empty text is one empty line. Repeated
rows are documents of their own. Very long texts and lines are compared whole.
An empty table gives no rows. Only the named columns are read, so further
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.llm import bloom
from linespan.llm.common import settle, tidy

MIN_DOCUMENTS = 10
BITS_PER_LINE = 16
PROBES = 4


def line_keys(text: bytes | None) -> dict[bytes, list[int]]:
    """Line numbers of every non-empty key of a text."""
    found: dict[bytes, list[int]] = {}
    for number, line in enumerate((text or b"").split(b"\n")):
        # Of bytes, strip and lower know exactly the white space and letters meant.
        key = line.strip().lower()
        if key:
            found.setdefault(key, []).append(number)
    return found


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _hashes(keys) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)


def suspects(stored: DataFrame) -> DataFrame:
    """Lines whose hash was perhaps seen twice: row_key, id, key, lines."""
    spark = stored.sparkSession
    lines = stored.agg(F.sum("n_lines")).first()[0] or 0
    bits = bloom.filter_bits(lines * BITS_PER_LINE)

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_hashes(line_keys(text)) for batch in batches for text in _texts(batch)]
        yield from bloom.seen(found, bits, PROBES)

    filters = settle(bloom.merged(stored.select("text").mapInArrow(tidy(insert), bloom.PAYLOAD)), "line-filters")
    twice = spark.sparkContext.broadcast(bloom.gathered(filters, "twice", bits))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, numbers = [], [], []
            for row, text in enumerate(_texts(batch)):
                for key, places in line_keys(text).items():
                    rows.append(row)
                    keys.append(key)
                    numbers.append(places)
            hit = np.flatnonzero(bloom.contains(twice.value, _hashes(keys), bits, PROBES))
            take = pa.array([rows[i] for i in hit], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key").take(take), batch.column("id").take(take),
                    pa.array([keys[i] for i in hit], pa.binary()),
                    pa.array([numbers[i] for i in hit], pa.list_(pa.int32())),
                ],
                names=["row_key", "id", "key", "lines"],
            )

    kind = stored.schema["id"].dataType.simpleString()
    return settle(
        stored.select("row_key", "id", "text").mapInArrow(
            tidy(probe), f"row_key long, id {kind}, key binary, lines array<int>"
        ),
        "line-suspects",
    )


def dropped_lines(suspected: DataFrame, min_documents: int, keep: str) -> DataFrame:
    """Line numbers to drop per row, after exact confirmation."""
    # Written, so that the join after it has shuffles of its own and a hot key can be split.
    confirmed = settle(
        suspected.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.min(F.struct(F.col("id").isNull(), "id", "row_key")).getField("row_key").alias("first_row"),
        )
        .where(F.col("documents") >= min_documents)
        .select("key", "first_row"),
        "line-confirmed",
    )
    numbers = F.col("lines")
    if keep == "first":
        own = F.col("row_key") == F.col("first_row")
        numbers = F.when(own, F.slice("lines", F.lit(2), F.size("lines"))).otherwise(numbers)
    return (
        suspected.join(confirmed, "key")
        .groupBy("row_key")
        .agg(F.flatten(F.collect_list(numbers)).alias("gone"))
    )


def deduplicate(
    docs: DataFrame, *, identifier: Column, text: Column, min_documents: int = MIN_DOCUMENTS, keep: str = "none"
) -> DataFrame:
    """Return id, n_lines, n_dropped and kept_text per row."""
    stored = settle(
        docs.select(
            F.monotonically_increasing_id().alias("row_key"), identifier.alias("id"), text.alias("text"),
            (F.octet_length(F.coalesce(text, F.lit(""))) - F.octet_length(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(""))) + 1)
            .cast("long").alias("n_lines"),
        ),
        "line-docs",
    )
    gone = dropped_lines(suspects(stored), min_documents, keep)
    kind = stored.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts = [], []
            for text, numbers in zip(_texts(batch), batch.column("gone").to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                out = set(numbers or ())
                kept.append(b"\n".join([x for n, x in enumerate(lines) if n not in out]) if out else text or b"")
                counts.append(len(out))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("n_lines"), pa.array(counts, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["id", "n_lines", "n_dropped", "kept_text"],
            )

    return stored.join(gone, "row_key", "left").select("id", "n_lines", "text", "gone").mapInArrow(
        tidy(cut), f"id {kind}, n_lines long, n_dropped long, kept_text string"
    )
