"""Substring deduplication with fixed-block anchors.

A window of ``WINDOW`` words that occurs again holds, at its other place, a
whole aligned block of ``BLOCK`` words (20 >= 2 * 10 - 1). So the index takes
only the non-overlapping blocks of every document, every rolling block-sized
window of every document probes it, and hits are extended to windows:

1. Equal texts are one class, counted before the shuffle. The copy with the
   smallest identifier is the document that is searched; later copies repeat it
   whole, so all their words go if it has a window at all.
2. Block hashes go into a once-seen and a twice-seen Bloom filter.
3. Rolling windows off the block grid that hit the once filter go into a third.
4. A repeated window holds blocks of its own grid, which the other place probes
   or repeats as blocks, and a block of the other place's grid, which it probes
   itself. Only windows for which the filters confirm both are taken, with a
   128-bit digest of their own words. These are grouped exactly; every
   occurrence but the first marks its words, and overlapping marks are maximal
   repeats.

The filters only choose what is compared, and miss nothing; their bounded size
decides how many windows that do not repeat are sent along.

First means smallest identifier (null last), then smallest start. Rows that
share an identifier and start tie: neither goes. Null and empty texts have no
words. Very long texts are searched whole. An empty table gives no rows. Only
the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.llm import bloom
from linespan.llm.common import discard, settle, tidy, words_of
from linespan.llm.exact_dedup import SALTED_ROWS, SALTED_SHARE
from linespan.llm.near_dedup import mixed, windows

WINDOW = 20
BLOCK = 10
PROBES = 5
# Bits per byte of text: about 60 bytes of text make a block, a block gets 20 bits.
BITS_PER_BYTE = 1 / 3
TO_SPACE = bytes.maketrans(b"\t\n\x0b\f\r", b"     ")
# Powers of an odd number and their inverses, for hashes of the bytes of a word.
BASE = 0x5851F42D4C957F2D
POWERS = np.multiply.accumulate(np.full(1 << 16, BASE, np.uint64))
INVERSES = np.multiply.accumulate(np.full(1 << 16, pow(BASE, -1, 1 << 64), np.uint64))


class Words:
    """The words of a text, as places in its bytes with one space between words."""

    def __init__(self, text: bytes) -> None:
        raw = text.translate(TO_SPACE)
        if b"  " in raw or raw[:1] == b" " or raw[-1:] == b" ":
            raw = b" ".join(raw.split())
        self.raw = raw
        self.bytes = np.frombuffer(raw, np.uint8)
        gaps = np.flatnonzero(self.bytes == 32)
        some = 1 if raw else 0
        self.begin = np.concatenate([np.zeros(some, np.int64), gaps + 1])
        self.end = np.concatenate([gaps, np.full(some, len(raw), np.int64)])

    def __len__(self) -> int:
        return len(self.begin)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word; only filters depend on it."""
        parts, low = [], 0
        while low < len(self):
            start = self.begin[low]
            high = int(np.searchsorted(self.end, start + len(POWERS), "right"))
            if high == low:
                parts.append(np.array([xxhash.xxh3_64_intdigest(self.text(low, low + 1))], np.uint64))
                low += 1
                continue
            begin, end = self.begin[low:high] - start, self.end[low:high] - start
            sums = np.zeros(end[-1] + 1, np.uint64)
            np.cumsum(self.bytes[start : start + end[-1]] * POWERS[: end[-1]], out=sums[1:])
            parts.append(mixed((sums[end] - sums[begin]) * INVERSES[begin] + (end - begin).astype(np.uint64)))
            low = high
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def text(self, low: int, high: int) -> bytes:
        """Words ``low`` up to ``high``."""
        return self.raw[self.begin[low] : self.end[high - 1]]


def _words(batch: pa.RecordBatch) -> Iterator[Words]:
    for text in batch.column("text").cast(pa.binary()).to_pylist():
        yield Words(text or b"")


def block_filters(stored: DataFrame, bits: int) -> DataFrame:
    """Once and twice filters of the aligned blocks."""

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for words in _words(batch):
                if len(words) >= WINDOW:
                    found.append(windows(words.hashes(), BLOCK)[::BLOCK])
        yield from bloom.seen(found, bits, PROBES)

    return bloom.merged(stored.select("text").mapInArrow(tidy(insert), bloom.PAYLOAD))


def probe_filter(stored: DataFrame, bits: int, once) -> DataFrame:
    """Filter of the rolling windows off the grid that hit an indexed block."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for words in _words(batch):
                if len(words) >= WINDOW:
                    rolled = windows(words.hashes(), BLOCK)
                    rolled = rolled[np.arange(len(rolled)) % BLOCK != 0]
                    found.append(rolled[bloom.contains(once.value, rolled, bits, PROBES)])
        if found:
            hits = np.unique(np.concatenate(found))
            yield from bloom.payloads(hits, hits[:0], bits, PROBES)

    return bloom.merged(stored.select("text").mapInArrow(tidy(probe), bloom.PAYLOAD))


def likely_starts(hashes: np.ndarray, twice: np.ndarray, hits: np.ndarray, bits: int) -> np.ndarray:
    """Starts of the windows that may occur elsewhere, judged by the filters."""
    rolled = windows(hashes, BLOCK)
    grid = np.arange(len(rolled)) % BLOCK == 0
    probed = bloom.contains(hits, rolled, bits, PROBES)
    repeated = bloom.contains(twice, rolled[grid], bits, PROBES)
    known = repeated | probed[grid]
    start = np.arange(len(hashes) - WINDOW + 1)
    own = -(-start // BLOCK)
    # A window on the grid holds two blocks of its own, every other window one.
    second = np.where(start % BLOCK == 0, own + 1, own)
    before = np.concatenate([[0], np.cumsum(probed & ~grid)])
    crossed = before[start + WINDOW - BLOCK + 1] > before[start]
    return np.flatnonzero(known[own] & known[second] & (crossed | repeated[own] | repeated[second]))


def candidates(stored: DataFrame, bits: int, twice, hits) -> DataFrame:
    """Windows that may occur elsewhere: h1, h2 (digest of the words), id, row_key, start."""
    kind = stored.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, digests = [], [], []
            for row, words in enumerate(_words(batch)):
                if len(words) < WINDOW:
                    continue
                begin = likely_starts(words.hashes(), twice.value, hits.value, bits)
                raw = words.raw
                rows.append(np.full(len(begin), row))
                starts.append(begin)
                digests += [
                    xxhash.xxh3_128_digest(raw[low:high])
                    for low, high in zip(
                        words.begin[begin].tolist(), words.end[begin + WINDOW - 1].tolist(), strict=True
                    )
                ]
            take = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column("id").take(take),
                    batch.column("row_key").take(take),
                    pa.array(np.concatenate(starts) if starts else [], pa.int32()),
                ],
                names=["h1", "h2", "id", "row_key", "start"],
            )

    return stored.select("id", "row_key", "text").mapInArrow(
        tidy(run), f"h1 long, h2 long, id {kind}, row_key long, start int"
    )


def repeated_starts(found: DataFrame) -> DataFrame:
    """Starts of the windows, per row, whose words also start earlier."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "start")
    # Written, so that the join after it has shuffles of its own and a hot passage can be split.
    first = settle(
        found.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("h1", "h2", "first"),
        "passage-first",
    )
    later = found.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("row_key").agg(F.collect_list("start").alias("starts"))


def _cut(stored: DataFrame, starts: DataFrame) -> DataFrame:
    kind = stored.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, gone, kept = [], [], []
            for words, begins in zip(_words(batch), batch.column("starts"), strict=True):
                totals.append(len(words))
                if not begins.is_valid:
                    gone.append(0)
                    kept.append(words.raw)
                    continue
                at = begins.values.to_numpy()
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + WINDOW, -1)
                stays = np.concatenate([[False], np.cumsum(step)[:-1] == 0, [False]])
                edges = np.flatnonzero(stays[1:] != stays[:-1]).reshape(-1, 2).tolist()
                gone.append(len(words) - sum(high - low for low, high in edges))
                kept.append(b" ".join([words.text(low, high) for low, high in edges]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(totals, pa.int64()),
                    pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["id", "n_words", "n_removed", "kept_text"],
            )

    return (
        stored.join(starts, "row_key", "left").select("id", "text", "starts")
        .mapInArrow(tidy(run), f"id {kind}, n_words long, n_removed long, kept_text string")
    )


def deduplicate(docs: DataFrame, *, identifier: Column, text: Column) -> DataFrame:
    """Return id, n_words, n_removed and kept_text (kept words joined by one space) per row."""
    spark = docs.sparkSession
    named = docs.select(identifier.alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    named = named.withColumn("digest", F.md5("text"))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id")
    heads = settle(
        named.groupBy("digest").agg(F.min(order).getField("id").alias("head"), F.count(F.lit(1)).alias("copies")),
        "passage-heads",
    )
    same = (named["digest"] == heads["digest"]) & named["id"].eqNullSafe(heads["head"])
    stored = settle(
        named.join(heads, same).select(
            F.monotonically_increasing_id().alias("row_key"), "id", named["digest"], "copies", "text"
        ),
        "passage-docs",
    )
    size = stored.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bloom.filter_bits(size * BITS_PER_BYTE)
    blocks = settle(block_filters(stored, bits), "passage-blocks")
    once = spark.sparkContext.broadcast(bloom.gathered(blocks, "once", bits))
    probed = settle(probe_filter(stored, bits, once), "passage-hits")
    once.destroy()
    twice = spark.sparkContext.broadcast(bloom.gathered(blocks, "twice", bits))
    hits = spark.sparkContext.broadcast(bloom.gathered(probed, "once", bits))
    discard(blocks, probed)
    found = settle(candidates(stored, bits, twice, hits), "passage-windows")
    twice.destroy()
    hits.destroy()
    starts = settle(repeated_starts(found), "passage-starts")
    discard(found)
    cut = _cut(stored, starts).select("id", "n_words", "n_removed", "kept_text")
    # Later copies repeat their head from the first word to the last. A hot text is dealt to several
    # salts by identifier, and the one row of its class goes to each of them.
    words = words_of(F.col("text"))
    short = F.when(F.size(words) < WINDOW, F.array_join(words, " ")).otherwise("")
    share = max(SALTED_ROWS, int((heads.agg(F.sum("copies")).first()[0] or 0) * SALTED_SHARE))
    classes = settle(
        stored.where("copies > 1").select(
            "digest", F.col("id").alias("head"), F.size(words).cast("long").alias("n_words"),
            short.alias("short_text"), F.ceil(F.col("copies") / share).cast("int").alias("salts"),
        ),
        "passage-classes",
    ).dropDuplicates(["digest"])
    # Fewer than 1 / SALTED_SHARE texts have more copies than the share.
    hot = F.broadcast(classes.where("salts > 1").select("digest", "salts"))
    salt = F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt")
    later = named.select("id", "digest").join(hot, "digest", "left").select("id", "digest", salt)
    dealt = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    copies = later.join(dealt.hint("merge"), ["digest", "salt"]).where(~F.col("id").eqNullSafe(F.col("head"))).select(
        "id", "n_words",
        F.when(F.col("n_words") < WINDOW, 0).otherwise(F.col("n_words")).cast("long").alias("n_removed"),
        F.col("short_text").alias("kept_text"),
    )
    return cut.unionByName(copies)
