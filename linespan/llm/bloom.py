"""Pairs of Bloom filters, for hashes seen once and seen at least twice.

Each task inserts the hashes of its rows. Two pairs merge by counting, for
every bit, whether one or several tasks set it: a hash that two tasks saw once
has all its bits in the merged twice filter. So the twice filter has false
positives but never misses a repeated hash. Bits travel as positions in
segments and are merged segment by segment, with one segment in memory.

The size follows the input up to ``MOST_BITS``, which bounds what is sent to
the workers. Beyond that only the share of false positives rises; what follows
the filters is exact, so results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SEGMENT_BITS = 1 << 20
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 30
PAYLOAD = "segment int, once binary, twice binary"
# Odd multipliers, one for each probe.
MULTIPLIERS = tuple(np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF) for k in range(8))


def filter_bits(bits: float) -> int:
    """Whole segments for so many bits, within the bounds."""
    wanted = int(min(MOST_BITS, max(LEAST_BITS, bits)))
    return -(-wanted // SEGMENT_BITS) * SEGMENT_BITS


def positions(hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Bit positions of each hash, one row per probe."""
    return np.stack(
        [((hashes * m >> np.uint64(32)) * np.uint64(bits)) >> np.uint64(32) for m in MULTIPLIERS[:probes]]
    )


def contains(packed: np.ndarray, hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Which hashes have all their bits set."""
    found = np.ones(len(hashes), bool)
    for m in MULTIPLIERS[:probes]:
        at = np.flatnonzero(found)
        if not len(at):
            break
        place = ((hashes[at] * m >> np.uint64(32)) * np.uint64(bits)) >> np.uint64(32)
        byte = packed[(place >> np.uint64(3)).astype(np.int64)]
        found[at] = (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1
    return found


def payloads(once: np.ndarray, twice: np.ndarray, bits: int, probes: int) -> Iterator[pa.RecordBatch]:
    """One row per segment with the positions a task has set in it."""
    ones = np.unique(positions(once, bits, probes).ravel())
    twos = np.unique(positions(twice, bits, probes).ravel())
    segments, onces, twices = [], [], []
    for segment in range(bits // SEGMENT_BITS):
        low, high = segment * SEGMENT_BITS, (segment + 1) * SEGMENT_BITS
        a = ones[np.searchsorted(ones, low) : np.searchsorted(ones, high)]
        b = twos[np.searchsorted(twos, low) : np.searchsorted(twos, high)]
        if len(a) or len(b):
            segments.append(segment)
            onces.append((a - np.uint64(low)).astype(np.uint32).tobytes())
            twices.append((b - np.uint64(low)).astype(np.uint32).tobytes())
    yield pa.RecordBatch.from_arrays(
        [pa.array(segments, pa.int32()), pa.array(onces, pa.binary()), pa.array(twices, pa.binary())],
        names=["segment", "once", "twice"],
    )


def seen(hashes: list[np.ndarray], bits: int, probes: int) -> Iterator[pa.RecordBatch]:
    """Payloads of all hashes of one task."""
    if hashes:
        found, counts = np.unique(np.concatenate(hashes), return_counts=True)
        yield from payloads(found, found[counts > 1], bits, probes)


def merged(parts: DataFrame) -> DataFrame:
    """Merge payload rows into one row of packed bits per segment."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, level = None, np.zeros(SEGMENT_BITS, np.uint8)

        def closed():
            return pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array([current], pa.int32()),
                    "once": pa.array([np.packbits(level >= 1, bitorder="little").tobytes()], pa.binary()),
                    "twice": pa.array([np.packbits(level >= 2, bitorder="little").tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            for segment, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != current:
                    if current is not None:
                        yield closed()
                    current = segment
                    level[:] = 0
                at = np.frombuffer(once, np.uint32)
                level[at] = np.minimum(level[at] + 1, 2)
                level[np.frombuffer(twice, np.uint32)] = 2
        if current is not None:
            yield closed()

    return parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, PAYLOAD)


def gathered(filters: DataFrame, which: str, bits: int) -> np.ndarray:
    """The packed bits of one filter on the driver; at most ``MOST_BITS`` of them."""
    packed = np.zeros(bits // 8, np.uint8)
    step = SEGMENT_BITS // 8
    for segment, content in filters.select("segment", which).toLocalIterator():
        packed[segment * step : (segment + 1) * step] = np.frombuffer(content, np.uint8)
    return packed
