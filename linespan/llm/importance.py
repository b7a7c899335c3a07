"""Resampling of documents by importance for a target distribution.

Words are hashed into buckets. A bucket's gain compares its share in the target
texts with its share in the corpus; a document's weight is the sum of the gains
of its features, and a seeded Gumbel draw is added, so taking the highest
scores samples without replacement in proportion to exp(weight / 1000).

1. One pass stores the bucket numbers of every document, two bytes each where
   they fit, and counts buckets per task; the counts merge in a shuffle.
2. The gains are one array of as many numbers as there are buckets, sent to the
   tasks; a document's weight is a sum over this array. Scores are written.
3. The cutoff is found by bisection: jobs over the written scores count the rows
   at or above thresholds, ``THRESHOLDS`` of them (four halvings) in a job, until
   one integer is left. Rows with the score at the cutoff are bisected in the same
   way by doc_id, and rows that also share the doc_id by their row number.
4. The selected rows are dealt to ranges of the order and sorted there; a rank is
   the row's place plus the rows of the ranges before.

A null text has no features, weight 0 and takes part like any other (it has too few
words to be drawn, unless the least count is 0). A null doc_id draws as empty text
and comes last among equal scores. Repeated rows count each; of equal ones any may
be drawn. Very long texts are used whole. An empty corpus gives no rows, an empty
target counts nothing. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linespan.llm.common import discard, keyed, settle, tidy, whole_rows

# Characters of a word (after A-Z are lower-cased), seed, word and row limits.
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SEED = "2024"
LONGEST_RUN = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
THRESHOLDS = 15
REMEMBERED = 200_000
LAST_ID = (1 << 63) - 1


class Buckets(dict):
    """Bucket of a feature; forgets all features when it has grown large."""

    def __init__(self, count: int) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[feature] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.count
        return value


def features(text: str | None, longest: int) -> Iterator[str]:
    """All runs of 1 to ``longest`` consecutive words."""
    words = WORD.findall((text or "").translate(UPPER))
    yield from words
    for length in range(2, longest + 1):
        yield from map(" ".join, zip(*(words[k:] for k in range(length)), strict=False))


def bucketed(texts: DataFrame, text: Column, keys: list[Column], buckets: int, longest: int) -> DataFrame:
    """Keys, n_words, n_features and the packed bucket numbers of every row."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    chosen = texts.select(*keys, text.alias("feature_text"))
    names = chosen.columns[:-1]
    declared = "".join(f"`{name}` {chosen.schema[name].dataType.simpleString()}, " for name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Buckets(buckets)
        for batch in batches:
            words, counts, packed = [], [], []
            for content in batch.column("feature_text").to_pylist():
                found = np.fromiter(map(number.__getitem__, features(content, longest)), kind)
                counts.append(len(found))
                # Of w words there are w - k + 1 runs of k words.
                words.append(len(found) if longest == 1 else len(WORD.findall((content or "").translate(UPPER))))
                packed.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in names),
                    pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()),
                ],
                names=[*names, "n_words", "n_features", "buckets"],
            )

    return chosen.mapInArrow(tidy(run), f"{declared}n_words long, n_features long, buckets binary")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs. Tasks count first, so a task sends one row a bucket at most."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("buckets").to_pylist():
                total += np.bincount(np.frombuffer(packed, kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "times"]
        )

    counted = rows.select("buckets").mapInArrow(tidy(run), "bucket int, times long")
    found = np.zeros(buckets, np.int64)
    for bucket, times in counted.groupBy("bucket").agg(F.sum("times")).collect():
        found[bucket] = times
    return found


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares), in doubles."""
    buckets = len(corpus)
    above = (target + 1).astype(np.float64) * float(int(corpus.sum()) + buckets)
    below = (corpus + 1).astype(np.float64) * float(int(target.sum()) + buckets)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def weighed(rows: DataFrame, names: list[str], gains: np.ndarray) -> DataFrame:
    """Named columns and ``weight``, the sum of the gains of a row's features."""
    kind = np.uint16 if len(gains) <= 1 << 16 else np.uint32
    chosen = rows.select(*names, "buckets")
    declared = ", ".join(f"`{name}` {chosen.schema[name].dataType.simpleString()}" for name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(gains[np.frombuffer(b, kind)].sum()) for b in batch.column("buckets").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(weights, pa.int64())], names=[*names, "weight"]
            )

    return chosen.mapInArrow(tidy(run), f"{declared}, weight long")


def gumbel(identifier: Column, seed: str) -> Column:
    """A seeded draw in thousandths, from the first 32 bits of a digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit(""))), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def count_at_most(values: DataFrame, wanted: int) -> tuple[int, int]:
    """The least value v with at least ``wanted`` rows of ``value <= v``, and the rows below v.

    ``values``: one long column ``value``, with at least ``wanted`` >= 1 rows. Each job
    counts the rows between evenly placed thresholds inside the bounds.
    """
    low, high = values.agg(F.min("value"), F.max("value")).first()
    below = 0
    while low < high:
        step = (high - low) // (THRESHOLDS + 1) + 1
        starts = list(range(low + step, high + 1, step))
        place = sum((F.col("value") >= t).cast("int") for t in starts)
        counts = dict(values.where(F.col("value").between(low, high)).groupBy(place.alias("place")).count().collect())
        for k, (start, end) in enumerate(zip([low, *starts], [*starts, high + 1], strict=True)):
            if below + counts.get(k, 0) >= wanted:
                low, high = start, end - 1
                break
            below += counts.get(k, 0)
    return low, below


def drawn_rows(scored: DataFrame, wanted: int) -> Column:
    """Condition that holds for the ``wanted`` first rows of ``scored`` (score falling, tie, row)."""
    if wanted < 1:
        return F.lit(False)
    score, before = count_at_most(scored.select((-F.col("score")).alias("value")), wanted)
    score = -score
    level = scored.where(F.col("score") == score)
    tie, earlier = count_at_most(level.select(F.col("tie").alias("value")), wanted - before)
    same = level.where(F.col("tie") == tie)
    row, _ = count_at_most(same.select(F.col("row").alias("value")), wanted - before - earlier)
    return (F.col("score") > score) | (
        (F.col("score") == score)
        & ((F.col("tie") < tie) | ((F.col("tie") == tie) & (F.col("row") <= row)))
    )


def ranked(rows: DataFrame) -> DataFrame:
    """Add rank 1, 2, 3 ... in the order of falling score, tie and row."""
    order = [F.desc("score"), F.asc("tie"), F.asc("row")]
    local = F.monotonically_increasing_id()
    # An id holds the number of its task above 33 bits and the place in the task below.
    placed = settle(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", local.alias("place")), "drawn"
    )
    task, place = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One small row a task, so this window and its broadcast stay small.
    offsets = sizes.select("task", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return placed.withColumn("task", task).join(F.broadcast(offsets), "task").withColumn(
        "rank", F.col("before") + place + 1
    ).drop("task", "before", "place")


def resample(
    docs: DataFrame, target: DataFrame, *, key: list[str], identifier: Column, text: Column, target_text: Column,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, buckets: int = BUCKETS, longest_run: int = LONGEST_RUN,
    seed: str = SEED,
) -> DataFrame:
    """Return key columns, n_words, n_features, weight, score and rank (null where not drawn) of every row.

    ``identifier`` is an integer; it names the draw and breaks ties.
    """
    keys = [
        F.monotonically_increasing_id().alias("row"), identifier.cast("long").alias("id"), F.struct(*key).alias("key"),
    ]
    stored = settle(bucketed(docs, text, keys, buckets, longest_run), "resample-buckets")
    wanted_text = bucketed(target, target_text, [], buckets, longest_run)
    gains = bucket_gains(bucket_counts(stored, buckets), bucket_counts(wanted_text, buckets))
    scored = settle(
        weighed(stored, ["row", "id", "key", "n_words", "n_features"], gains)
        .withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
        .withColumn("tie", F.coalesce("id", F.lit(LAST_ID))),
        "resample-scores",
    )
    discard(stored)
    eligible = scored.where(F.col("n_words") >= least_words)
    chosen = (F.col("n_words") >= least_words) & drawn_rows(eligible, eligible.count() * percent // 100)
    columns = ["key.*", "n_words", "n_features", "weight", "score"]
    rest = scored.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked(scored.where(chosen)).select(*columns, "rank").unionByName(rest)


def selected_rows(
    docs: DataFrame, target: DataFrame, *, text: str = "text", identifier: str = "doc_id", target_text: str = "text",
    **options,
) -> DataFrame:
    """Return the drawn documents as whole rows, in no order."""
    stored = keyed(docs, "resample-rows")
    drawn = resample(
        stored, target, key=["row_key"], identifier=F.col(f"doc.`{identifier}`"), text=F.col(f"doc.`{text}`"),
        target_text=F.col(f"`{target_text}`"), **options,
    )
    return whole_rows(stored, drawn.where("rank IS NOT NULL"))
