"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams (one to three characters, lower case) of
the whole text, weighted by (1 + log count) * idf and scaled to length one.
Document frequencies cover all training rows. The regression is fitted on a
bounded sample of them, at most ``PER_LANGUAGE`` rows a language, with the
follow-the-regularised-leader rule and an elastic-net penalty, which leaves
most weights exactly zero. A fifth of the sample is kept apart to calibrate one
temperature, by which all scores are divided before they become probabilities.

Predictions see the text only. A null text and a text without any letter is
``und`` with score 0, as is every text when there is nothing to learn from.
Ties go to the language first in code-point order. Repeated rows get the same
answer. An empty table gives no rows. Only the named columns are read, so
further columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linespan.llm.common import settle, tidy

BUCKETS = 1 << 15
PER_LANGUAGE = 1500
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.05, 0.01
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    grams, parts = points.copy(), []
    for n in range(1, 4):
        parts.append((grams * np.uint32(2_654_435_761) ^ np.uint32(n * 40_503)) >> np.uint32(17))
        if len(points) <= n:
            break
        grams = (grams[:-1] * np.uint32(16_777_619)) ^ points[n:]
    counts = np.bincount(np.concatenate(parts), minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and TF-IDF values of unit length."""
    buckets, counts = gram_counts(text)
    values = (1 + np.log(counts)) * idf[buckets]
    norm = math.sqrt(float(values @ values))
    return buckets, values / norm if norm else values


def document_frequency(training: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training rows each bucket occurs, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total[gram_counts(text)[0]] += 1
                total[BUCKETS] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    sums = training.select("text").mapInArrow(tidy(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequency = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in sums.collect():  # at most one row a bucket
        frequency[bucket] = n
    return frequency[:BUCKETS], int(frequency[BUCKETS])


def bounded_sample(training: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` rows of each language, chosen by hash: label, text, draw."""
    drawn = training.withColumn("draw", F.xxhash64("id", "text"))
    # One row a language: the model has one, too.
    counts = drawn.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return drawn.select("label", "text", "draw")
    # Twice the rows wanted on average, chosen where they are read, before the exact choice.
    share = F.create_map(*(F.lit(x) for row in counts for x in (row["label"], min(1.0, 2.0 * per_language / row["n"]))))
    near = drawn.where(F.abs(F.col("draw").cast("double")) <= share[F.col("label")] * 2.0**63)
    order = Window.partitionBy("label").orderBy("draw", "id")
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language).select(
        "label", "text", "draw"
    )


def fit(texts: list[str], labels: list[str], idf: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """Return the languages, their weights (one row each, bias last) and the temperature."""
    languages = sorted(set(labels))
    rows = []
    for text in texts:
        buckets, values = weighted(text, idf)
        rows.append((np.append(buckets, BUCKETS), np.append(values, 1.0)))
    wanted = [languages.index(label) for label in labels]
    apart = set(range(0, len(rows), 5)) if len(rows) >= 10 else set()
    z = np.zeros((len(languages), BUCKETS + 1))
    n = np.zeros_like(z)
    for _ in range(EPOCHS):
        for number, (at, x) in enumerate(rows):
            if number in apart:
                continue
            zs, ns = z[:, at], n[:, at]
            w = _weights(zs, ns)
            scores = w @ x
            p = np.exp(scores - scores.max())
            p /= p.sum()
            p[wanted[number]] -= 1
            g = p[:, None] * x
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[:, at] = zs + g - sigma * w
            n[:, at] = ns + g * g
    w = _weights(z, n)
    held = np.array([w[:, rows[i][0]] @ rows[i][1] for i in sorted(apart)]).reshape(len(apart), -1)
    return languages, w, temperature(held, np.array([wanted[i] for i in sorted(apart)], np.int64))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed form of the regularised leader: zero inside the L1 band."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def temperature(scores: np.ndarray, wanted: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search."""
    if not len(scores):
        return 1.0

    def loss(log_t: float) -> float:
        s = scores / math.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), wanted]).mean())

    low, high, ratio = -3.0, 3.0, (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


MODEL = "language string, buckets binary, weights binary, temperature double"


def trained(training: DataFrame, *, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Fit on training rows (id, text, label): languages, weights, idf, temperature.

    The fit runs in one task over the bounded sample; one row a language comes
    back.
    """
    frequency, total = document_frequency(training)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    sample = settle(bounded_sample(training, per_language), "language-sample")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [f for f in frames if len(f)]
        if parts:
            rows = pd.concat(parts).sort_values(["draw", "label"])
            languages, weights, heat = fit(list(rows["text"]), list(rows["label"]), idf)
            for language, line in zip(languages, weights, strict=True):
                at = np.flatnonzero(line)
                yield pd.DataFrame(
                    {"language": [language], "buckets": [at.astype(np.int32).tobytes()],
                     "weights": [line[at].tobytes()], "temperature": [heat]}
                )

    model = sample.repartition(1).mapInPandas(run, MODEL).collect()
    model.sort(key=lambda row: row["language"])
    weights = np.zeros((len(model), BUCKETS + 1))
    for number, row in enumerate(model):
        weights[number, np.frombuffer(row["buckets"], np.int32)] = np.frombuffer(row["weights"])
    return [r["language"] for r in model], weights, idf, model[0]["temperature"] if model else 1.0


def predict(docs: DataFrame, model, *, key: list[str], text: Column) -> DataFrame:
    """Return the key columns, lang_pred and score per row."""
    languages, weights, idf, heat = model
    shared = docs.sparkSession.sparkContext.broadcast((languages, weights.astype(np.float32), idf, heat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, w, scale, t = shared.value
        for batch in batches:
            best, sure = [], []
            for content in batch.column("_text").to_pylist():
                if content is None or not names or not LETTER.search(content):
                    best.append(UNKNOWN)
                    sure.append(0.0)
                    continue
                at, x = weighted(content, scale)
                scores = (w[:, at] @ x.astype(np.float32) + w[:, BUCKETS]).astype(np.float64) / t
                p = np.exp(scores - scores.max())
                p /= p.sum()
                top = int(p.argmax())
                best.append(names[top])
                sure.append(float(p[top]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in key), pa.array(best, pa.string()), pa.array(sure, pa.float64())],
                names=[*key, "lang_pred", "score"],
            )

    rows = docs.select(*key, text.alias("_text"))
    schema = rows.select(*key).schema
    extra = rows.sparkSession.createDataFrame([], "lang_pred string, score double").schema
    return rows.mapInArrow(tidy(run), type(schema)([*schema.fields, *extra.fields]))
