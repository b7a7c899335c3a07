"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become fixed-point integers, x = floor(scale * c). The fit list holds
each distinct x once; with X its centred rows, right vectors v and left vectors
u are built in turn:

    a u_k = X v_k - b u_(k-1),    b v_(k+1) = X'u_k - a v_k

Both products of a step run in one job over written blocks of X: a task
multiplies its rows with the vector and then, transposed, with the result. A left
vector is as long as the corpus, so it is never stored: u_k = X w_k for a short
w_k, which tasks apply to their rows. Both sides are reorthogonalised against
all earlier vectors; the overlaps of left vectors are summed where the rows
are. The singular values of the small bidiagonal matrix are the deviations times
sqrt(n), its right singular vectors give the components. The driver holds
vectors of one dimension's length only, as many as there were steps.

A chain ends when its wanted triplets have converged to rounding, or when its
space is exhausted. One start meets an equal eigenvalue once, so a further
chain starts beside the vectors found; when its largest value is no larger
than the last wanted one, nothing was missed.

Rows whose vector is null or holds null, NaN or infinite entries are left out.
Vectors shorter than the longest are padded with zeros. Products beyond a long
saturate. Repeated vectors count once in the fit list; every remaining row is
returned, also repeated ones and those with null keys. Components whose
deviation is below ``RANK`` of the largest are not returned, so equal vectors, a
single vector and an empty table give no rows. Of equal eigenvalues any basis
may come back. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.llm.common import settle, tidy

SCALE = 256
COMPONENTS = 4
BLOCK_BYTES = 4 << 20
# Share of the largest deviation below which a direction counts as flat.
RANK = 1e-9
# Residuals at rounding level, as a share of the largest singular value.
SETTLED = 8 * np.finfo(np.float64).eps
SEED = 20_261
DECIMAL_LIMIT = 10**38


def whole(entries: Column) -> Column:
    """True for vectors without null, NaN and infinite entries."""
    fine = F.forall(
        entries, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )
    return F.coalesce(entries.isNotNull() & fine, F.lit(False))


def fixed_point(entries: Column, scale: int = SCALE) -> Column:
    return F.transform(entries, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows of an Arrow list column as one matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def packed(distinct: DataFrame, dimensions: int) -> DataFrame:
    """Blocks of rows in the narrowest integers, with their sums in two halves, which cannot overflow."""
    per_block = max(1, BLOCK_BYTES // (8 * dimensions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("x"), dimensions)
            for start in range(0, len(rows), per_block):
                block = rows[start : start + per_block]
                narrow = block.astype(np.result_type(np.min_scalar_type(block.min()), np.min_scalar_type(block.max())))
                exact = narrow if (narrow == block).all() else block
                yield pa.RecordBatch.from_pydict(
                    {
                        "rows": pa.array([len(block)], pa.int64()),
                        "kind": pa.array([exact.dtype.str]),
                        "block": pa.array([exact.tobytes()], pa.binary()),
                        "high": pa.array([(block >> 32).sum(0).tolist()], pa.list_(pa.int64())),
                        "low": pa.array([(block & 0xFFFFFFFF).sum(0).tolist()], pa.list_(pa.int64())),
                    }
                )

    return distinct.mapInArrow(
        tidy(run), "rows long, kind string, block binary, high array<bigint>, low array<bigint>"
    )


class Centred:
    """The centred rows of the fit list, as a linear map that is only applied where the rows are."""

    def __init__(self, distinct: DataFrame, dimensions: int) -> None:
        self.dimensions = dimensions
        self.blocks = settle(packed(distinct, dimensions), "whiten-fit")
        self.n = self.blocks.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        halves = self.blocks.select(F.posexplode(F.arrays_zip("high", "low"))).groupBy("pos").agg(
            F.sum("col.high").alias("high"), F.sum("col.low").alias("low")
        )
        self.sums = [0] * dimensions
        for row in halves.collect():
            self.sums[row["pos"]] = (row["high"] << 32) + row["low"]
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dimensions)

    def totals(self, measure, length: int) -> np.ndarray:
        """Sum over all blocks of ``measure(centred rows)``, ``length`` numbers."""
        mean, dimensions = self.mean, self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length)
            for batch in batches:
                for kind, block in zip(*(batch.column(c).to_pylist() for c in ("kind", "block")), strict=True):
                    rows = np.frombuffer(block, np.dtype(kind)).reshape(-1, dimensions)
                    total += measure(rows.astype(np.float64) - mean)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(length), pa.int32()), pa.array(total)], names=["place", "value"]
            )

        parts = self.blocks.select("kind", "block").mapInArrow(tidy(run), "place int, value double")
        found = np.zeros(length)
        for place, value in parts.groupBy("place").agg(F.sum("value")).collect():
            found[place] = value
        return found

    def products(self, short: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """For u = X short: X'u, the squared length of u, and its overlaps with X w for earlier w."""
        d, k = self.dimensions, len(earlier)

        def measure(rows: np.ndarray) -> np.ndarray:
            left = rows @ short
            return np.concatenate((left @ rows, [left @ left], left @ (rows @ earlier.T) if k else []))

        found = self.totals(measure, d + 1 + k)
        return found[:d], found[d], found[d + 1 :]


def against(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The part of a vector orthogonal to orthonormal rows; twice is enough."""
    for _ in range(2):
        vector = vector - basis.T @ (basis @ vector)
    return vector


def chain(rows: Centred, found: np.ndarray, wanted: int, draw: np.random.Generator, scale: float):
    """Singular values and right vectors of one chain beside the vectors ``found``.

    ``scale`` is the largest value known so far. Returns the triplets that are exact: all of an
    exhausted space, or the ``wanted`` largest ones.
    """
    d = rows.dimensions
    start = against(draw.standard_normal(d), found)
    right, short, image = [start / np.linalg.norm(start)], [], []
    alphas, betas = [], []
    while True:
        raw = right[-1] - (betas[-1] * short[-1] if short else 0)
        earlier = np.array(short).reshape(-1, d)
        back, squared, overlaps = rows.products(raw, earlier)
        if len(earlier):
            raw, back = raw - overlaps @ earlier, back - overlaps @ np.array(image)
            squared -= overlaps @ overlaps
        alpha = math.sqrt(max(squared, 0.0))
        scale = max(scale, alpha, *betas, 0.0)
        alphas.append(alpha)
        exhausted = alpha <= SETTLED * math.sqrt(rows.n) * scale
        if not exhausted:
            short.append(raw / alpha)
            image.append(back / alpha)
            rest = against(image[-1] - alpha * right[-1], np.vstack([found, *right]))
            beta = float(np.linalg.norm(rest))
            exhausted = beta <= SETTLED * scale or len(found) + len(right) == d
        small = np.diag(alphas) + np.diag(betas, 1)
        left_vectors, values, right_vectors = np.linalg.svd(small)
        vectors = right_vectors @ np.array(right)
        if exhausted:
            return values, vectors
        residuals = beta * np.abs(left_vectors[-1, :wanted])
        if len(values) >= wanted and (residuals <= SETTLED * values[0]).all():
            return values[:wanted], vectors[:wanted]
        betas.append(beta)
        right.append(rest / beta)


def leading(rows: Centred, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of X and their right vectors."""
    d = rows.dimensions
    wanted = min(wanted, d)
    draw = np.random.default_rng(SEED)
    values, vectors = np.zeros(0), np.zeros((0, d))
    while len(vectors) < d:
        scale = values[0] if len(values) else 0.0
        more, beside = chain(rows, vectors, 1 if len(values) else wanted, draw, scale)
        last = values[wanted - 1] if len(values) >= wanted else 0.0
        nothing_new = len(values) and more[0] <= max(last * (1 + SETTLED), RANK * scale)
        if nothing_new or not more.max(initial=0.0):
            break
        values, vectors = np.concatenate((values, more)), np.vstack((vectors, beside))
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[order]
    keep = values[:wanted] > RANK * (values[0] if len(values) else 1.0)
    return values[:wanted][keep], vectors[:wanted][keep]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal | None]:
    """Exact sums of (n x - S)^2; None where 38 digits do not hold one."""
    rough = (((x.astype(np.float64) - np.array(sums, np.float64) / n) * n) ** 2).sum(1)
    largest = n * max(int(np.abs(x.astype(np.float64)).max(initial=0)), max(map(abs, sums)) // n + 1)
    if rough.max(initial=0) < 2**62 and largest < 2**62:
        shifted = x * n - np.array(sums, np.int64)
        return [Decimal(v) for v in (shifted * shifted).sum(1).tolist()]
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [Decimal(v) if v < DECIMAL_LIMIT else None for v in exact]


def whitened(
    vectors: DataFrame, *, key: list[str], vector: Column, components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """Return one row per remaining row and component.

    Columns: key, component, n, deviation (decimal), whitened, explained, identity_error.
    """
    spark = vectors.sparkSession
    stored = settle(
        vectors.where(whole(vector)).select(*key, fixed_point(vector, scale).alias("whiten_x")), "whiten-rows"
    )
    dimensions = stored.agg(F.coalesce(F.max(F.size("whiten_x")), F.lit(0))).first()[0]
    short = F.array_repeat(F.lit(0).cast("long"), F.lit(dimensions) - F.size("whiten_x"))
    padded = stored.select(*key, F.concat("whiten_x", short).alias("x"))
    keys = ", ".join(f"`{name}` {padded.schema[name].dataType.simpleString()}" for name in key)
    schema = (
        f"{keys}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double"
    )
    if not dimensions:
        return spark.createDataFrame([], schema)
    rows = Centred(padded.select("x").distinct(), dimensions)
    values, basis = leading(rows, components) if rows.n else (np.zeros(0), np.zeros((0, dimensions)))
    count = len(values)
    if not count:
        return spark.createDataFrame([], schema)
    n, sums, mean = rows.n, rows.sums, rows.mean
    spread = values * values / n
    to_white = basis.T / np.sqrt(spread)

    def measure(centred: np.ndarray) -> np.ndarray:
        white = centred @ to_white
        return np.concatenate(([(centred * centred).sum()], (white.T @ white).ravel()))

    found = rows.totals(measure, 1 + count * count) / n
    explained = spread / found[0]
    error = float(np.abs(found[1:].reshape(count, count) - np.eye(count)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), dimensions)
            white = (x.astype(np.float64) - mean) @ to_white
            every = pa.array(np.repeat(np.arange(len(x)), count))
            total = len(x) * count
            deviation = pa.array(deviations(x, n, sums), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(every) for name in key),
                    pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                    pa.array(np.full(total, n), pa.int64()),
                    deviation.take(every),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(total, error)),
                ],
                names=[*key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return padded.mapInArrow(tidy(run), schema)
