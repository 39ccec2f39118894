"""Whitening of embeddings: principal components by Chebyshev-filtered subspace iteration over distributed passes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.llm.common import query, table, written

#: Entries become whole numbers floor(SCALE c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Vectors of the iterated subspace beyond the wanted ones, degree of the filter, and rounds at most.
GUARD, DEGREE, ROUNDS = 16, 12, 80
#: Residuals, relative to the largest eigenvalue, at which components are certified, and at which rounds that no longer
#: gain end.
CERTAIN, LEAST = 1e-11, 1e-14
#: Eigenvalues below this share of the largest are rounding, and their components undefined.
RANK = 1e-12


@dataclass
class Whitening:
    """Sums of the fit list, components (columns) by falling eigenvalue, and their certificate.

    `residual` is the largest |V q - e q| over the largest eigenvalue; `beyond` the largest eigenvalue found by a filtered
    search outside the components' span."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    beyond: float
    identity_error: float = 0.0
    passes: int = 0

    @property
    def sound(self) -> np.ndarray:
        """Components that differ from rounding."""
        return self.values > max(RANK * self.trace, 0)

    def project(self, x: np.ndarray) -> np.ndarray:
        scale = np.sqrt(np.where(self.sound, self.values, 1))
        return np.where(self.sound, centred(x, self.n, self.sums) @ self.vectors / scale, np.nan)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, with the difference taken in whole numbers."""
    return (n * x - sums) / n


def _sound_vectors(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is whole, with `_x`, its whole numbers. Of several lengths the commonest, then the longest, counts."""
    v = F.col(column)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = vectors.filter(v.isNotNull() & ~bad).withColumn(
        "_x", F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT))
    sizes = rows.groupBy(F.size("_x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("_x") == (sizes["size"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _total(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: type) -> np.ndarray | None:
    """The sum of `part` over all blocks: added up in each task, then by few tasks, so that the driver gets few of them."""

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for rows, raw in zip(batch["rows"].to_pylist(), batch["block"]):
                yield part(np.frombuffer(raw.as_buffer(), "<i8").reshape(rows, -1))

    def add(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for p in parts:
            total = p if total is None else total + p
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [total.astype(kind).tobytes()]})

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return add(blocks_of(batches))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return add(np.frombuffer(x.as_py(), kind) for batch in batches for x in batch["part"])

    some = math.isqrt(blocks.sparkSession.sparkContext.defaultParallelism)
    parts = blocks.mapInArrow(first, "part binary").repartition(some).mapInArrow(second, "part binary").collect()
    return np.sum([np.frombuffer(bytes(p["part"]), kind) for p in parts], axis=0) if parts else None


class _Passes:
    """Products of the covariance with narrow matrices, one pass over the blocks each."""

    def __init__(self, blocks: DataFrame, n: int, sums: np.ndarray):
        self.blocks, self.n, self.sums, self.count = blocks, n, sums, 0

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q, from centred blocks."""
        shared = self.blocks.sparkSession.sparkContext.broadcast(q)
        n, sums = self.n, self.sums

        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x, n, sums)
            return y.T @ (y @ shared.value)

        out = _total(self.blocks, part, np.float64).reshape(q.shape) / n
        shared.destroy()
        self.count += 1
        return out

    def filtered(self, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
        """The scaled Chebyshev polynomial of V, small on [low, high] and 1 at `top`, times q."""
        e, c = (high - low) / 2, (high + low) / 2
        if e <= 0 or top <= high:
            return self.times(q)
        first = sigma = e / (top - c)
        y = (self.times(q) - c * q) * (sigma / e)
        for _ in range(degree - 1):
            after = 1 / (2 / first - sigma)
            y, q = (self.times(y) - c * y) * (2 * after / e) - sigma * after * q, y
            sigma = after
        return y


def fit(vectors: DataFrame, column: str = "embedding", components: int = 32, seed: int = 3) -> tuple[Whitening | None, DataFrame]:
    """Leading components of the covariance of all sound vectors' whole numbers, and the sound rows; None without any.

    Vectors that are null or hold null or non-finite entries are left out; of several lengths the commonest (then the
    longest) is fitted and the others are left out; repeated rows count each. Entries must be below 2^40.

    A block of `components` + GUARD random vectors goes through rounds of a Chebyshev filter that damps all below the
    block's smallest Ritz value, QR, and Rayleigh-Ritz. Each product with the covariance is one pass over a written table
    of centred blocks; the driver holds matrices of dimension by block only. Rounds end when all residuals are at rounding or no longer
    fall; a filtered random block outside the span then has to find nothing larger. Raises ArithmeticError if the
    components can't be certified."""
    rows = _sound_vectors(vectors, column)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch["_x"])
                yield pa.RecordBatch.from_pydict({"rows": [len(x)], "block": [x.astype("<i8").tobytes()]})

    blocks = written(rows.select("_x").mapInArrow(pack, "rows bigint, block binary"))
    total = _total(blocks, lambda x: np.concatenate([[len(x)], x.sum(0)]), np.int64)
    if total is None or len(total) == 1:
        return None, rows
    n, sums = int(total[0]), total[1:]
    passes, d = _Passes(blocks, n, sums), len(sums)
    wanted = min(components, d)
    trace = float(_total(blocks, lambda x: np.array([(centred(x, n, sums) ** 2).sum()]), np.float64)[0] / n)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, min(d, components + GUARD))))[0]
    values, q, residual = _rotated(passes, q, wanted)
    best, stale = residual, 0
    for _ in range(ROUNDS):
        if residual <= LEAST or stale == 3 or trace == 0 or q.shape[1] == d:
            break
        q = np.linalg.qr(passes.filtered(q, 0.0, float(values[-1]), float(values[0]), DEGREE))[0]
        values, q, residual = _rotated(passes, q, wanted)
        stale = stale + 1 if residual > best / 2 else 0
        best = min(best, residual)
    beyond = 0.0
    kept = q[:, :wanted]
    if wanted < d and trace > 0:
        # what the span might have missed: a new block, filtered outside of it
        block = np.random.default_rng(seed + 1).normal(size=(d, min(d - wanted, 4)))
        block = np.linalg.qr(block - kept @ (kept.T @ block))[0]
        block = passes.filtered(block, 0.0, float(values[wanted - 1]) * (1 - 1e-9), float(values[0]), DEGREE)
        block = np.linalg.qr(block - kept @ (kept.T @ block))[0]
        beyond = float(np.linalg.eigvalsh(block.T @ passes.times(block)).max())
    if residual > CERTAIN or beyond > values[wanted - 1] + 1e-9 * values[0]:
        raise ArithmeticError(f"components not certified: residual {residual:.1e}, {beyond} beyond {values[wanted - 1]}")
    out = Whitening(n, sums, kept, values[:wanted], trace, residual, beyond, passes=passes.count)
    out.identity_error = _identity_error(blocks, out)
    return out, rows


def _rotated(passes: _Passes, q: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Rayleigh-Ritz in the span of q: values, vectors, and the largest relative residual of the wanted ones."""
    image = passes.times(q)
    inner = q.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q, image = q @ turn, image @ turn
    if values[0] <= 0:
        return np.maximum(values, 0), q, 0.0
    off = np.linalg.norm(image[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0)
    return values, q, float(off.max() / values[0])


def _identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, over sound components; their mean comes first."""
    k = int(model.sound.sum())
    if not k:
        return 0.0
    shared = blocks.sparkSession.sparkContext.broadcast(model)
    mean = _total(blocks, lambda x: shared.value.project(x)[:, :k].sum(0), np.float64) / model.n

    def part(x: np.ndarray) -> np.ndarray:
        w = shared.value.project(x)[:, :k] - mean
        return w.T @ w

    cov = _total(blocks, part, np.float64).reshape(k, k) / model.n
    return float(abs(cov - np.eye(k)).max())


def whitened(rows: DataFrame, model: Whitening, drop: str = "_x") -> DataFrame:
    """Rows of `fit` with `deviation`, the exact sum of (n x - S)^2, null beyond 64 bits, and `whitened`, an array; entries
    of components without variance are null. Columns of the same names are replaced."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<deviation: bigint, whitened: array<double>>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for xs in batches:
            x = np.stack(xs.to_list()) if len(xs) else np.zeros((0, len(m.sums)), np.int64)
            off = m.n * x - m.sums
            fits = (off.astype("f8") ** 2).sum(1) < 9.2e18
            exact = pd.Series((off * off).sum(1), dtype="Int64").mask(~fits)
            w = m.project(x)
            lists = [[None if v != v else v for v in row] for row in w.tolist()] if not m.sound.all() else list(w)
            yield pd.DataFrame({"deviation": exact, "whitened": lists})

    done = rows.withColumn("_w", project("_x"))
    kept = [c for c in rows.columns if c not in (drop, "deviation", "whitened")]
    return done.select(*[F.col(f"`{c}`") for c in kept], "_w.deviation", "_w.whitened")


def _constant(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = fit(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    if model is None:
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, residual double")
    share = model.values / model.trace if model.trace else np.zeros(len(model.values))
    each = whitened(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        _constant(share)[F.col("at")].alias("explained"), F.lit(model.identity_error).alias("identity_error"),
        F.lit(model.residual).alias("residual"))
