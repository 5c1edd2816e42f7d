"""Embedding whitening from variances alone, by the polarisation identity.

The covariance of two dimensions is half of what the variance of their sum exceeds the sum of their variances
by. So tasks only sum squares: of every dimension and of the sum of every pair of dimensions, centred and exact.
Components are integers; they are centred by the whole part of their mean in the tasks, and what is left of the mean, a
fraction over n, is settled afterwards in unbounded integers: with y = x - m and R = sum(y),
n**2 * sum(y**2) - n * R**2 is the sum of (n*x - S)**2 to the last digit.

The driver gets one number per dimension and pair, assembles the covariance, and takes its eigenvectors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Rows whose squares are summed before they go on as exact decimals.
BLOCK = 4096
#: The largest component, scaled, for which the squares of BLOCK centred pair sums fit a long.
LARGEST = 1 << 23
#: Eigenvalues below this share of the largest are rounding: such a direction has no spread to divide by.
NO_SPREAD = 1e-12
_EXACT = "decimal(38,0)"


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite entries; an empty one has no dimension to whiten."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector.cast("array<double>"), finite), F.lit(False))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def _sums(vectors: DataFrame, width: int) -> list[int]:
    """The exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(_matrix(b).sum(axis=0))], names=["k", "s"])

    parts = vectors.select("x").mapInArrow(run, "k long, s long").groupBy("k").agg(F.sum(F.col("s").cast(_EXACT)).alias("s"))
    return [int(r["s"]) for r in sorted(parts.collect())]  # a row per dimension


def _squares(vectors: DataFrame, width: int, middle: np.ndarray) -> np.ndarray:
    """The exact sums of squares of y = x - middle (at [i, i]) and of y[i] + y[j] (at [i, j] for i < j)."""
    first, second = np.triu_indices(width, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                y = (_matrix(b.slice(at, BLOCK)) - middle).T.copy()
                out = np.zeros((width, width), np.int64)
                for i in range(width):
                    pair = y[i] + y[i + 1 :]
                    out[i, i] = (y[i] ** 2).sum()
                    out[i, i + 1 :] = (pair**2).sum(axis=1)
                some = np.concatenate([np.arange(width) * (width + 1), first * width + second])
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out.ravel()[some])], names=["k", "s"])

    parts = vectors.select("x").mapInArrow(run, "k long, s long").groupBy("k").agg(F.sum(F.col("s").cast(_EXACT)).alias("s"))
    out = np.zeros((width, width), object)
    for r in parts.collect():  # a row per dimension and pair
        out[r["k"] // width, r["k"] % width] = int(r["s"])
    return out


def covariance(n: int, squares: np.ndarray, rest: list[int]) -> np.ndarray:
    """The covariance (divisor n) from the squares of single and paired dimensions, whose sums are ``rest``; exact until its last rounding."""
    width = len(rest)
    spread = [n * n * squares[i, i] - n * rest[i] ** 2 for i in range(width)]  # the sum of (n*x - S)**2
    out = np.empty((width, width))
    for i in range(width):
        out[i, i] = float(Fraction(spread[i], n**3))
        for j in range(i + 1, width):
            both = n * n * squares[i, j] - n * (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = float(Fraction(both - spread[i] - spread[j], 2 * n**3))
    return out


@dataclass
class Whitening:
    """Row k of ``axes`` is the unit eigenvector of the k-th largest eigenvalue ``values[k]``; ``total`` is the trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    total: float


def fit(vectors: DataFrame, n: int, width: int, components: int = COMPONENTS) -> Whitening:
    """The leading components of vectors ``x`` (array<long> of ``width`` entries)."""
    sums = _sums(vectors, width)
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    v = covariance(n, _squares(vectors, width, np.array(middle, np.int64)), rest)
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(n, sums, axes.T[order], values[order], float(np.trace(v)))


def _project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``id``, ``w`` (the whitened components), ``a`` and ``b``: what the exact deviation is made of.

    With y = x - m and R = S - n*m, the sum of (n*x - S)**2 is n**2 * sum(y**2) - 2n * sum(R*y) + sum(R**2).
    """
    n = model.n
    middle = np.array([s // n for s in model.sums], np.int64)
    rest = np.array([s - n * m for s, m in zip(model.sums, middle.tolist())], np.int64)
    share = rest / n
    floor = NO_SPREAD * max(float(model.values.max(initial=0.0)), 0.0)
    flat = model.values <= floor
    axes = model.axes / np.sqrt(np.where(flat, 1.0, model.values))[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y = _matrix(b) - middle
            w = (y - share) @ axes.T
            gaps = np.broadcast_to(flat, w.shape)
            w = pa.array(w.ravel(), mask=np.ascontiguousarray(gaps).ravel())
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(axes))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.ListArray.from_arrays(ends, w), pa.array((y * y).sum(axis=1)), pa.array((y * rest).sum(axis=1))], names=["id", "w", "a", "b"]
            )

    return vectors.mapInArrow(run, "id long, w array<double>, a long, b long")


def identity_error(whitened: DataFrame, n: int, count: int) -> float:
    """The largest entry of the whitened rows' covariance minus the identity; directions without spread are left out.

    Tasks centre by their own means, which are settled at the driver, so that nothing is lost to a common offset.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            w = b.column("w").flatten().fill_null(0.0).to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            mean = w.mean(axis=0)
            apart = (w - mean).T @ (w - mean) + b.num_rows * np.outer(mean, mean)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(count * (count + 1))), pa.array(np.concatenate([apart.ravel(), w.sum(axis=0)]))], names=["k", "s"]
            )

    parts = whitened.select("w").mapInArrow(run, "k long, s double").groupBy("k").agg(F.sum("s").alias("s"))
    flat = np.zeros(count * (count + 1))
    for r in parts.collect():  # a row per pair of components
        flat[r["k"]] = r["s"]
    mean = flat[count * count :] / n
    v = flat[: count * count].reshape(count, count) / n - np.outer(mean, mean)
    some = np.diag(v) > 0.5
    return float(np.abs(v - np.eye(count))[np.ix_(some, some)].max(initial=0.0))


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, vec: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """The whitened components of every usable vector, the largest eigenvalue first.

    Columns: vec_id, component (from 1), n (vectors of the fit), deviation (decimal: the exact sum over dimensions of
    (n*x - S)**2), whitened, explained (the eigenvalue's share of the trace), identity_error (one value).

    An entry c becomes floor(scale * c) + shift. Vectors that are null, empty or hold null or non-finite entries are left out, and
    so are vectors of another length than the commonest one (of equally common ones, the longer), which have
    no covariance with the others. A direction without spread (constant entries, a single vector) has a null
    ``whitened``; without any spread ``explained`` is null too. Repeated rows count as often as they are there. An empty table gives no
    rows. Entries beyond ``LARGEST`` / ``scale`` raise an error. Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(f"`{vec}`").cast("long").alias("id"), F.col(f"`{embedding}`").alias("e")).where(usable(F.col("e")))
    sizes = rows.groupBy(F.size("e").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not sizes:
        kinds = f"id long, component int, n long, deviation {_EXACT}, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], kinds).withColumnRenamed("id", vec)
    width, n = sizes[0]["width"], sizes[0]["count"]
    scaled = lambda x: F.when(
        F.abs(x.cast("double")) * F.lit(float(scale)) <= LARGEST, F.floor(x.cast("double") * F.lit(float(scale))) + shift
    ).otherwise(F.raise_error(F.lit(f"an entry is beyond {LARGEST} / {scale}")).cast("long"))
    vectors = stage(rows.where(F.size("e") == width).select("id", F.transform("e", scaled).alias("x")), "whole_vectors")
    model = fit(vectors, n, width, components)
    whitened = stage(_project(vectors, model), "whitened")
    error = identity_error(whitened, n, len(model.values))
    exact = lambda x: F.lit(str(x)).cast(_EXACT)
    left = sum((s - n * (s // n)) ** 2 for s in model.sums)
    deviation = exact(n * n) * F.col("a").cast(_EXACT) - exact(2 * n) * F.col("b").cast(_EXACT) + exact(left)
    shares = [float(v / model.total) if model.total > 0 else None for v in model.values]
    out = whitened.select("id", deviation.cast(_EXACT).alias("deviation"), F.posexplode("w").alias("k", "whitened"))
    explained = F.array(*[F.lit(s).cast("double") for s in shares])
    return out.select(
        F.col("id").alias(vec), (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
    )
