"""Means and centred cross products of a few columns in one scan.

Each task keeps ``(n, mean, M)`` with ``M = Σ w (x − mean)(x − mean)ᵀ`` and merges batch by
batch with the pairwise update, so large offsets cost no digits. Two rounds of merging follow,
each over one small row per task. Spark has no built-in aggregate that adds up matrices
(one SQL aggregate per pair of columns loses code generation from a dozen columns on), hence Arrow
batches and one matrix product per batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, is_finite

MERGERS = 32


class Moments(NamedTuple):
    """``weight``: sum of weights; ``rows``; ``bad``: rows left out for a null, NaN or infinite value."""
    weight: float
    rows: int
    bad: int
    mean: np.ndarray
    cross: np.ndarray


def merge(a: Moments, b: Moments) -> Moments:
    weight = a.weight + b.weight
    if not weight:
        return Moments(0.0, a.rows + b.rows, a.bad + b.bad, a.mean, a.cross)
    delta = b.mean - a.mean
    return Moments(weight, a.rows + b.rows, a.bad + b.bad, a.mean + delta * (b.weight / weight),
                   a.cross + b.cross + np.outer(delta, delta) * (a.weight * b.weight / weight))


def _nothing(width: int) -> Moments:
    return Moments(0.0, 0, 0, np.zeros(width), np.zeros((width, width)))


def _of_batch(x: np.ndarray, w: np.ndarray, bad: int) -> Moments:
    total = float(w.sum())
    if not total:
        return Moments(0.0, len(w), bad, np.zeros(x.shape[1]), np.zeros((x.shape[1],) * 2))
    mean = (w @ x) / total
    centred = x - mean
    return Moments(total, len(w), bad, mean, (centred * w[:, None]).T @ centred)


def _row(m: Moments) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"weight": [m.weight], "n": [m.rows], "bad": [m.bad],
                                       "mean": [m.mean.tolist()], "cross": [m.cross.reshape(-1).tolist()]})


def _partial(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _nothing(width)
        for batch in batches:
            fine = np.asarray(batch.column(0)).astype(bool)
            data = [batch.column(i).to_numpy(zero_copy_only=False).astype(float)[fine] for i in range(1, width + 2)]
            total = merge(total, _of_batch(np.stack(data[1:], axis=1), data[0], int((~fine).sum())))
        yield _row(total)
    return run


def _from_rows(batch: pa.RecordBatch, width: int) -> Iterator[Moments]:
    for r in batch.to_pylist():
        yield Moments(r["weight"], r["n"], r["bad"], np.array(r["mean"]), np.array(r["cross"]).reshape(width, width))


def _merged(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _nothing(width)
        for batch in batches:
            for m in _from_rows(batch, width):
                total = merge(total, m)
        yield _row(total)
    return run


SCHEMA = "weight double, n bigint, bad bigint, mean array<double>, cross array<double>"


def moments(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> Moments:
    """One scan of ``df``; a row with a null, NaN or infinite value is counted in ``bad`` and left out."""
    columns = list(columns)
    fine = None
    for c in columns:
        ok = is_finite(col(c))
        fine = ok if fine is None else fine & ok
    w = F.lit(1.0) if weight is None else col(weight).cast("double")
    slim = df.select(fine.alias("fine"), w.alias("w"), *[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    width = len(columns)
    rows = slim.mapInArrow(_partial(width), SCHEMA)
    rows = rows.repartition(MERGERS).mapInArrow(_merged(width), SCHEMA).coalesce(1).mapInArrow(_merged(width), SCHEMA)
    return next(_from_rows(pa.RecordBatch.from_pylist([r.asDict() for r in rows.collect()]), width))


def solve(cross: np.ndarray) -> np.ndarray:
    """Least squares of the last column on the others from centred cross products.

    Columns are brought to unit length first. A matrix that is not positive definite (repeated or
    constant columns) gets the solution of least norm.
    """
    a, b = cross[:-1, :-1], cross[:-1, -1]
    size = np.sqrt(np.maximum(np.diag(a), 0))
    scale = np.where(size > 0, size, 1.0)
    unit, right = a / np.outer(scale, scale), b / scale
    try:
        lower = np.linalg.cholesky(unit)
        if np.diag(lower).min(initial=1.0) > 1e-6:
            return np.linalg.solve(lower.T, np.linalg.solve(lower, right)) / scale
    except np.linalg.LinAlgError:
        pass
    # Least norm in the columns' own units, as a singular value solver of the centred table gives it.
    values, vectors = np.linalg.eigh(a)
    keep = values > values.max(initial=0) * 1e-12
    return vectors[:, keep] @ ((vectors[:, keep].T @ b) / values[keep])
