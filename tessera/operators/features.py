"""Feature expressions E1–E4: weighted sums and differences of columns.

The reference hard-codes four housing features; here they are data (a spec
list), and the housing spec lives in :mod:`tessera.config`. The input frame is
kept whole and the derived columns are appended in one projection. A null
operand gives a null result; a missing operand is an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions.columns import col, weighted_sum_expr


def _require(df: DataFrame, names: Sequence[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise KeyError(f"Feature input columns not found: {absent}")


def weighted_sum(df: DataFrame, out: str, weights: Mapping[str, float]) -> DataFrame:
    """``out = Σ wᵢ·colᵢ``."""
    _require(df, list(weights))
    return df.withColumn(out, weighted_sum_expr(weights))


def difference(df: DataFrame, out: str, a: str, b: str) -> DataFrame:
    """``out = a − b`` (integer in, integer out)."""
    _require(df, [a, b])
    return df.withColumn(out, col(a) - col(b))


def engineer(df: DataFrame, spec: Sequence[Mapping]) -> DataFrame:
    """Apply a list of derived-column definitions in one projection.

    Each entry is ``{"name": out, "weights": {col: w}}`` or
    ``{"name": out, "minus": [a, b]}``.
    """
    exprs = []
    for d in spec:
        if "weights" in d:
            _require(df, list(d["weights"]))
            exprs.append(weighted_sum_expr(d["weights"]).alias(d["name"]))
        elif "minus" in d:
            a, b = d["minus"]
            _require(df, [a, b])
            exprs.append((col(a) - col(b)).alias(d["name"]))
        else:
            raise ValueError(f"Unknown feature definition: {d}")
    names = {d["name"] for d in spec}
    return df.select(*[col(c) for c in df.columns if c not in names], *exprs)
