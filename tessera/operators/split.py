"""Train / valid / test assignment M11–M12.

A row's split is a pure function of its key and the seed — a hash bucket —
so the assignment is the same however the data is partitioned or re-read,
needs no shuffle, and is a column in the row rather than separate frames.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col

DEFAULT_FRACTIONS = {"train": 0.6, "valid": 0.2, "test": 0.2}


def bucket(key: Column, seed: int = 42, buckets: int = 10_000, method: str = "hash") -> Column:
    """Bucket in ``[0, buckets)``.

    ``hash`` (default) works for any key type. ``arith`` is a plain integer
    formula, ``(key mod 1000003 · 7919 + seed · 104729) mod buckets``, that SQL
    engines without Spark's hash can reproduce exactly.
    """
    if method == "hash":
        return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets))
    if method == "arith":
        k = F.pmod(key.cast("long"), F.lit(1000003))
        return F.pmod(k * F.lit(7919) + F.lit(seed * 104729), F.lit(buckets))
    raise ValueError(f"Unknown split method: {method}")


def split(df: DataFrame, key: str, fractions: Mapping[str, float] = DEFAULT_FRACTIONS,
          seed: int = 42, buckets: int = 10_000, method: str = "hash", out: str = "split") -> DataFrame:
    """Add a ``split`` column with the named fractions (in the given order)."""
    total = sum(fractions.values())
    if abs(total - 1.0) > 1e-9:
        raise ValueError(f"Split fractions must sum to 1, got {total}")
    b = bucket(col(key), seed, buckets, method)
    names = list(fractions)
    expr = None
    cum = 0.0
    for name in names[:-1]:
        cum += fractions[name]
        edge = int(round(cum * buckets))
        expr = F.when(b < F.lit(edge), F.lit(name)) if expr is None else expr.when(b < F.lit(edge), F.lit(name))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return df.withColumn(out, expr)


def split_frames(df: DataFrame, names=tuple(DEFAULT_FRACTIONS), split_col: str = "split") -> dict[str, DataFrame]:
    """Convenience view of a split column as filtered frames (no data is copied)."""
    return {n: df.where(F.col(split_col) == n) for n in names}
