"""Keyed alignment (J1–J4), set operations (U1–U2) and the small-side join helper.

The reference aligns frames by position; an unordered engine can only align
by a business key, so every function here takes ``key``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, present, string_columns
from ..session import materialize
from .observe import Watch

# Largest number of rows a derived parameter table may have and still be
# shipped to every executor as a broadcast hash table.
MAX_BROADCAST_ROWS = 2_000_000
# ... and the characters its text columns may hold in all.
MAX_BROADCAST_CHARS = 256_000_000


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                   max_chars: int = MAX_BROADCAST_CHARS) -> bool:
    """Size check of a materialised table: rows and characters (partial sums per task, one row back)."""
    chars = sum((F.coalesce(F.length(col(c)), F.lit(0)).cast("long") for c in string_columns(df)), F.lit(0))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(chars), F.lit(0)).alias("chars")).first()
    return size["n"] <= max_rows and size["chars"] <= max_chars


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: str,
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join a derived lookup table (one row per key) onto a large frame.

    ``small`` should already be materialised (its size check must not re-run
    the job that built it). Below the bound it is broadcast, so the large side
    is neither shuffled nor exposed to key skew. Above it the plan falls back
    to a shuffled join, whose hot keys AQE's skew join splits. The rows are the same.
    """
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), on=on, how=how)
    return big.join(small, on=on, how=how)


def paired(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``(key, a, b, n_a, n_b)``, one row per key of either side: one row of each side as a struct, and how many there are.

    A tagged union grouped once, so that pairs and side counts come from the same exchange.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        others = [col(c) for c in df.columns if c != key]
        row = F.struct(*others) if others else F.struct(F.lit(True).alias("_"))
        return df.select(col(key).alias("key"), row.alias(tag))

    both = side(a, "a").unionByName(side(b, "b"), allowMissingColumns=True)
    return both.groupBy("key").agg(F.any_value("a", ignoreNulls=True).alias("a"), F.any_value("b", ignoreNulls=True).alias("b"),
                                   F.count("a").alias("n_a"), F.count("b").alias("n_b"))


def _side_counts() -> list:
    matched = (F.col("n_a") == 1) & (F.col("n_b") == 1) & F.col("key").isNotNull()
    return [F.count_if(matched).alias("n_matched"), F.count_if(F.col("n_b") == 0).alias("only_a"),
            F.count_if(F.col("n_a") == 0).alias("only_b"), F.count_if(F.col("n_a") > 1).alias("dup_a"),
            F.count_if(F.col("n_b") > 1).alias("dup_b"), F.count_if(~F.coalesce(matched, F.lit(False))).alias("bad")]


def align_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """J2 as a report: keys matched one to one, on one side only, repeated on a side, and not matched one to one."""
    return paired(a, b, key).agg(*_side_counts())


def align(a: DataFrame, b: DataFrame, key: str, strict: bool = True) -> DataFrame:
    """Pair rows of two frames by key (the reference pairs by position).

    ``strict`` checks that both sides have unique keys and the same key set (null is no key),
    the keyed equivalent of the reference's length check on y_true / y_pred. The check is
    counted while the pairs are written; the result reads them.
    """
    # The key is referenced literally (names may hold dots or spaces).
    if not strict:
        return a.join(b.withColumnRenamed(key, "_k"), col(key) == F.col("_k"), "inner").drop("_k")
    watch = Watch(*_side_counts())
    pairs = materialize(watch.on(paired(a, b, key)), name="aligned")
    stats = watch.get()
    if stats["bad"]:
        raise ValueError(
            f"Inconsistent numbers of samples: {stats['bad']} key(s) unmatched or repeated "
            f"(repeated in first: {stats['dup_a']}, in second: {stats['dup_b']})"
        )
    names = [(c, "a") for c in a.columns if c != key] + [(c, "b") for c in b.columns if c != key]
    chosen = {c: F.col(tag).getField(c).alias(c) for c, tag in names}
    return pairs.select(*[F.col("key").alias(key) if c == key else chosen[c] for c in a.columns],
                        *[F.col("b").getField(c).alias(c) for c in b.columns if c != key])


def dropped_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys present before a cleaning step and gone after it."""
    left = before.select(col(key).alias("_k"))
    right = after.select(col(key).alias("_k"))
    return left.join(right, on="_k", how="left_anti").select(F.col("_k").alias(key))


def union_splits(*frames: DataFrame) -> DataFrame:
    """Concatenate frames by column name, missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def column_difference(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Wanted columns that the frame lacks (driver-side schema metadata)."""
    have = set(present(df, wanted))
    return [c for c in wanted if c not in have]
