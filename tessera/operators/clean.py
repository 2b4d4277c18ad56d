"""Cleaning F1–F14 and group imputation W1–W2.

All steps are projections / filters that Catalyst collapses into one stage;
only the group-mean imputation needs an aggregate, which is computed with
partial aggregation and joined back as a small lookup table.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, is_numeric, nan_to_null, numeric_columns, present, string_columns
from ..session import materialize
from .joins import join_small

log = logging.getLogger(__name__)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """rename by map; names absent from the frame are ignored.

    Refuses a rename whose result differs from another column only by case:
    Spark resolves names case-insensitively and would fail later with an
    ambiguous reference.
    """
    active = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    if not active:
        return df
    final = [active.get(c, c) for c in df.columns]
    lowered: dict[str, str] = {}
    for name in final:
        if name.lower() in lowered and lowered[name.lower()] != name or final.count(name) > 1:
            raise ValueError(f"Rename produces colliding column name: {name}")
        lowered[name.lower()] = name
    return df.select(*[col(c).alias(active.get(c, c)) for c in df.columns])


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop columns, ignoring absent ones."""
    gone = set(present(df, cols))
    if not gone:
        return df
    return df.select(*[col(c) for c in df.columns if c not in gone])


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """numeric null (and NaN) → 0 for the configured columns that exist."""
    targets = set(present(df, cols))
    non_num = [c for c in targets if not is_numeric(df.schema[c].dataType)]
    if non_num:
        log.warning("fill_zero: non-numeric columns left unchanged: %s", non_num)
    targets -= set(non_num)
    return df.select(*[
        (F.coalesce(F.nanvl(col(c), F.lit(None)) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
                    else col(c), F.lit(0)).cast(df.schema[c].dataType).alias(c)
         if c in targets else col(c))
        for c in df.columns
    ])


def fill_label(df: DataFrame, cols: Sequence[str], label: str = "None") -> DataFrame:
    """text null → a label. Spark's ``fillna`` would skip non-text columns silently; warn."""
    targets = set(present(df, cols))
    non_txt = [c for c in targets if not isinstance(df.schema[c].dataType, T.StringType)]
    if non_txt:
        log.warning("fill_label: non-text columns left unchanged: %s", non_txt)
    targets -= set(non_txt)
    return df.select(*[
        (F.coalesce(col(c), F.lit(label)).alias(c) if c in targets else col(c)) for c in df.columns
    ])


def complete_rows(df: DataFrame, cols: Sequence[str]) -> Column | None:
    """Predicate: no null (or NaN) in any configured column that exists (None if none exist)."""
    cond = None
    for c in present(df, cols):
        ok = col(c).isNotNull()
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            ok = ok & ~F.isnan(col(c))
        cond = ok if cond is None else cond & ok
    return cond


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop rows with a null (or NaN) in any configured column that exists."""
    cond = complete_rows(df, cols)
    return df if cond is None else df.where(cond)


def group_means(df: DataFrame, column: str, by: str) -> DataFrame:
    """W1 (fit): ``(group, mean)`` of the non-null, non-NaN values; null keys form no group.

    One partial aggregate: a hot group costs one row per task.
    """
    return (nan_to_null(df, [column]).where(col(by).isNotNull()).groupBy(col(by).alias("group"))
            .agg(F.avg(col(column).cast("double")).alias("mean")))


def fit_group_means(train: DataFrame, cfg: Mapping) -> DataFrame | None:
    """The configured group means over training rows, written once; None without such a setting."""
    grp = cfg.get("preprocessing", cfg).get("fillna_groupby") or {}
    if not grp or grp["column"] not in train.columns or grp["groupby"] not in train.columns:
        return None
    return materialize(group_means(train, grp["column"], grp["groupby"]), name="group-means")


def impute_group_mean(df: DataFrame, column: str, by: str, method: str = "mean",
                      residual: float | None = None, means: DataFrame | None = None) -> DataFrame:
    """W1 (+W2): null or NaN → mean of the row's own group; optionally residual nulls → constant.

    ``means`` is a fitted ``(group, mean)`` table; without it the means are those of ``df``
    itself, written once. They are joined back as a lookup: broadcast when their size is
    bounded, shuffled (AQE splits skewed keys) otherwise. A null
    group key matches no group, so such rows keep their own value.
    """
    if method != "mean":
        raise ValueError(f"Unsupported fillna_groupby method: {method}")
    if column not in df.columns or by not in df.columns:
        log.warning("impute_group_mean: %s or %s absent, skipped", column, by)
        return df
    if means is None:
        means = materialize(group_means(df, column, by), name="group-means")
    df = nan_to_null(df, [column])
    lookup = means.select(F.col("group").alias("_gkey"), F.col("mean").alias("_gmean"))
    joined = join_small(df.withColumn("_gkey", col(by)), lookup, on="_gkey", how="left")
    dt = df.schema[column].dataType
    filled = F.coalesce(col(column).cast("double"), F.col("_gmean"))
    if residual is not None:
        filled = F.coalesce(filled, F.lit(float(residual)))
    if not isinstance(dt, (T.FloatType, T.DoubleType)):
        # The reference's integer column turns float when a mean is written into it.
        dt = T.DoubleType()
    return joined.select(*[
        (filled.cast(dt).alias(c) if c == column else col(c)) for c in df.columns
    ])


def clean(df: DataFrame, cfg: Mapping) -> DataFrame:
    """the reference's fixed order F1 → F2 → F3 → F4 → W1 → F5; with a group mean configured it runs a job at once, to fit it.

    ``cfg`` is the ``preprocessing`` mapping (or a full config holding one).
    An empty mapping is the identity.
    """
    kept, _ = clean_with_dropped(df, cfg)
    return kept


def clean_with_dropped(df: DataFrame, cfg: Mapping,
                       means: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """F6 + J4: the cleaned frame and the rows F5 removes, both from one plan.

    The removed rows are the ones failing F5's predicate, so reporting them
    needs no join against the input. ``means`` are fitted group means (W1); without
    them a configured group mean is taken over ``df``, which runs a job.
    """
    return impute_and_filter(row_local_clean(df, cfg), cfg, means)


def row_local_clean(df: DataFrame, cfg: Mapping) -> DataFrame:
    """F1 → F4: the steps that look at one row at a time (a single projection)."""
    pre = cfg.get("preprocessing", cfg)
    out = rename(df, pre.get("rename_columns", {}) or {})
    out = drop(out, pre.get("drop_columns", []) or [])
    fill = pre.get("fillna", {}) or {}
    zero = fill.get("numerical_zero", []) or []
    grp = pre.get("fillna_groupby") or {}
    if grp and grp.get("column") in zero:
        log.warning("fillna_groupby column %s is also zero-filled; group mean will not apply",
                    grp.get("column"))
    out = fill_zero(out, zero)
    return fill_label(out, fill.get("categorical_none", []) or [])


def impute_and_flag(df: DataFrame, cfg: Mapping, means: DataFrame | None = None, flag: str = "_complete") -> DataFrame:
    """W1 → F5 on an already row-cleaned frame: all rows, with whether F5 keeps them."""
    pre = cfg.get("preprocessing", cfg)
    grp = pre.get("fillna_groupby") or {}
    out = df
    if grp:
        out = impute_group_mean(out, grp["column"], grp["groupby"], grp.get("method", "mean"), means=means)
    cond = complete_rows(out, pre.get("dropna_rows", []) or [])
    return out.withColumn(flag, F.lit(True) if cond is None else cond)


def impute_and_filter(df: DataFrame, cfg: Mapping,
                      means: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """W1 → F5 on an already row-cleaned frame: ``(kept, dropped)``."""
    flagged = impute_and_flag(df, cfg, means)
    return flagged.where("_complete").drop("_complete"), flagged.where("not _complete").drop("_complete")


def exclude(df: DataFrame, condition: Column) -> DataFrame:
    """remove rows matching ``condition``; a null comparison keeps the row (as pandas)."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F8: ordered subset; a missing column is an error."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise KeyError(f"Columns not found: {absent}")
    return df.select(*[col(c) for c in cols])


def select_or_default(df: DataFrame, cols: Sequence[str], default: float = 0.0,
                      keep: Sequence[str] = ()) -> DataFrame:
    """selected columns in order; absent ones become a constant (``keep`` passes through first)."""
    have = set(df.columns)
    return df.select(*[col(k) for k in keep],
                     *[(col(c) if c in have else F.lit(default).cast("double").alias(c)) for c in cols])


def by_type(df: DataFrame, kind: str) -> DataFrame:
    """keep only numeric or only text columns."""
    if kind == "numeric":
        names = numeric_columns(df)
    elif kind in ("text", "object", "string"):
        names = string_columns(df)
    else:
        raise ValueError(f"Unknown column kind: {kind}")
    return df.select(*[col(c) for c in names])


def as_label(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """treat numeric codes as categories (cast to text)."""
    targets = set(present(df, cols))
    return df.select(*[(col(c).cast("string").alias(c) if c in targets else col(c)) for c in df.columns])


def drop_sparse(df: DataFrame, max_pct: float = 80.0) -> DataFrame:
    """drop columns whose null share exceeds ``max_pct`` percent.

    The profile is one aggregate; only the column names (schema metadata)
    come back to the driver.
    """
    from .profile import missing_profile
    sparse = [r["column_name"] for r in missing_profile(df, above=max_pct).select("column_name").collect()]
    return drop(df, sparse)
