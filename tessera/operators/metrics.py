"""Regression metrics R1–R7.

One aggregate pass (optionally per group, e.g. per split) gives n, MSE, MAE
and the population variance of the target; RMSE and R² are derived. The
variance comes from Spark's streaming central-moment aggregate, which stays
accurate for large values, so no second pass over the data is needed.

Edge cases follow the reference's library: perfect fit on a constant target
gives R² = 1, an imperfect one 0; fewer than two rows give NaN; an empty
input or a NaN / infinite / missing value is an error — raised inside the same
job with ``raise_error``, so validation costs no extra scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, is_finite

METRICS = ("mse", "rmse", "mae", "r2")
_ALIASES = {"mse": "mse", "rmse": "rmse", "mae": "mae", "r2": "r2", "r²": "r2"}


def metric_names(names: Sequence[str] | None) -> list[str]:
    """Configured metric list (any case) → canonical names."""
    if not names:
        return list(METRICS)
    out = []
    for n in names:
        key = _ALIASES.get(str(n).lower())
        if key is None:
            raise ValueError(f"Unknown metric: {n}")
        out.append(key)
    return out


def regression_metrics(df: DataFrame, y: str, p: str, by: str | Sequence[str] | None = None,
                       metrics: Sequence[str] | None = None, check: bool = True) -> DataFrame:
    """``(by…, n, mse, rmse, mae, r2)`` for true column ``y`` and prediction ``p``."""
    yt, yp = col(y).cast("double"), col(p).cast("double")
    err = yt - yp
    aggs = [
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg(err * err).alias("_mse"),
        F.avg(F.abs(err)).alias("_mae"),
        F.var_pop(yt).alias("_var"),
        F.count_if(~(is_finite(yt) & is_finite(yp))).alias("_bad"),
    ]
    keys = [] if by is None else ([by] if isinstance(by, str) else list(by))
    grouped = df.groupBy(*[col(k) for k in keys]).agg(*aggs) if keys else df.agg(*aggs)
    nan = F.lit(float("nan"))
    r2 = (F.when(F.col("n") < 2, nan)
          .when(F.col("_var") == 0, F.when(F.col("_mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_mse") / F.col("_var")))
    guard = None
    if check:
        guard = (F.when(F.col("n") == 0, F.raise_error(F.lit("Found array with 0 sample(s)")))
                 .when(F.col("_bad") > 0,
                       F.raise_error(F.lit("Input contains NaN, infinity or a missing value"))))
    exprs = {
        "mse": F.col("_mse"),
        "rmse": F.sqrt(F.col("_mse")),
        "mae": F.col("_mae"),
        "r2": r2,
    }
    chosen = metric_names(metrics)
    out = [F.col(k) for k in keys] + [F.col("n")]
    for m in chosen:
        e = exprs[m]
        if guard is not None:
            e = F.coalesce(guard.cast("double"), e)
        out.append(e.alias(m))
    return grouped.select(*out)


def evaluate_saved(df: DataFrame, y: str = "y_true", p: str = "y_pred",
                   by: str | None = None) -> DataFrame:
    """Metrics over a stored ``(key, y_true, y_pred)`` table."""
    return regression_metrics(df, y, p, by=by)


def metrics_long(metrics: DataFrame, by: str | None = "split") -> DataFrame:
    """K4 long form ``(split, metric, value)`` of a metrics frame."""
    names = [m for m in METRICS if m in metrics.columns]
    ids = [by] if by and by in metrics.columns else []
    return metrics.unpivot(ids, names, "metric", "value")
