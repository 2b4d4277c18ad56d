"""Feature scoring and selection M8–M10.

All features are scored in **one** aggregate pass: per feature, the count of
complete pairs, ``covar_pop`` and the two ``var_pop`` over those pairs. The
correlation and the regression F statistic (``r² / (1 − r²) · (n − 2)``) are
derived from that row; a zero variance gives a null score, ranked last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, nan_to_null, per_column_agg


def f_scores(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """M8: ``(feature, n, r, f_score)`` for every feature against ``target``."""
    df = nan_to_null(df, [target])
    x, y = F.col("x"), F.col("_y")
    both = x.isNotNull() & y.isNotNull()
    xb, yb = F.when(both, x), F.when(both, y)
    long = per_column_agg(df, features, lambda c, _n: {"x": c.cast("double")}, {
        "n": F.count_if(both).cast("long"),
        "cov": F.covar_pop(xb, yb),
        "vx": F.var_pop(xb),
        "vy": F.var_pop(yb),
    }, carry={"_y": col(target).cast("double")})
    r = F.when((F.col("vx") > 0) & (F.col("vy") > 0),
               F.col("cov") / F.sqrt(F.col("vx") * F.col("vy")))
    return (long.select(F.col("column_name").alias("feature"), "n", r.alias("r"))
            .withColumn("f_score", f_statistic(F.col("r"), F.col("n"))))


def f_statistic(r: Column, n: Column) -> Column:
    """The regression F statistic of a correlation over ``n`` pairs; null without one."""
    r2 = r * r
    return (F.when(r.isNull(), F.lit(None).cast("double"))
            .when(r2 >= 1.0, F.lit(float("inf")))
            .otherwise(r2 / (F.lit(1.0) - r2) * (n - 2)))


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """``k`` highest scores (ties by name; null scores last) — a bounded top-k."""
    return scores.orderBy(F.col("f_score").desc_nulls_last(), F.col("feature")).limit(k)


def select_k(scores: DataFrame, k: int, keep: Sequence[str] = (),
             params: DataFrame | None = None, wide: Sequence[str] = ()) -> DataFrame:
    """``(position, feature)``: top-k of the non-kept features, then the kept ones.

    ``keep`` names *source* columns (or output names). The source is taken from
    ``scores`` if it has that column, else from a transformer parameter table, else it
    is the feature itself. Every output derived from a kept source is kept — e.g. all
    one-hot columns of ``kitchen_qual`` — and excluded from the ranking. Ranking is a
    top-k in Spark; only the chosen features reach the driver, so a column with many
    categories costs nothing there unless it is a kept one. Kept sources in ``wide`` are left
    out here: they are fitted and scored by lookup (:mod:`.sparse`).
    """
    spark = scores.sparkSession
    if "source" not in scores.columns and params is not None:
        source = params.select(F.col("output").alias("_output"), "source")
        scores = scores.join(source, F.col("feature") == F.col("_output"), "left")
    source = F.coalesce("source", "feature") if "source" in scores.columns else F.col("feature")
    kept = F.col("feature").isin(list(keep)) | source.isin(list(keep))
    ranked = [r["feature"] for r in top_k(scores.where(~kept).select("feature", "f_score"), k).collect()]
    narrow = kept & ~source.isin(list(wide))
    always = sorted(r["feature"] for r in scores.where(narrow).select("feature").collect()) if keep else []
    schema = T.StructType([T.StructField("position", T.IntegerType(), False),
                           T.StructField("feature", T.StringType(), False)])
    return spark.createDataFrame(list(enumerate(ranked + always)), schema)
