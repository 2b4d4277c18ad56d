"""Linear regression M13–M14.

Fitting is one scan: centred cross products of the inputs and the target
(:mod:`.moments`), then one solve of the model's width on the driver. Beyond 4,096
features Spark ML's L-BFGS takes over. The fitted model is stored as a coefficient table and scoring is
a literal dot-product projection — no vectors, no Python, whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from .moments import moments, solve

INTERCEPT = "__intercept__"
COEF_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType(), False),
    T.StructField("term", T.StringType(), False),
    T.StructField("coefficient", T.DoubleType(), False),
])

#: Up to so many features the normal equations are solved directly (128 MB on the driver).
MAX_DIRECT = 4096

SUPPORTED_MODELS = ("linear_regression",)


def fit_linear(train: DataFrame, features: Sequence[str], target: str,
               kind: str = "linear_regression", solver: str = "auto") -> DataFrame:
    """Ordinary least squares with intercept → ``(position, term, coefficient)``.

    A null, NaN or infinite value, or no row at all, is an error (as in the reference); clean
    first. Repeated or constant columns get the solution of least norm. ``solver="l-bfgs"``
    asks for Spark ML's iterations.
    """
    if kind not in SUPPORTED_MODELS:
        raise ValueError(f"Unsupported model type: {kind}")
    features = list(features)
    if not features:
        raise ValueError("No features to fit")
    if solver == "auto" and len(features) <= MAX_DIRECT:
        found = moments(train, [*features, target])
        if found.bad:
            raise ValueError(f"Input contains NaN, infinity or a missing value ({found.bad} row(s))")
        if not found.rows:
            raise ValueError("Found array with 0 sample(s)")
        coefs = [float(x) for x in solve(found.cross)]
        intercept = float(found.mean[-1] - found.mean[:-1] @ coefs)
    else:
        coefs, intercept = _fit_iterated(train, features, target, solver)
    rows = [(i, f, c) for i, (f, c) in enumerate(zip(features, coefs))]
    rows.append((len(features), INTERCEPT, intercept))
    return train.sparkSession.createDataFrame(rows, COEF_SCHEMA)


def _fit_iterated(train: DataFrame, features: list[str], target: str, solver: str) -> tuple[list[float], float]:
    assembled = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(features))],
                                outputCol="_features", handleInvalid="error").transform(
        train.select(*[col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)],
                     col(target).cast("double").alias("_label")))
    lr = LinearRegression(featuresCol="_features", labelCol="_label", regParam=0.0,
                          elasticNetParam=0.0, fitIntercept=True, solver=solver, maxIter=200,
                          tol=1e-10)
    model = lr.fit(assembled)
    return [float(x) for x in model.coefficients.toArray()], float(model.intercept)


def fit_simple(train: DataFrame, feature: str, target: str) -> DataFrame:
    """M13 single-feature closed form with SQL aggregates: ``(slope, intercept, n)``."""
    x, y = col(feature).cast("double"), col(target).cast("double")
    return train.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                     F.regr_count(y, x).cast("long").alias("n"))


def prediction_expr(coef_rows: Sequence) -> F.Column:
    """``b + Σ wᵢ·xᵢ`` from collected coefficient rows (one per model input)."""
    intercept = 0.0
    expr = None
    for r in sorted(coef_rows, key=lambda r: r["position"]):
        if r["term"] == INTERCEPT:
            intercept = r["coefficient"]
            continue
        term = col(r["term"]).cast("double") * F.lit(r["coefficient"])
        expr = term if expr is None else expr + term
    return F.lit(intercept) if expr is None else F.lit(intercept) + expr


def predict(df: DataFrame, coefficients: DataFrame, out: str = "prediction",
            keep: Sequence[str] | None = None) -> DataFrame:
    """Append (or, with ``keep``, project) the model's prediction."""
    rows = coefficients.collect()
    needed = [r["term"] for r in rows if r["term"] != INTERCEPT]
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise KeyError(f"Model inputs missing from frame: {missing}")
    pred = prediction_expr(rows).alias(out)
    if keep is None:
        return df.select("*", pred)
    return df.select(*[col(k) for k in keep], pred)
