"""Fitted feature transformers M1–M7, M15: one-hot encoding and scaling.

*Fit* is one aggregation pass over the source columns for every scaler statistic,
every categorical column's distinct values and, where a target is given, every
output's F-score. The result is a **parameter table** (one row per output feature)
that stays in Spark: a column may have any number of categories. *Transform* is a
single projection built from the rows of the wanted outputs, so scoring needs no
shuffle and no Python per row.

Semantics follow the reference's transformer:
- one-hot: categories sorted; ``drop="first"`` drops the first sorted one;
  an unseen value (or a null) encodes as all zeros; with ``null_category`` a null
  in the training rows is a category of its own, after all others (output ``…_%null``);
- standard scale: ``(x − mean) / std_pop``; min-max: ``(x − min) / (max − min)``;
  a zero spread divides by 1; nulls are ignored when fitting and stay null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, is_numeric, nan_to_null, present, safe_name
from ..session import materialize
from .select import f_statistic

# Outputs are ordered by (position of the source column, number, category).
PARAMS_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType(), False),
    T.StructField("block", T.StringType(), False),       # onehot | scaler
    T.StructField("source", T.StringType(), False),      # input column
    T.StructField("output", T.StringType(), False),      # output column name
    T.StructField("category", T.StringType(), True),     # one-hot value (as text); null: the null category
    T.StructField("number", T.DoubleType(), True),       # ... and as a number, in a numeric column
    T.StructField("method", T.StringType(), True),       # standard | minmax
    T.StructField("center", T.DoubleType(), True),
    T.StructField("scale", T.DoubleType(), True),
])


#: Ends the output name of a null category; in other names ``%`` is followed by a code.
NULL_NAME = "%null"


def transformer_spec(cfg: Mapping, df: DataFrame) -> dict:
    """M4: which columns go to which block, from the config and the columns present."""
    feats = cfg.get("features", {})
    pre = cfg.get("preprocessing", {})
    categorical = present(df, feats.get("categorical", []))
    ordinal = present(df, feats.get("ordinal", []))
    continuous = present(df, feats.get("continuous", []))
    engineered = present(df, feats.get("engineered", []))
    onehot = (pre.get("encoding", {}) or {}).get("one_hot", {}) or {}
    scaling = pre.get("scaling", {}) or {}
    method = scaling.get("method", "standard") if scaling else None
    if method not in (None, "standard", "minmax"):
        raise ValueError(f"Unsupported scaling method: {method}")
    apply_to = scaling.get("apply_to", []) if scaling else []
    numeric: list[str] = []
    if "continuous" in apply_to:
        numeric += continuous
    if "ordinal" in apply_to:
        numeric += ordinal
    # Engineered features are scaled numerics too (the reference drops them unused).
    numeric += [c for c in engineered if c not in numeric]
    return {
        "categorical": categorical if onehot else [],
        "numeric": numeric if scaling else [],
        "method": method,
        "drop": onehot.get("drop"),
        "handle_unknown": onehot.get("handle_unknown", "ignore"),
        "null_category": bool(onehot.get("null_category", False)),
        "inputs": categorical + ordinal + continuous,
    }


def _fit_stats(train: DataFrame, spec: Mapping, target: str | None) -> DataFrame:
    """The one pass of a fit, written out: a row per (categorical column, category), per numeric column and for the target.

    A train row gives one melted row per *source* column, however many categories
    there are; partial aggregation runs before the shuffle, so a frequent category
    costs one row per task.
    """
    none = F.lit(None)

    def entry(role: str, name: str, category=none, x=none):
        return F.struct(F.lit(role).alias("role"), F.lit(name).alias("column_name"),
                        category.cast("string").alias("category"), x.cast("double").alias("x"))

    parts = ([entry("category", c, category=col(c)) for c in spec["categorical"]]
             + [entry("number", c, x=col(c)) for c in spec["numeric"]])
    if target is not None:
        parts.append(entry("target", target))
    long = (train.select((col(target) if target is not None else none).cast("double").alias("y"),
                         F.explode(F.array(*parts)).alias("e")).select("y", "e.*")
            .where((F.col("role") != "category") | F.col("category").isNotNull() | F.lit(spec["null_category"])))
    x, y = F.col("x"), F.col("y")
    both = x.isNotNull() & y.isNotNull()
    return materialize(long.groupBy("role", "column_name", "category").agg(
        F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("lo"), F.max(x).alias("hi"),
        F.count(y).alias("n_y"), F.avg(y).alias("mean_y"), F.var_pop(y).alias("var_y"),
        F.count_if(both).cast("long").alias("n_both"), F.covar_pop(F.when(both, x), F.when(both, y)).alias("cov"),
        F.var_pop(F.when(both, x)).alias("var_xb"), F.var_pop(F.when(both, y)).alias("var_yb")), name="transformer-fit")


def fit_transformer(train: DataFrame, cfg: Mapping) -> DataFrame:
    """M6 (fit part): parameter table fitted on ``train`` only, in one aggregate pass."""
    return _fit(train, cfg, None)[0]


def fit_scored(train: DataFrame, cfg: Mapping, target: str) -> tuple[DataFrame, DataFrame]:
    """M6 + M8 in the same pass: ``(params, scores (feature, source, n, r, f_score))``.

    A one-hot output is 1 in the rows of its category and 0 in all others, so its
    correlation with the target follows from the category's count and target mean;
    scaling a column leaves its correlation as it is. Equal to
    :func:`~.select.f_scores` over the transformed matrix, which is never built.
    """
    return _fit(train, cfg, target)


def _fit(train: DataFrame, cfg: Mapping, target: str | None) -> tuple[DataFrame, DataFrame | None]:
    spec = transformer_spec(cfg, train)
    spark = train.sparkSession
    train = nan_to_null(train)
    cats, nums = spec["categorical"], spec["numeric"]
    if cats and spec["handle_unknown"] != "ignore":
        raise ValueError("Only handle_unknown='ignore' is supported")
    if not cats and not nums:
        return (spark.createDataFrame([], PARAMS_SCHEMA),
                spark.createDataFrame([], "feature string, source string, n long, r double, f_score double")
                if target is not None else None)
    stats = _fit_stats(train, spec, target)
    numeric_cats = [c for c in cats if is_numeric(train.schema[c].dataType)]
    name, category = F.col("column_name"), F.col("category")
    onehot = stats.where("role = 'category'").withColumn(
        "number", F.when(name.isin(numeric_cats), category.try_cast("double")))
    if spec["drop"] == "first":
        # One row per categorical column. The null category is the first one only where it is the only one.
        value = F.when(category.isNotNull(), F.struct("number", "category"))
        for r in onehot.groupBy(name).agg(F.min(value).alias("first")).collect():
            first = r["first"]["category"] if r["first"] else None
            onehot = onehot.where((name != F.lit(r["column_name"])) | ~category.eqNullSafe(F.lit(first).cast("string")))
    escaped = F.replace(F.replace(F.replace(category, F.lit("%"), F.lit("%25")), F.lit("."), F.lit("%2E")),
                        F.lit("`"), F.lit("%60"))
    place, prefix = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, c in enumerate(cats):
        place = F.when(name == F.lit(c), F.lit(i)).otherwise(place)
        prefix = F.when(name == F.lit(c), F.lit(f"onehot__{safe_name(c)}_")).otherwise(prefix)
    onehot = onehot.withColumn("position", place).withColumn("output", F.concat(prefix, F.coalesce(escaped, F.lit(NULL_NAME))))
    _require_distinct_outputs(onehot, cats)
    # One row per numeric column, and one for the target.
    few = {(r["role"], r["column_name"]): r for r in stats.where("role != 'category'").collect()}
    scalers = []
    for i, c in enumerate(nums, start=len(cats)):
        st = few.get(("number", c))
        mean, std, lo, hi = (st["mean"], st["std"], st["lo"], st["hi"]) if st else (None, None, None, None)
        center, scale = (mean, std) if spec["method"] == "standard" else (lo, None if lo is None else hi - lo)
        scalers.append((i, "scaler", c, f"scaler__{safe_name(c)}", None, None, spec["method"], center, scale))
    params = onehot.select(
        "position", F.lit("onehot").alias("block"), name.alias("source"), "output", "category", "number",
        F.lit(None).cast("string").alias("method"), F.lit(None).cast("double").alias("center"),
        F.lit(None).cast("double").alias("scale"),
    ).unionByName(spark.createDataFrame(scalers, PARAMS_SCHEMA))
    if target is None:
        return params, None
    whole = few.get(("target", target))
    n, mean_y, var_y = (whole["n_y"], whole["mean_y"], whole["var_y"]) if whole else (0, None, None)
    share = F.col("n_y") / F.lit(n)
    r_onehot = F.when((F.col("n_y") > 0) & (F.col("n_y") < F.lit(n)) & (F.lit(var_y).cast("double") > 0),
                      F.sqrt(share / (1 - share)) * (F.col("mean_y") - F.lit(mean_y).cast("double"))
                      / F.sqrt(F.lit(var_y).cast("double")))
    r_scaled = F.when((F.col("var_xb") > 0) & (F.col("var_yb") > 0),
                      F.col("cov") / F.sqrt(F.col("var_xb") * F.col("var_yb")))
    scaled = stats.where("role = 'number'").withColumn(
        "output", F.concat(F.lit("scaler__"), F.create_map(*[F.lit(v) for c in nums for v in (c, safe_name(c))])[name])
        if nums else F.lit(None).cast("string"))
    scores = (onehot.select(F.col("output").alias("feature"), name.alias("source"), F.lit(n).cast("long").alias("n"), r_onehot.alias("r"))
              .unionByName(scaled.select(F.col("output").alias("feature"), name.alias("source"), F.col("n_both").alias("n"),
                                         r_scaled.alias("r"))))
    return params, scores.withColumn("f_score", f_statistic(F.col("r"), F.col("n")))


def _require_distinct_outputs(onehot: DataFrame, cats: Sequence[str]) -> None:
    """Outputs of two columns can only meet where one column's name goes on from the other's and ``_``."""
    close = [c for c in cats if any(o != c and (o.startswith(f"{c}_") or c.startswith(f"{o}_")) for o in cats)]
    if not close:
        return
    met = (onehot.where(F.col("column_name").isin(close)).groupBy("output").count()
           .where("count > 1").agg(F.min("output").alias("output")).first()["output"])
    if met is not None:
        raise ValueError(f"One-hot output name collision: {met}")


def _in_order(params_rows: Sequence) -> list:
    return sorted(params_rows, key=lambda r: (r["position"], r["category"] is None, r["number"] or 0.0, r["category"] or ""))


#: A projection of all outputs has at most so many columns; beyond that :func:`.sparse.sparse_design` takes them.
MAX_COLUMNS = 10_000


def _require_narrow(params: DataFrame) -> None:
    n = params.limit(MAX_COLUMNS + 1).count()
    if n > MAX_COLUMNS:
        raise ValueError(f"The transformer has more than {MAX_COLUMNS} outputs: name the wanted ones, or use sparse_design")


def output_names(params: DataFrame) -> list[str]:
    """M5: output feature names in transformer order (:func:`.sparse.feature_index` for any number of them)."""
    _require_narrow(params)
    return [r["output"] for r in _in_order(params.select("position", "number", "category", "output").collect())]


def output_columns(params_rows: Sequence) -> list:
    """Projection expressions for the fitted outputs, in order."""
    exprs = []
    for r in _in_order(params_rows):
        src = col(r["source"])
        if r["block"] == "onehot":
            same = src.isNull() if r["category"] is None else src.cast("string") == F.lit(r["category"])
            exprs.append(F.when(same, F.lit(1.0)).otherwise(F.lit(0.0)).alias(r["output"]))
        else:
            scale = r["scale"] if r["scale"] not in (None, 0.0) else 1.0
            center = r["center"] if r["center"] is not None else 0.0
            exprs.append(((src.cast("double") - F.lit(center)) / F.lit(scale)).alias(r["output"]))
    return exprs


def apply_transformer(df: DataFrame, params: DataFrame, keep: Sequence[str] = (),
                      outputs: Sequence[str] | None = None) -> DataFrame:
    """M7: one projection from the parameter table; ``keep`` columns (key, target…) pass through.

    ``outputs`` names the wanted output features (default: all, up to ``MAX_COLUMNS``). Only their
    parameters are brought to the driver, one row per column of the result.
    """
    rows = wanted_params(params, outputs)
    missing = sorted({r["source"] for r in rows} - set(df.columns))
    if missing:
        raise KeyError(f"Columns required by the fitted transformer are missing: {missing}")
    return df.select(*[col(k) for k in keep if k in df.columns], *output_columns(rows))


def wanted_params(params: DataFrame, outputs: Sequence[str] | None = None) -> list:
    """The parameter rows of the wanted outputs."""
    if outputs is None:
        _require_narrow(params)
    return (params if outputs is None else params.where(F.col("output").isin(list(outputs)))).collect()
