"""One-hot columns with any number of categories.

A kept source column may have millions of categories. None of them becomes a DataFrame column
and none is brought to the driver:

* :func:`feature_index` numbers the wanted outputs in transformer order, in Spark.
* :func:`sparse_design` gives every row its ``(indices, values)`` by one lookup join per
  categorical column; :func:`as_vectors` reads them as Spark ML vectors.
* :func:`fit_absorbed` is ordinary least squares with one such column. In the normal equations its
  block is diagonal, so the other coefficients follow from sums within its categories,
  and each category's coefficient from that category's means: a grouped aggregate and one small solve.
* :func:`fit_sparse` fits any design with Spark ML (for several wide columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..functions.columns import col
from ..session import materialize, scratch_path
from .joins import join_small
from .model import COEF_SCHEMA, INTERCEPT
from .moments import moments, solve

#: A kept source with more one-hot outputs than this is fitted and scored by lookup.
WIDE_FROM = 1000


def wide_sources(params: DataFrame, keep: Sequence[str], wide_from: int = WIDE_FROM) -> list[str]:
    """Kept source columns with more than ``wide_from`` one-hot outputs (at most one row per kept column)."""
    counted = (params.where((F.col("block") == "onehot") & F.col("source").isin(list(keep)))
               .groupBy("source").count().where(F.col("count") > wide_from))
    return sorted(r["source"] for r in counted.collect())


def _category_key(category: Column) -> Column:
    """A join key that tells null from every text (a null category is a category)."""
    return F.coalesce(F.concat(F.lit("="), category.cast("string")), F.lit("null"))


def dense_index(df: DataFrame, order: Sequence[Column], name: str = "index") -> DataFrame:
    """Adds the place of each row in the given order, from 0, without a one-task sort.

    Rows are dealt out by range; each range is numbered by itself and moved on by the sizes of
    the ranges before it (one count per range reaches the driver).
    """
    order = list(order)
    dealt = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name="index")
    before, offsets = 0, []
    for r in sorted(dealt.groupBy("_range").count().collect(), key=lambda r: r["_range"]):
        offsets.append((r["_range"], before))
        before += r["count"]
    starts = df.sparkSession.createDataFrame(offsets, "_range int, _start long")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (dealt.withColumn("_place", place).join(F.broadcast(starts), "_range")
            .withColumn(name, (F.col("_place") + F.col("_start")).cast("long")).drop("_range", "_place", "_start"))


def feature_index(params: DataFrame, outputs: DataFrame | None = None) -> DataFrame:
    """The parameter rows with ``index``: their place in transformer order.

    ``outputs`` (a frame with ``feature``) restricts them; a join, so it may be as long as the parameters.
    """
    if outputs is not None:
        params = params.join(outputs.select(F.col("feature").alias("output")).distinct(), "output", "left_semi")
    return dense_index(params, [F.asc("position"), F.asc_nulls_last("number"), F.asc_nulls_last("category")])


def sparse_design(df: DataFrame, index: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and each row's ``indices`` (ascending) and ``values``.

    A category outside the index, or a null, has no entry. Scaled numbers always have one; a
    null number stays null. Categories are looked up by one join per column: broadcast below a
    checked size, else shuffled.
    """
    # One row per numeric column, one name per categorical column.
    scalers = index.where("block = 'scaler'").collect()
    sources = sorted(r["source"] for r in index.where("block = 'onehot'").select("source").distinct().collect())
    absent = sorted(({r["source"] for r in scalers} | set(sources)) - set(df.columns))
    if absent:
        raise KeyError(f"Columns required by the fitted transformer are missing: {absent}")
    out = df.select(*[col(k).alias(f"_keep{i}") for i, k in enumerate(keep)],
                    *[_category_key(col(s)).alias(f"_cat{i}") for i, s in enumerate(sources)],
                    *[col(r["source"]).cast("double").alias(f"_num{i}") for i, r in enumerate(scalers)])
    for i, s in enumerate(sources):
        lookup = materialize(index.where((F.col("block") == "onehot") & (F.col("source") == s))
                             .select(_category_key(F.col("category")).alias(f"_cat{i}"), F.col("index").alias(f"_at{i}")), name="lookup")
        out = join_small(out, lookup, f"_cat{i}")
    entry = lambda at, value: F.struct(at.cast("long").alias("at"), value.cast("double").alias("value"))
    entries = [F.when(F.col(f"_at{i}").isNotNull(), entry(F.col(f"_at{i}"), F.lit(1.0))) for i in range(len(sources))]
    for i, r in enumerate(scalers):
        scale = r["scale"] if r["scale"] not in (None, 0.0) else 1.0
        entries.append(entry(F.lit(r["index"]), (F.col(f"_num{i}") - F.lit(r["center"] or 0.0)) / F.lit(scale)))
    listed = F.sort_array(F.array_compact(F.array(*entries))) if entries else F.array().cast("array<struct<at:bigint,value:double>>")
    return out.withColumn("_e", listed).select(*[F.col(f"_keep{i}").alias(k) for i, k in enumerate(keep)],
                                               F.col("_e.at").alias("indices"), F.col("_e.value").alias("values"))


def as_vectors(design: DataFrame, size: int, out: str = "features") -> DataFrame:
    """The design with one Spark ML sparse vector column; written once (the fit reads it many times).

    A vector is stored as a struct, so the written struct is read back as a vector by its schema:
    no Python touches the rows.
    """
    others = [c for c in design.columns if c not in ("indices", "values")]
    whole = F.when(F.exists("values", lambda v: v.isNull()), F.raise_error(F.lit("A model input is missing")).cast("array<double>")).otherwise(F.col("values"))
    packed = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.col("indices").cast("array<int>").alias("indices"), whole.alias("values"))
    path = scratch_path(design.sparkSession, "vectors")
    design.select(*[col(c) for c in others], packed.alias(out)).write.parquet(path)
    schema = T.StructType([design.schema[c] for c in others] + [T.StructField(out, VectorUDT())])
    return design.sparkSession.read.schema(schema).parquet(path)


def fit_sparse(design: DataFrame, index: DataFrame, target: str) -> DataFrame:
    """M13 on a sparse design: (index, output, coefficient) and the intercept row (index null).

    Spark ML's iterations hold one vector of the design's width on the driver. For one wide
    column use :func:`fit_absorbed`, which holds none.
    """
    size = index.count()
    model = LinearRegression(featuresCol="features", labelCol=target, regParam=0.0, fitIntercept=True, maxIter=500, tol=1e-12,
                             solver="l-bfgs").fit(as_vectors(design, size))
    spark = design.sparkSession
    found = spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.coefficients.toArray())], "index long, coefficient double")
    rows = index.select("index", "output").join(found, "index")
    return rows.unionByName(spark.createDataFrame([(None, INTERCEPT, float(model.intercept))], rows.schema))


def fit_absorbed(train: DataFrame, features: Sequence[str], wide: str, params: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """M13 with one wide one-hot column: ``(coefficients, wide coefficients)``.

    ``features`` are the other model inputs (columns of ``train``), ``wide`` the source column,
    ``params`` the fitted transformer. Gives what ordinary least squares on all columns gives:

    * a category that the encoder dropped, and a null that has no category, count as the one without a column: its
      mean is the intercept;
    * with a column for every row's category, the columns add up to the constant; the
      solution of least norm is taken (coefficients of the categories add up to 0).

    Rows with a missing input or target are an error. The wide coefficients are
    ``(source, category, output, coefficient)``, one row per category with a column.
    """
    features = list(features)
    known = materialize(params.where((F.col("block") == "onehot") & (F.col("source") == wide))
                        .select("category", "output", _category_key(F.col("category")).alias("_key")), name="wide")
    names = [f"_x{i}" for i in range(len(features))]
    slim = train.select(_category_key(col(wide)).alias("_key"), *[col(f).cast("double").alias(n) for f, n in zip(features, names)],
                        col(target).cast("double").alias("_y"))
    slim = materialize(join_small(slim, known.select("_key", "output"), "_key").select("output", *names, "_y"), name="absorb")
    every = [*names, "_y"]
    total = moments(slim, every)
    if total.bad:
        raise ValueError(f"Input contains NaN, infinity or a missing value ({total.bad} row(s))")
    if not total.rows:
        raise ValueError("Found array with 0 sample(s)")
    groups = materialize(slim.groupBy("output").agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in every]), name="groups")
    between = moments(groups, every, weight="n")
    beta = solve(total.cross - between.cross) if features else []
    level = F.col("_y")
    for n, b in zip(names, beta):
        level = level - F.lit(float(b)) * F.col(n)
    levels = materialize(groups.select("output", level.alias("level")), name="levels")
    # The group without a column, if there is one, else the plain mean over the categories: one row.
    base = levels.agg(F.max(F.when(F.col("output").isNull(), F.col("level"))).alias("without"), F.avg("level").alias("mean")).first()
    intercept = base["without"] if base["without"] is not None else base["mean"]
    spark = train.sparkSession
    rows = [(i, f, float(b)) for i, (f, b) in enumerate(zip(features, beta))] + [(len(features), INTERCEPT, float(intercept))]
    coefficients = spark.createDataFrame(rows, COEF_SCHEMA)
    found = (known.join(levels, "output")
             .select(F.lit(wide).alias("source"), "category", "output", (F.col("level") - F.lit(float(intercept))).alias("coefficient")))
    return coefficients, materialize(found, name="wide-coefficients")


def add_wide(df: DataFrame, wide: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Adds the wide columns' coefficients to a prediction; ``df`` still holds the source columns.

    A category without a coefficient, and a null, add nothing (as an all-zero encoding does).
    """
    names = df.columns
    for source in sorted(r["source"] for r in wide.select("source").distinct().collect()):  # one per wide column
        lookup = wide.where(F.col("source") == source).select(_category_key(F.col("category")).alias("_key"), F.col("coefficient").alias("_more"))
        df = join_small(df.withColumn("_key", _category_key(col(source))), lookup, "_key")
        df = df.withColumn(prediction, col(prediction) + F.coalesce("_more", F.lit(0.0))).select(*[col(n) for n in names])
    return df
