"""Transformers, selection, split, OLS and metrics (reference: model / evaluation tests, FIXTURES A5/A6/A10)."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import transform as M
from tessera.operators.metrics import regression_metrics
from tessera.operators.model import fit_linear, fit_simple, predict
from tessera.operators.select import f_scores, select_k
from tessera.operators.split import split

from .conftest import rows


def _cfg(cat=("c",), cont=("x",), ordinal=(), method="standard", drop="first", onehot=True):
    return {"features": {"categorical": list(cat), "continuous": list(cont), "ordinal": list(ordinal)},
            "preprocessing": {"encoding": {"one_hot": {"drop": drop, "handle_unknown": "ignore"}} if onehot else {},
                              "scaling": {"method": method, "apply_to": ["continuous", "ordinal"]}}}


def test_onehot_drop_first_unseen_and_null(spark):
    train = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "k long, c string, x double")
    params = M.fit_transformer(train, _cfg())
    assert M.output_names(params) == ["onehot__c_b", "onehot__c_c", "scaler__x"]
    test = spark.createDataFrame([(4, "a", 1.0), (5, "b", 1.0), (6, "c", 1.0), (7, "zzz", 1.0), (8, None, None)],
                                 "k long, c string, x double")
    out = {r[0]: tuple(r[1:3]) for r in rows(M.apply_transformer(test, params, keep=["k"]), "k", "onehot__c_b", "onehot__c_c")}
    assert out == {4: (0.0, 0.0), 5: (1.0, 0.0), 6: (0.0, 1.0), 7: (0.0, 0.0), 8: (0.0, 0.0)}


def test_standard_scale_uses_population_std_and_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0), (5, None)], "k long, x double")
    params = M.fit_transformer(df, _cfg(cat=(), onehot=False))
    got = dict(rows(M.apply_transformer(df, params, keep=["k"]), "k", "scaler__x"))
    sd = np.std([1, 2, 3, 4])   # ddof 0
    assert got[1] == pytest.approx((1 - 2.5) / sd) and got[5] is None


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k long, x double")
    for method in ("standard", "minmax"):
        params = M.fit_transformer(df, _cfg(cat=(), onehot=False, method=method))
        assert [r[1] for r in rows(M.apply_transformer(df, params, keep=["k"]), "k", "scaler__x")] == [0.0, 0.0]


def test_minmax_switch_and_unknown_method(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0)], "k long, x double")
    params = M.fit_transformer(df, _cfg(cat=(), onehot=False, method="minmax"))
    assert [r[1] for r in rows(M.apply_transformer(df, params, keep=["k"]), "k", "scaler__x")] == [0.0, 0.5, 1.0]
    with pytest.raises(ValueError):
        M.fit_transformer(df, _cfg(cat=(), onehot=False, method="robust"))


def test_fit_on_train_only(spark):
    df = spark.createDataFrame([(1, "a", 0.0, "train"), (2, "b", 2.0, "train"), (3, "z", 100.0, "test")],
                               "k long, c string, x double, split string")
    params = M.fit_transformer(df.where(F.col("split") == "train"), _cfg())
    scaler = [r for r in params.collect() if r["block"] == "scaler"][0]
    assert (scaler["center"], scaler["scale"]) == (1.0, 1.0)
    assert [r["category"] for r in params.collect() if r["block"] == "onehot"] == ["b"]


def test_any_number_of_categories(spark):
    n = 5000   # ids 0 … 4999 as categories of ten rows each; the target is high in category 17 alone
    df = spark.range(10 * n).select(F.col("id"), (F.col("id") % n).alias("c"), (F.col("id") % 7).cast("double").alias("x"),
                                    F.when(F.col("id") % n == 17, 100.0).otherwise(F.col("id") % 3).alias("y"))
    params, scores = M.fit_scored(df, _cfg(), "y")
    names = M.output_names(params)
    assert names == [f"onehot__c_{i}" for i in range(1, n)] + ["scaler__x"]
    assert [r[1] for r in rows(select_k(scores, 1), "position", "feature")] == ["onehot__c_17"]
    one = M.apply_transformer(df, params, keep=["id"], outputs=["onehot__c_17"])
    assert one.columns == ["id", "onehot__c_17"] and one.agg(F.sum("onehot__c_17")).first()[0] == 10.0


def test_scores_of_the_fit_equal_scores_of_the_matrix(spark):
    rng = np.random.default_rng(3)
    data = [(None if i % 11 == 0 else "abcd"[i % 4], None if i % 13 == 0 else i % 3, None if i % 7 == 0 else float(rng.normal()),
             5.0, None if i % 17 == 0 else float(rng.normal() + i % 4)) for i in range(400)]
    df = spark.createDataFrame(data, "c string, d int, x double, const double, y double")
    for drop in ("first", None):
        cfg = _cfg(cat=("c", "d"), cont=("x", "const"), drop=drop)
        params, scores = M.fit_scored(df, cfg, "y")
        want = {r["feature"]: r for r in f_scores(M.apply_transformer(df, params, keep=["y"]), M.output_names(params), "y").collect()}
        got = {r["feature"]: r for r in scores.collect()}
        assert set(got) == set(want) == set(M.output_names(params)) and M.output_names(params)[-2:] == ["scaler__x", "scaler__const"]
        for name, r in got.items():
            assert r["n"] == want[name]["n"], name
            assert (r["f_score"] is None) == (want[name]["f_score"] is None)
            if r["f_score"] is not None:
                assert r["f_score"] == pytest.approx(want[name]["f_score"], rel=1e-9) and r["r"] == pytest.approx(want[name]["r"], rel=1e-9)


def test_outputs_of_two_columns_that_would_meet(spark):
    df = spark.createDataFrame([("b_c", "c", 1.0), ("z", "d", 2.0)], "a string, a_b string, x double")
    with pytest.raises(ValueError, match="collision"):
        M.fit_transformer(df, _cfg(cat=("a", "a_b"), drop=None))


def test_f_scores_match_formula_and_constant_is_last(spark):
    rng = np.random.default_rng(0)
    x1 = rng.normal(size=400)
    y = 3 * x1 + rng.normal(size=400)
    x2 = rng.normal(size=400)
    data = [(float(a), float(b), 1.0, float(c)) for a, b, c in zip(x1, x2, y)]
    df = spark.createDataFrame(data, "x1 double, x2 double, const double, y double")
    sc = {r["feature"]: r for r in f_scores(df, ["x1", "x2", "const"], "y").collect()}
    r = np.corrcoef(x1, y)[0, 1]
    assert sc["x1"]["f_score"] == pytest.approx(r * r / (1 - r * r) * 398, rel=1e-9)
    assert sc["const"]["f_score"] is None
    sel = [r[1] for r in rows(select_k(f_scores(df, ["x1", "x2", "const"], "y"), 2), "position", "feature")]
    assert sel == ["x1", "x2"]


def test_always_keep_matches_source_column(spark):
    train = spark.createDataFrame([(1, "a", 1.0, 1.0), (2, "b", 2.0, 2.5), (3, "c", 3.0, 2.0), (4, "a", 4.0, 4.5)],
                                  "k long, c string, x double, y double")
    params = M.fit_transformer(train, _cfg())
    mat = M.apply_transformer(train, params, keep=["y"])
    chosen = [r[1] for r in rows(select_k(f_scores(mat, M.output_names(params), "y"), 1, keep=["c"], params=params),
                                 "position", "feature")]
    assert chosen == ["scaler__x", "onehot__c_b", "onehot__c_c"]


def test_split_fractions_and_partition_independence(spark):
    df = spark.range(15000).withColumnRenamed("id", "k")
    counts = dict(rows(split(df, "k", buckets=1000, method="arith").groupBy("split").count()))
    assert counts == {"test": 3000, "train": 9000, "valid": 3000}
    a = rows(split(df.repartition(1), "k"), "k", "split")
    b = rows(split(df.repartition(7), "k"), "k", "split")
    assert a == b
    with pytest.raises(ValueError):
        split(df, "k", {"train": 0.5, "test": 0.4})


def test_ols_exact_and_collinear(spark):
    data = [(float(i), float(2 * i), float(i % 3), float(10 + 3 * i + 2 * (i % 3))) for i in range(20)]
    df = spark.createDataFrame(data, "a double, b double, c double, y double")
    coefs = fit_linear(df, ["a", "c"], "y")
    got = {r["term"]: r["coefficient"] for r in coefs.collect()}
    assert got["a"] == pytest.approx(3.0, abs=1e-6) and got["c"] == pytest.approx(2.0, abs=1e-6)
    assert got["__intercept__"] == pytest.approx(10.0, abs=1e-6)
    # a and b are collinear: coefficients are not unique, predictions are.
    preds = predict(df, fit_linear(df, ["a", "b", "c"], "y"))
    assert all(abs(r["prediction"] - r["y"]) < 1e-4 for r in preds.collect())
    simple = fit_simple(df, "a", "y").first()
    assert simple["n"] == 20
    with pytest.raises(ValueError, match="Unsupported model type"):
        fit_linear(df, ["a"], "y", kind="unsupported_model")


def _metrics(spark, yt, yp):
    df = spark.createDataFrame(list(zip(range(len(yt)), map(float, yt), map(float, yp))),
                               "k long, y double, p double")
    return regression_metrics(df, "y", "p").first()


def test_metrics_reference_values(spark):
    m = _metrics(spark, [1, 2, 3, 4, 5], [1, 2, 3, 4, 5])
    assert (m["mse"], m["rmse"], m["mae"], m["r2"]) == (0.0, 0.0, 0.0, 1.0)
    m = _metrics(spark, [1, 2, 3], [1.5, 2.5, 3.5])
    assert (m["mse"], m["rmse"], m["mae"]) == (0.25, 0.5, 0.5) and m["r2"] == pytest.approx(0.625)
    m = _metrics(spark, [5], [4])
    assert (m["mse"], m["mae"]) == (1.0, 1.0) and math.isnan(m["r2"])
    m = _metrics(spark, [0, 0, 0, 0], [0, 0, 0, 0])
    assert m["r2"] == 1.0
    assert _metrics(spark, [1, 1, 1], [1, 2, 1])["r2"] == 0.0
    assert _metrics(spark, [1, 2, 3, 4, 5], [10, -5, 15, -10, 20])["r2"] < 0
    m = _metrics(spark, [1e6, 2e6, 3e6, 4e6, 5e6], [1.1e6, 2.1e6, 3.1e6, 4.1e6, 5.1e6])
    assert m["mae"] == pytest.approx(1e5) and math.isfinite(m["r2"])
    m = _metrics(spark, [1e-6, 2e-6, 3e-6], [1.1e-6, 2.1e-6, 3.1e-6])
    assert m["mae"] == pytest.approx(1e-7)


def test_metrics_scale_invariance_and_sklearn_relation(spark):
    base = [1, 2, 3, 4, 5]
    r2s = []
    for s in (1, 10, 100, 1000):
        m = _metrics(spark, [b * s for b in base], [1.1 * b * s for b in base])
        r2s.append(m["r2"])
        assert m["rmse"] ** 2 == pytest.approx(m["mse"])
    assert max(r2s) - min(r2s) < 1e-9


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
def test_metrics_reject_non_finite(spark, bad):
    with pytest.raises(Exception, match="NaN, infinity"):
        _metrics(spark, [1, 2, bad], [1, 2, 3])


def test_metrics_reject_empty(spark):
    df = spark.createDataFrame([], "y double, p double")
    with pytest.raises(Exception, match="0 sample"):
        regression_metrics(df, "y", "p").collect()
