"""Wide one-hot columns: design, absorbed fit, scoring; one-scan moments."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import sparse as S
from tessera.operators.model import INTERCEPT, fit_linear
from tessera.operators.moments import moments, solve
from tessera.operators.transform import MAX_COLUMNS, apply_transformer, fit_transformer, output_names, wanted_params
from tessera.plans import jobs

from .conftest import rows


def _cfg(drop="first", cats=("g",), nums=("x", "z"), keep=("g",), wide_from=3):
    return {"key": "k", "target": "y", "data_split": {"train": 0.8, "test": 0.2}, "model": {"active": "linear_regression"},
            "selection": {"k": 5, "wide_from": wide_from},
            "features": {"categorical": list(cats), "continuous": list(nums), "most_relevant_features": list(keep)},
            "preprocessing": {"encoding": {"one_hot": {"drop": drop, "handle_unknown": "ignore"}},
                              "scaling": {"method": "standard", "apply_to": ["continuous"]}}}


def _data(n=400, groups=40, nulls=False, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        g = rng.randrange(groups)
        x, z = rng.uniform(-5, 5) + g / 10, rng.uniform(0, 1)
        h = rng.choice("ab")
        y = 3.0 * x - 2.0 * z + 7.0 * g + (5.0 if h == "b" else 0.0) + rng.gauss(0, .5) + 1e6
        out.append((i, None if nulls and i % 17 == 0 else f"g{g:03d}", h, x, z, y))
    return out


SCHEMA = "k long, g string, h string, x double, z double, y double"


def _least_squares(matrix, y):
    """What a library's least squares does: centre, then the solution of least norm."""
    m = matrix - matrix.mean(axis=0)
    beta = np.linalg.lstsq(m, y - y.mean(), rcond=1e-10)[0]
    return beta, y.mean() - matrix.mean(axis=0) @ beta


@pytest.mark.parametrize("drop", ["first", None])
@pytest.mark.parametrize("nulls", [False, True])
def test_absorbed_fit_equals_least_squares_on_all_columns(spark, drop, nulls):
    df = spark.createDataFrame(_data(nulls=nulls), SCHEMA)
    params = fit_transformer(df, _cfg(drop))
    matrix = apply_transformer(df, params, keep=["k", "y", "g"])
    names = output_names(params)
    data = matrix.toPandas()
    beta, intercept = _least_squares(data[names].to_numpy(), data["y"].to_numpy())
    want = dict(zip(names, beta))
    coefs, wide = S.fit_absorbed(matrix, ["scaler__x", "scaler__z"], "g", params, "y")
    got = dict(rows(coefs.select("term", "coefficient"))) | dict(rows(wide.select("output", "coefficient")))
    assert got.pop(INTERCEPT) == pytest.approx(intercept, rel=1e-9)
    assert got.keys() == want.keys() and all(got[n] == pytest.approx(want[n], abs=1e-5) for n in want)


def test_two_categories_closed_form(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", "a", 0.0, 0.0, 10.0 if i % 2 else 25.0) for i in range(10)], SCHEMA)
    params = fit_transformer(df, _cfg(nums=()))
    coefs, wide = S.fit_absorbed(df, [], "g", params, "y")
    assert rows(coefs.select("term", "coefficient")) == [(INTERCEPT, 10.0)]
    assert rows(wide) == [("g", "b", "onehot__g_b", 15.0)]


def test_missing_input_is_an_error(spark):
    df = spark.createDataFrame([(1, "a", "a", None, 0.0, 1.0), (2, "b", "a", 1.0, 0.0, 1.0)], SCHEMA)
    params = fit_transformer(df, _cfg())
    with pytest.raises(ValueError, match="missing"):
        S.fit_absorbed(df, ["x"], "g", params, "y")
    with pytest.raises(ValueError, match="0 sample"):
        S.fit_absorbed(df.limit(0), ["x"], "g", params, "y")


def test_design_holds_what_the_dense_matrix_holds(spark):
    df = spark.createDataFrame(_data(nulls=True) + [(999, "unseen", "b", 1.0, 2.0, 3.0)], SCHEMA)
    params = fit_transformer(df.where("k < 900"), _cfg(cats=("g", "h")))
    index = S.feature_index(params)
    names = [r["output"] for r in sorted(index.collect(), key=lambda r: r["index"])]
    assert names == output_names(params) and [r["index"] for r in index.orderBy("index").collect()] == list(range(len(names)))
    design = S.sparse_design(df, index, keep=["k"])
    dense = {r["k"]: [r[n] for n in names] for r in apply_transformer(df, params, keep=["k"]).collect()}
    for r in design.collect():
        full = [0.0] * len(names)
        assert list(r["indices"]) == sorted(r["indices"])
        for i, v in zip(r["indices"], r["values"]):
            full[i] = v
        assert full == pytest.approx(dense[r["k"]])
    vectors = {r["k"]: r["features"] for r in S.as_vectors(design, len(names)).collect()}
    assert all(list(v.toArray()) == pytest.approx(dense[k]) for k, v in vectors.items())


def test_index_and_lookup_by_shuffle(spark, monkeypatch):
    from tessera.operators import joins
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (0, 0))
    df = spark.createDataFrame(_data(), SCHEMA)
    params = fit_transformer(df, _cfg())
    few = S.feature_index(params, spark.createDataFrame([("onehot__g_g007",), ("scaler__x",), ("onehot__g_g005",)], "feature string"))
    assert [r["output"] for r in few.orderBy("index").collect()] == ["onehot__g_g005", "onehot__g_g007", "scaler__x"]
    assert S.sparse_design(df, few, keep=["k"]).count() == df.count()


def test_training_and_scoring_with_a_wide_kept_column(spark, tmp_path):
    df = spark.createDataFrame(_data(600), SCHEMA)
    narrow, wide = (jobs.train_job(df, _cfg(cats=("g", "h"), wide_from=n)) for n in (1000, 3))
    assert narrow.wide is None and wide.wide.count() == 39 and not any("onehot__g" in f for f in wide.features)
    a, b = (dict(rows(t.predictions.select("k", "prediction"))) for t in (narrow, wide))
    # The narrow run ranks nothing of g; both fit the same columns.
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-4) for k in a)
    jobs.save_training(wide, str(tmp_path / "run"))
    m = jobs.load_training(spark, str(tmp_path / "run"))
    new = spark.createDataFrame([(1000, "never", "a", 0.0, 0.0, None), (1001, None, "a", 0.0, 0.0, None)], SCHEMA)
    preds, dropped = jobs.score_batch(df.unionByName(new).drop("y"), _cfg(), m.params, m.coefficients, m.features,
                                      group_means=m.group_means, wide=m.wide)
    scored = dict(rows(preds, "k", "prediction"))
    assert dropped.count() == 0 and scored[1000] == pytest.approx(scored[1001])
    assert all(scored[k] == pytest.approx(b[k], abs=1e-6) for k in b)


def test_two_wide_columns(spark):
    rng = random.Random(4)
    data = [(i, f"g{rng.randrange(12)}", f"h{rng.randrange(9)}", rng.uniform(-1, 1), 0.0, 0.0) for i in range(500)]
    data = [(k, g, h, x, z, 2 * x + int(g[1:]) - 3 * int(h[1:])) for k, g, h, x, z, _ in data]
    df = spark.createDataFrame(data, SCHEMA)
    t = jobs.train_job(df, _cfg(cats=("g", "h"), nums=("x",), keep=("g", "h"), wide_from=3))
    assert {r["source"] for r in t.wide.select("source").distinct().collect()} == {"g", "h"}
    assert t.predictions.where(F.abs(F.col("prediction") - F.col("y_true")) > 1e-3).count() == 0


def test_all_outputs_of_a_very_wide_transformer_are_refused(spark):
    params = spark.range(MAX_COLUMNS + 1).selectExpr("0 as position", "'onehot' as block", "'g' as source", "cast(id as string) as output",
                                                     "cast(id as string) as category", "cast(null as double) as number")
    for f in (wanted_params, output_names):
        with pytest.raises(ValueError, match="outputs"):
            f(params)
    assert len(wanted_params(params, ["5", "7"])) == 2


def test_moments_are_stable_and_count_bad_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) + [1e8, -1e6, 0]
    data = [tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0), (1.0, float("nan"), 1.0), (1.0, 1.0, float("inf"))]
    m = moments(spark.createDataFrame(data, "a double, b double, c double").repartition(7), ["a", "b", "c"])
    assert (m.rows, m.bad) == (500, 3) and m.mean == pytest.approx(x.mean(axis=0))
    centred = x - x.mean(axis=0)
    assert np.allclose(m.cross, centred.T @ centred, rtol=1e-6, atol=1e-5)
    w = moments(spark.createDataFrame([(1.0, 2.0, 3.0), (5.0, 6.0, 1.0)], "a double, b double, w double"), ["a", "b"], weight="w")
    assert w.weight == 4 and list(w.mean) == [2.0, 3.0] and w.cross[0, 1] == pytest.approx(12.0)


def test_repeated_and_constant_columns_get_least_norm(spark):
    df = spark.createDataFrame([(float(i), float(i), 5.0, 4.0 * i + 1) for i in range(20)], "a double, b double, c double, y double")
    got = dict(rows(fit_linear(df, ["a", "b", "c"], "y").select("term", "coefficient")))
    assert got["a"] == pytest.approx(2.0) and got["b"] == pytest.approx(2.0) and got["c"] == pytest.approx(0.0) and got[INTERCEPT] == pytest.approx(1.0)
    assert solve(np.zeros((1, 1))).shape == (0,)
    with pytest.raises(ValueError, match="0 sample"):
        fit_linear(df.limit(0), ["a"], "y")


def test_a_null_of_the_training_rows_is_the_last_category(spark):
    cfg = _cfg(cats=("g", "c"), nums=("x",), keep=("g",))
    cfg["preprocessing"]["encoding"]["one_hot"]["null_category"] = True
    data = [(i, None if i % 5 == 0 else "abc"[i % 3], [None, 10, 9][i % 3], float(i % 7), 2.0 * (i % 7) + [5, 1, 2, 3][3 if i % 5 == 0 else i % 3]) for i in range(200)]
    df = spark.createDataFrame(data, "k long, g string, c int, x double, y double")
    params = fit_transformer(df, cfg)
    assert output_names(params) == ["onehot__g_b", "onehot__g_c", "onehot__g_%null", "onehot__c_10", "onehot__c_%null", "scaler__x"]
    assert [r["output"] for r in S.feature_index(params).orderBy("index").collect()] == output_names(params)
    dense = apply_transformer(df, params, keep=["k", "y", "g"])
    assert dense.agg(F.sum("`onehot__g_%null`"), F.sum("`onehot__c_%null`")).first()[:] == (40.0, 67.0)
    index = S.feature_index(params)
    for r in S.sparse_design(df, index, keep=["k"]).where("k < 30").collect():
        full = [0.0] * 6
        for i, v in zip(r["indices"], r["values"]):
            full[i] = v
        row = dense.where(F.col("k") == r["k"]).first()
        assert full == pytest.approx([row[n] for n in output_names(params)])
    coefs, wide = S.fit_absorbed(dense, ["scaler__x"], "g", params, "y")
    names = ["onehot__g_b", "onehot__g_c", "onehot__g_%null", "scaler__x"]
    pdf = dense.toPandas()
    beta, intercept = _least_squares(pdf[names].to_numpy(), pdf["y"].to_numpy())
    got = dict(rows(coefs.select("term", "coefficient"))) | dict(rows(wide.select("output", "coefficient")))
    assert got.pop(INTERCEPT) == pytest.approx(intercept) and got == pytest.approx(dict(zip(names, beta)))
    from tessera.operators.model import predict
    preds = S.add_wide(predict(dense, coefs, keep=["k", "y", "g"]), wide)
    expect = pdf[names].to_numpy() @ beta + intercept
    assert [r["prediction"] for r in preds.orderBy("k").collect()] == pytest.approx(list(expect))
    only = spark.createDataFrame([(1, None, 1, 1.0, 1.0)], "k long, g string, c int, x double, y double")
    assert output_names(fit_transformer(only, cfg)) == ["scaler__x"]  # the only category of each is the first one
