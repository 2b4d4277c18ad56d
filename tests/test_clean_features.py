"""Cleaning and feature expressions (reference: preprocessing and feature tests, FIXTURES A3/A4)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.config import HOUSING_ENGINEERING
from tessera.operators import clean as C
from tessera.operators.features import difference, engineer, weighted_sum

from .conftest import rows

A3_SCHEMA = "old_name long, category string, numerical double, to_drop string, group_col string, critical long"
A3_ROWS = [(1, "A", 10.5, "x", "G1", 1), (2, "B", None, "y", "G1", 2), (3, None, 30.0, "z", "G2", 3),
           (4, "A", 40.0, "w", "G2", None), (5, "C", 50.0, "v", "G1", 5)]
A3_CFG = {"preprocessing": {
    "rename_columns": {"old_name": "new_name"},
    "drop_columns": ["to_drop"],
    "fillna": {"numerical_zero": ["numerical"], "categorical_none": ["category"]},
    "dropna_rows": ["critical"],
}}


@pytest.fixture()
def a3(spark):
    return spark.createDataFrame(A3_ROWS, A3_SCHEMA)


def test_clean_chain(a3):
    out = C.clean(a3, A3_CFG)
    assert out.count() == 4
    assert "new_name" in out.columns and "old_name" not in out.columns and "to_drop" not in out.columns
    assert out.where(F.col("category") == "None").count() == 1
    assert out.where(F.col("numerical") == 0).count() == 1


def test_empty_config_is_identity(a3):
    out = C.clean(a3, {"preprocessing": {}})
    assert rows(out) == rows(a3)


def test_absent_configured_columns_are_harmless(a3):
    cfg = {"preprocessing": {"rename_columns": {"zzz": "y"}, "drop_columns": ["nope"],
                             "fillna": {"numerical_zero": ["nope"], "categorical_none": ["nope2"]},
                             "dropna_rows": ["nope3"], "fillna_groupby": {"column": "nope", "groupby": "g"}}}
    assert C.clean(a3, cfg).count() == 5


def test_group_mean_imputation(spark):
    df = spark.createDataFrame(
        [(1, "G1", 10.0), (2, "G1", None), (3, "G1", 30.0), (4, "G2", None), (5, None, None), (6, None, 7.0)],
        "k long, g string, x double")
    out = dict((k, x) for k, x in rows(C.impute_group_mean(df, "x", "g"), "k", "x"))
    assert out[2] == 20.0          # own group's mean
    assert out[4] is None          # all-null group stays null
    assert out[5] is None and out[6] == 7.0   # null group key: value kept
    res = dict((k, x) for k, x in rows(C.impute_group_mean(df, "x", "g", residual=0.0), "k", "x"))
    assert res[4] == 0.0 and res[5] == 0.0
    with pytest.raises(ValueError):
        C.impute_group_mean(df, "x", "g", method="median")


def test_rename_case_collision(spark):
    df = spark.createDataFrame([(1, 2)], "SalePrice long, b long")
    with pytest.raises(ValueError):
        C.rename(df, {"b": "saleprice"})


def test_outlier_exclusion_keeps_null_comparisons(spark):
    df = spark.createDataFrame([(1, 5000.0, 100.0), (2, None, 100.0), (3, 100.0, 100.0)], "k long, area double, price double")
    out = C.exclude(df, (F.col("area") > 4000) & (F.col("price") < 400000))
    assert [r[0] for r in rows(out, "k")] == [2, 3]


def test_select_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k long, s string, x double")
    assert C.select_or_default(df, ["x", "missing"], keep=["k"]).first().asDict() == {"k": 1, "x": 2.0, "missing": 0.0}
    with pytest.raises(KeyError):
        C.select_columns(df, ["x", "missing"])
    assert C.by_type(df, "numeric").columns == ["k", "x"]
    assert C.by_type(df, "text").columns == ["s"]
    assert dict(C.as_label(df, ["k"]).dtypes)["k"] == "string"


def test_drop_sparse(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (4, 1)], "k long, s long")
    assert C.drop_sparse(df, 70.0).columns == ["k"]
    assert C.drop_sparse(df, 80.0).columns == ["k", "s"]


A4_COLS = ["1st Flr SF", "2nd Flr SF", "Total Bsmt SF", "Full Bath", "Half Bath", "Bsmt Full Bath",
           "Bsmt Half Bath", "Yr Sold", "Year Built", "Year Remod/Add"]


def _a4(spark, data):
    schema = ", ".join(f"`{c}` long" for c in A4_COLS)
    return spark.createDataFrame(data, schema)


def test_housing_features(spark):
    df = _a4(spark, [(1000, 500, 1000, 2, 1, 1, 0, 2020, 2000, 2005),
                     (1200, 0, 1200, 1, 0, 1, 1, 2021, 1990, 1990),
                     (800, 600, 0, 3, 2, 0, 1, 2019, 2010, 2015)])
    out = engineer(df, HOUSING_ENGINEERING)
    got = [tuple(r) for r in out.select("total_sf", "bathrooms", "house_age", "since_remodel").collect()]
    assert got == [(2500, 3.5, 20, 15), (2400, 2.5, 31, 31), (1400, 4.5, 9, 4)]
    assert out.columns[:len(A4_COLS)] == A4_COLS and len(out.columns) == len(A4_COLS) + 4


def test_features_nulls_negatives_large(spark):
    df = _a4(spark, [(None, 500, 1000, 2, None, 1, 0, 2000, 2010, 2015),
                     (5000, 3000, 2000, 10, 5, 3, 2, 2023, 1900, 2000)])
    got = [tuple(r) for r in engineer(df, HOUSING_ENGINEERING)
           .select("total_sf", "bathrooms", "house_age", "since_remodel").collect()]
    assert got[0] == (None, None, -10, -15)
    assert got[1] == (10000, 16.5, 123, 23)


def test_feature_missing_column_is_error(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    with pytest.raises(KeyError):
        weighted_sum(df, "s", {"a": 1, "c": 1})
    with pytest.raises(KeyError):
        difference(df, "d", "a", "c")


def test_lookup_join_is_the_same_by_broadcast_and_by_shuffle(spark):
    from tessera.operators.joins import join_small
    big = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS g")
    small = spark.createDataFrame([("hot", 1.0)] + [(str(i), float(i)) for i in range(50)], "g string, m double")
    want = rows(big.join(small, "g", "left"), "id", "g", "m")
    assert rows(join_small(big, small, "g"), "id", "g", "m") == want
    assert rows(join_small(big, small, "g", max_rows=10), "id", "g", "m") == want


def test_align_with_awkward_key(spark):
    from tessera.operators.joins import align
    a = spark.createDataFrame([(1, 10.0), (2, 20.0)], "`row.id` long, y double")
    b = spark.createDataFrame([(2, 21.0), (1, 11.0)], "`row.id` long, p double")
    assert rows(align(a, b, "row.id")) == [(1, 10.0, 11.0), (2, 20.0, 21.0)]
    with pytest.raises(ValueError, match="Inconsistent"):
        align(a, b.where("p > 15"), "row.id")
