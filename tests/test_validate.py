"""Validation (reference: validation tests, FIXTURES A2)."""

from __future__ import annotations

import pytest

from tessera.operators import validate as V

from .conftest import rows


def _report(spark, data, schema, declared, action="warn"):
    df = spark.createDataFrame(data, schema)
    rep = V.validate(df, declared, action=action)
    return rep, V.report_summary(rep).first()


def test_valid_frame_passes(spark):
    _, s = _report(spark, [(1, "a", 1.0, True)], "id long, name string, score double, active boolean",
                   [{"name": "id", "dtype": "int", "required": True},
                    {"name": "name", "dtype": "str", "required": True},
                    {"name": "score", "dtype": "float", "required": True},
                    {"name": "active", "dtype": "bool"}])
    assert (s["status"], s["error_count"]) == ("pass", 0)


def test_missing_required_raises(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    with pytest.raises(ValueError, match="1 error"):
        V.validate(df, [{"name": "email", "dtype": "str", "required": True}], action="raise")


def test_missing_optional_and_default_not_required(spark):
    _, s = _report(spark, [(1, "a")], "id long, name string",
                   [{"name": "phone", "dtype": "str", "required": False}, {"name": "optional_col", "dtype": "int"}])
    assert s["status"] == "pass"


@pytest.mark.parametrize("schema,declared", [
    ("id string, name string", [{"name": "id", "dtype": "int"}]),
    ("id long, score string", [{"name": "score", "dtype": "float"}]),
    ("id long, name long", [{"name": "name", "dtype": "str"}]),
])
def test_wrong_types(spark, schema, declared):
    df = spark.createDataFrame([], schema)
    with pytest.raises(ValueError, match="1 error"):
        V.validate(df, declared, action="raise")


def test_three_errors_and_messages(spark):
    rep, s = _report(spark, [("x", "y")], "id string, score string",
                     [{"name": "id", "dtype": "int"}, {"name": "name", "dtype": "str", "required": True},
                      {"name": "score", "dtype": "float"}])
    assert s["error_count"] == 3
    msgs = {r["message"] for r in rep.collect() if r["status"] == "fail"}
    assert "Missing required column: name" in msgs
    assert "Column 'id' expected int but found string" in msgs


def test_warn_returns_and_other_action_is_silent(spark):
    df = spark.createDataFrame([("1",)], "id string")
    for action in ("warn", "ignore"):
        rep = V.validate(df, [{"name": "id", "dtype": "int"}], action=action)
        assert V.report_summary(rep).first()["status"] == "fail"


def test_no_columns(spark):
    df = spark.range(0).drop("id")
    with pytest.raises(ValueError):
        V.validate(df, [{"name": "id", "dtype": "int", "required": True}], action="raise")


def test_report_written_before_raise(spark, tmp_path):
    df = spark.createDataFrame([("1",)], "id string")
    path = str(tmp_path / "report")
    with pytest.raises(ValueError):
        V.validate(df, [{"name": "id", "dtype": "int"}], action="raise", report_path=path)
    assert spark.read.json(path).count() == 1


def test_nulls_in_int_and_mixed_text(spark):
    df = spark.createDataFrame([(1, "1"), (None, "x"), (3, "2.5")], "id long, mixed_col string")
    conf = {r["column_name"]: r for r in V.value_conformance(
        df, [{"name": "id", "dtype": "int"}, {"name": "mixed_col", "dtype": "int"}]).collect()}
    assert conf["id"]["n_null"] == 1 and conf["id"]["n_nonconforming"] == 0
    assert conf["mixed_col"]["n_nonconforming"] == 2


def test_finite_checks(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (float("inf"), 0.0)], "a double, b double")
    with pytest.raises(ValueError, match="NaN"):
        V.require_finite(df, ["a", "b"])
    assert V.finite_only(df, ["a", "b"]).count() == 1
    with pytest.raises(ValueError, match="0 sample"):
        V.require_finite(df.limit(0), ["a"])
    assert dict(rows(V.finite_counts(df, ["a", "b"]), "column_name", "n_not_finite")) == {"a": 2, "b": 0}


def test_empty_check(spark):
    assert V.require_non_empty(spark.range(1)) is True
    assert V.require_non_empty(spark.range(0)) is False
    with pytest.raises(ValueError):
        V.require_non_empty(spark.range(0), raise_error=True)
