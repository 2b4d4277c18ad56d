"""Configuration rules and declared schemas (reference config facts, FIXTURES A8/A9)."""

from __future__ import annotations

from tessera.config import (HOUSING_FLOAT_COLUMNS, HOUSING_INT_COLUMNS, HOUSING_STR_COLUMNS, housing_config,
                            housing_record_contract)
from tessera.functions.columns import snake_name
from tessera.operators.validate import schema_checks
from tessera.sources.readers import declared_schema


def test_rename_rule_matches_configured_names():
    assert snake_name("Year Remod/Add") == "year_remod_add"
    assert snake_name("BsmtFin SF 1") == "bsmtfin_sf_1"
    assert snake_name("3Ssn Porch") == "3ssn_porch"
    cfg = housing_config()
    rename = cfg["preprocessing"]["rename_columns"]
    assert rename["TotRms AbvGrd"] == "totrms_abvgr"          # the name the feature lists use
    targets = set(rename.values())
    feats = cfg["features"]
    for role in ("continuous", "categorical", "ordinal"):
        assert set(feats[role]) <= targets, role


def test_declared_schema_counts():
    assert (len(HOUSING_INT_COLUMNS), len(HOUSING_FLOAT_COLUMNS), len(HOUSING_STR_COLUMNS)) == (27, 11, 43)
    declared = housing_config()["data_validation"]["schema"]["columns"]
    schema = declared_schema(declared)
    kinds = [f.dataType.simpleString() for f in schema.fields]
    assert (kinds.count("bigint"), kinds.count("double"), kinds.count("string")) == (27, 11, 43)


def test_record_contract_shape():
    contract = housing_record_contract()
    names = [c["name"] for c in contract]
    assert len(names) == len(set(names)) == 71
    assert "PID" not in names and "SalePrice" not in names
    req = {c["name"]: c["dtype"] for c in contract if c["required"]}
    assert req["Gr Liv Area"] == "float" and req["Overall Qual"] == "int" and req["Kitchen Qual"] == "str"


def test_bool_is_checked_for_real(spark):
    df = spark.createDataFrame([(1, "yes")], "id long, flag string")
    rows = schema_checks(df, [{"name": "flag", "dtype": "bool"}, {"name": "id", "dtype": "int"}])
    status = {r[0]: r[2] for r in rows}
    assert status == {"flag": "fail", "id": "pass"}
