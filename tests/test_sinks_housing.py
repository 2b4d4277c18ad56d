"""Sinks, the data stage, and the reference's own housing configuration end to end (FIXTURES A9)."""

from __future__ import annotations

import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.config import (HOUSING_FLOAT_COLUMNS, HOUSING_INT_COLUMNS, HOUSING_STR_COLUMNS, ORDER_FEATURES,
                            housing_config, housing_record_contract)
from tessera.operators import profile as P
from tessera.operators.metrics import evaluate_saved
from tessera.operators.validate import validate
from tessera.plans import jobs
from tessera.plans.views import order_features
from tessera.sources import readers as R
from tessera.sources import sinks as K
from tessera.streaming.scoring import score_stream

from .conftest import SF_SMALL, rows


def test_save_training_and_reevaluate(spark, tmp_path):
    of = order_features(spark, SF_SMALL)
    t = jobs.train_job(of, copy.deepcopy(ORDER_FEATURES))
    out = str(tmp_path / "art")
    jobs.save_training(t, out)
    preds = R.read_predictions(spark, f"{out}/predictions")
    assert preds.where(F.col("split") == "test").count() == t.predictions.where(F.col("split") == "test").count()
    again = {r["split"]: r for r in evaluate_saved(preds.where(F.col("split") != "train"), by="split").collect()}
    first = {r["split"]: r for r in t.metrics.collect()}
    for s in first:
        assert again[s]["mse"] == pytest.approx(first[s]["mse"])
    params = spark.read.parquet(f"{out}/transformer")
    assert params.count() == t.params.count()
    long = spark.read.json(f"{out}/metrics")
    assert sorted(long.columns) == ["metric", "split", "value"] and long.count() == 8
    # The full table is absent, so it is rebuilt from the split folders.
    split_paths = {s: f"{out}/predictions/split={s}" for s in ("train", "valid", "test")}
    rebuilt = R.read_or_rebuild(spark, f"{out}/no_full_table", split_paths)
    assert rebuilt.count() == t.predictions.count()
    with pytest.raises(ValueError, match="No rows left"):
        jobs.score_batch(of.where("last_ship_year IS NULL"), copy.deepcopy(ORDER_FEATURES), t.params,
                         t.coefficients, t.features, require_rows=True, group_means=t.group_means)
    with pytest.raises(FileNotFoundError):
        R.read_predictions(spark, str(tmp_path / "missing"))


def test_csv_sample_and_schema_sinks(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    K.write_csv(orders.select("o_orderkey", "o_totalprice"), str(tmp_path / "csv"))
    back = R.read_table(spark, str(tmp_path / "csv"), fmt="csv")
    assert back.count() == orders.count()
    K.write_sample(orders, str(tmp_path / "sample"), "o_orderkey", n=50)
    keys = [r[0] for r in rows(spark.read.parquet(str(tmp_path / "sample")), "o_orderkey")]
    assert keys == [r[0] for r in rows(orders.select("o_orderkey"))][:50]
    K.write_json(P.column_info(orders), str(tmp_path / "schema"))
    assert spark.read.json(str(tmp_path / "schema")).count() == len(orders.columns)


def test_data_stage_publishes_versions(spark, tmp_path):
    cfg = copy.deepcopy(ORDER_FEATURES)
    of = order_features(spark, SF_SMALL)
    res = jobs.data_stage(spark, cfg, df=of, out_root=str(tmp_path / "store"))
    assert res["version"] == 1
    assert res["shape"].first()["n_rows"] == of.count()
    assert R.latest(spark, str(tmp_path / "store"), "raw").count() == of.count()
    # A publish that died before its manifest row doesn't block the next one.
    of.limit(1).write.parquet(str(tmp_path / "store" / "raw" / "version=2"))
    assert K.publish(of, str(tmp_path / "store"), "raw") == 2
    assert R.latest(spark, str(tmp_path / "store"), "raw").count() == of.count()
    assert R.latest(spark, str(tmp_path / "store"), "raw", version=1).count() == of.count()


def _housing_rows(n: int, seed: int = 7):
    rnd = random.Random(seed)
    vocab = ["A", "B", "C", "Gd", "TA"]
    out = []
    for i in range(n):
        row = {}
        for c in HOUSING_INT_COLUMNS:
            row[c] = rnd.randint(0, 3000)
        row["PID"] = 100000 + i
        row["Year Built"] = rnd.randint(1900, 2005)
        row["Year Remod/Add"] = row["Year Built"] + rnd.randint(0, 5)
        row["Yr Sold"] = 2006 + rnd.randint(0, 4)
        for c in HOUSING_FLOAT_COLUMNS:
            row[c] = None if rnd.random() < 0.05 else float(rnd.randint(0, 2000))
        row["Garage Cars"] = float(rnd.randint(0, 3))
        for c in HOUSING_STR_COLUMNS:
            row[c] = None if rnd.random() < 0.05 else rnd.choice(vocab)
        row["Electrical"] = rnd.choice(vocab)
        row["Overall Qual"] = rnd.randint(1, 10)
        row["SalePrice"] = int(20000 * row["Overall Qual"] + 50 * row["Gr Liv Area"] + rnd.randint(0, 5000))
        out.append(row)
    return out


def test_housing_config_end_to_end(spark, tmp_path):
    cfg = housing_config()
    declared = cfg["data_validation"]["schema"]["columns"]
    names = [d["name"] for d in declared]
    data = _housing_rows(400)
    csv = tmp_path / "housing.csv"
    with open(csv, "w") as fh:
        fh.write(",".join(f'"{n}"' for n in names) + "\n")
        for r in data:
            fh.write(",".join("NA" if r[n] is None else str(r[n]) for n in names) + "\n")
    df = R.read_declared(spark, str(csv), declared)
    report = validate(df, declared, action="raise")
    assert report.where(F.col("status") == "fail").count() == 0
    t = jobs.train_job(df, cfg)
    m = {r["split"]: r for r in t.metrics.collect()}
    assert m["test"]["r2"] > 0.9            # price is linear in two inputs here
    assert "totrms_abvgr" in [r["source"] for r in t.params.collect()]   # the rename the reference missed
    assert len([f for f in t.features if not f.startswith("onehot__kitchen_qual")]) >= 10
    preds, dropped = jobs.score_batch(df.drop("SalePrice"), cfg, t.params, t.coefficients, t.features)
    assert preds.count() + dropped.count() == df.count()
    # The data stage on the whole 81-column table: exact quartiles for 38 numeric
    # columns and value counts for 43 text columns, each in a fixed number of passes.
    stage = jobs.data_stage(spark, cfg, df=df)
    desc = {r["column_name"]: r for r in stage["describe"].collect()}
    assert len(desc) == 81
    pdf = df.select("`Lot Area`", "`Kitchen Qual`").toPandas()   # 400-row fixture only
    want = pdf["Lot Area"].describe()
    assert desc["Lot Area"]["p25"] == pytest.approx(want["25%"]) and desc["Lot Area"]["p75"] == pytest.approx(want["75%"])
    assert desc["Kitchen Qual"]["unique"] == pdf["Kitchen Qual"].nunique()


def _housing_csv(path, data) -> None:
    names = [d["name"] for d in housing_config()["data_validation"]["schema"]["columns"]]
    with open(path, "w") as fh:
        fh.write(",".join(f'"{n}"' for n in names) + "\n")
        for r in data:
            fh.write(",".join("NA" if r[n] is None else str(r[n]) for n in names) + "\n")


def test_steps_and_stream_from_the_csv(spark, tmp_path):
    """All steps, the data stage and record scoring run from the file and the configuration alone."""
    data = _housing_rows(300)
    _housing_csv(tmp_path / "housing.csv", data)
    cfg = housing_config(str(tmp_path / "housing.csv"))
    state = jobs.run(spark, cfg, "all")
    assert state["report"].where("status = 'fail'").count() == 0
    scored = dict(rows(state["predictions"], "pid", "prediction"))
    assert len(scored) + state["dropped"].count() == len(data) and len(scored) > 200
    stage = jobs.data_stage(spark, cfg, out_root=str(tmp_path / "store"))
    assert stage["shape"].first().asDict() == {"n_rows": 300, "n_cols": 81, "n_duplicates": 0}
    assert stage["sample"].first()["PID"] == 100000

    contract = housing_record_contract("PID")
    assert len(contract) == 72 and sum(c["required"] for c in contract) == 16
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "a.json", "w") as fh:
        for r in data:
            rec = {c["name"]: r.get("TotRms AbvGrd" if c["name"] == "TotRms AbvGr" else c["name"]) for c in contract}
            fh.write(json.dumps({k: v for k, v in rec.items() if v is not None}) + "\n")
    t = state["train"]
    q = score_stream(spark, cfg, contract, str(tmp_path / "in"), t.params, t.coefficients, str(tmp_path / "out"),
                     str(tmp_path / "rej"), str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    streamed = dict(rows(spark.read.parquet(str(tmp_path / "out")), "pid", "prediction"))
    assert streamed and all(streamed[k] == pytest.approx(scored[k]) for k in streamed)
    assert len(streamed) + spark.read.parquet(str(tmp_path / "rej")).count() == len(data)


def test_a_value_of_the_wrong_type_fails_validation(spark, tmp_path):
    data = _housing_rows(5)
    data[2]["Lot Area"] = "large"
    _housing_csv(tmp_path / "housing.csv", data)
    with pytest.raises(ValueError, match="1 error"):
        jobs.run(spark, housing_config(str(tmp_path / "housing.csv")), "data_load,data_validation")
