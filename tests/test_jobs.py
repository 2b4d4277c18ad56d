"""Composed jobs and streaming (reference: model / inference / api tests, plus the gaps SURVEY §5 lists)."""

from __future__ import annotations

import copy
import json

import pytest
from pyspark.sql import functions as F

from tessera.config import ORDER_FEATURES, housing_record_contract
from tessera.plans import jobs
from tessera.plans.views import order_features
from tessera.sources.records import parse_records
from tessera.streaming.scoring import score_stream

from .conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def trained(spark):
    of = order_features(spark, SF_SMALL)
    return of, jobs.train_job(of, copy.deepcopy(ORDER_FEATURES))


def test_train_job_end_to_end(trained):
    of, t = trained
    m = {r["split"]: r for r in t.metrics.collect()}
    assert set(m) == {"valid", "test"}
    assert all(r["n"] > 0 and r["rmse"] ** 2 == pytest.approx(r["mse"]) for r in m.values())
    # Every cleaned row is predicted exactly once, keyed.
    preds = t.predictions
    assert preds.count() == preds.select("o_orderkey").distinct().count() == of.where(
        F.col("last_ship_year").isNotNull()).count()
    # The always-keep source contributes all its one-hot columns.
    assert any(f.startswith("onehot__c_mktsegment_") for f in t.features)


def test_target_stays_aligned(trained):
    of, t = trained
    joined = t.predictions.join(of.select("o_orderkey", "o_totalprice"), "o_orderkey")
    assert joined.where(F.col("y_true") != F.col("o_totalprice")).count() == 0


def test_batch_scoring_matches_training_predictions(trained, spark):
    of, t = trained
    cfg = copy.deepcopy(ORDER_FEATURES)
    preds, dropped = jobs.score_batch(of.drop("o_totalprice"), cfg, t.params, t.coefficients, t.features,
                                      group_means=t.group_means)
    a = dict(rows(preds, "o_orderkey", "prediction"))
    b = dict(rows(t.predictions, "o_orderkey", "prediction"))
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-6 for k in a)
    assert dropped.count() == of.where(F.col("last_ship_year").isNull()).count()


def test_stream_scoring_equals_batch(trained, spark, tmp_path):
    of, t = trained
    cfg = copy.deepcopy(ORDER_FEATURES)
    cols = [c for c in of.columns if c != "o_totalprice"]
    src = tmp_path / "in"
    of.select(F.to_json(F.struct(*cols)).alias("value")).repartition(4).write.text(str(src))
    types = {"bigint": "int", "double": "float", "string": "str"}
    contract = [{"name": c, "dtype": types[t_], "required": c == "o_orderkey"}
                for c, t_ in of.select(*cols).dtypes]
    q = score_stream(spark, cfg, contract, str(src), t.params, t.coefficients,
                     str(tmp_path / "out"), str(tmp_path / "rej"), str(tmp_path / "ckpt"), max_files=1,
                     group_means=t.group_means)
    q.awaitTermination(300)
    streamed = dict(rows(spark.read.parquet(str(tmp_path / "out")), "o_orderkey", "prediction"))
    batch, _ = jobs.score_batch(of.drop("o_totalprice"), cfg, t.params, t.coefficients, t.features,
                                group_means=t.group_means)
    expected = dict(rows(batch, "o_orderkey", "prediction"))
    assert streamed.keys() == expected.keys()
    assert all(abs(streamed[k] - expected[k]) < 1e-6 for k in expected)


def test_prediction_does_not_depend_on_its_batch(trained, spark, tmp_path):
    """One row alone, and from reloaded tables, scores as it does among all rows; NaN counts as null."""
    of, t = trained
    cfg = copy.deepcopy(ORDER_FEATURES)
    jobs.save_training(t, str(tmp_path / "run"))
    m = jobs.load_training(spark, str(tmp_path / "run"))
    holes = of.drop("o_totalprice").withColumn("lines_value", F.when(F.col("o_orderkey") % 3 == 0, F.lit(float("nan")))
                                               .otherwise(F.col("lines_value")))
    score = lambda df: jobs.score_batch(df, cfg, m.params, m.coefficients, m.features, group_means=m.group_means)
    whole = dict(rows(score(holes)[0], "o_orderkey", "prediction"))
    assert m.features == t.features and any(k % 3 == 0 for k in whole)
    for k in [k for k in sorted(whole) if k % 3 == 0][:2]:
        alone = score(holes.where(F.col("o_orderkey") == k))[0].collect()
        assert [(r[0], r[1]) for r in alone] == [(k, pytest.approx(whole[k]))]
    # A group that training never saw has no mean: reported, not scored as null.
    preds, dropped = score(holes.where("o_orderkey % 3 = 0").withColumn("n_name", F.lit("NOWHERE")))
    assert preds.count() == 0 and jobs.NO_INPUT in {r["reason"] for r in dropped.collect()}
    with pytest.raises(ValueError, match="group_means"):
        jobs.score_batch(holes, cfg, m.params, m.coefficients, m.features)


def test_record_contract(spark):
    contract = housing_record_contract()
    assert sum(1 for c in contract if c["required"]) == 16
    good = {c["name"]: (1.0 if c["dtype"] in ("int", "float") else "x") for c in contract if c["required"]}
    good["PID"] = 5  # unknown field: ignored
    bad_type = dict(good, **{"Overall Qual": 7.5})
    missing = {k: v for k, v in good.items() if k != "Neighborhood"}
    df = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(bad_type)), (3, json.dumps(missing)),
                                (4, "not json")], "id long, value string")
    valid, rejected = parse_records(df, contract, keep=["id"])
    assert [r[0] for r in rows(valid, "id")] == [1]
    assert valid.first()["Overall Qual"] == 1 and dict(valid.dtypes)["Overall Qual"] == "bigint"
    reasons = {r["id"]: r["reasons"] for r in rejected.collect()}
    assert reasons[2] == ["not an integer: Overall Qual"]
    assert reasons[3] == ["missing required field: Neighborhood"]
    assert "malformed record" in reasons[4]


def test_manifest_and_steps(trained, spark, tmp_path):
    of, t = trained
    path = str(tmp_path / "runs")
    rid = jobs.append_manifest(of, path, "train", metrics=t.metrics, config={"k": 6})
    row = spark.read.parquet(path).first()
    assert row["run_id"] == rid and row["n_rows"] == of.count() and len(row["fingerprint"]) == 64
    state = jobs.run(spark, copy.deepcopy(ORDER_FEATURES), "data_validation,model,evaluation,inference",
                     state={"raw": of})
    assert state["predictions"].count() > 0 and state["metrics"].count() == 2
    with pytest.raises(ValueError, match="Unknown step"):
        jobs.run(spark, ORDER_FEATURES, "nope")


def test_stream_restart_is_idempotent(trained, spark, tmp_path):
    of, t = trained
    cfg = copy.deepcopy(ORDER_FEATURES)
    cfg["preprocessing"]["fillna_groupby"] = {}
    cols = [c for c in of.columns if c != "o_totalprice"]
    src = tmp_path / "in"
    of.select(F.to_json(F.struct(*cols)).alias("value")).repartition(3).write.text(str(src))
    types = {"bigint": "int", "double": "float", "string": "str"}
    contract = [{"name": c, "dtype": types[t_], "required": c == "o_orderkey"} for c, t_ in of.select(*cols).dtypes]
    args = (spark, cfg, contract, str(src), t.params, t.coefficients,
            str(tmp_path / "out"), str(tmp_path / "rej"), str(tmp_path / "ckpt"))
    q = score_stream(*args, max_files=1)          # one file per micro-batch
    q.awaitTermination(300)
    first = spark.read.parquet(str(tmp_path / "out"))
    n_batches = first.select("batch_id").distinct().count()
    n_rows = first.count()
    assert n_batches >= 3 and n_rows == first.select("o_orderkey").distinct().count()
    q = score_stream(*args, max_files=1)          # restart from the same checkpoint: nothing new
    q.awaitTermination(300)
    again = spark.read.parquet(str(tmp_path / "out"))
    assert again.count() == n_rows and again.select("batch_id").distinct().count() == n_batches


def test_awkward_names_and_middle_row_dropped(spark):
    """FIXTURES A10: names with space, slash, dot, leading digit; a row removed mid-table keeps targets aligned."""
    import random
    rnd = random.Random(11)
    data = []
    for i in range(300):
        area = float(rnd.randint(1000, 20000))
        first = None if i == 150 else float(rnd.randint(400, 3000))
        qual = rnd.choice(["Ex", "Gd", "TA"])
        price = 10.0 * area + (0.0 if first is None else 30.0 * first) + {"Ex": 5e4, "Gd": 2e4, "TA": 0.0}[qual]
        data.append((i, None if i % 37 == 0 else area, first, 1990 + i % 20, qual, price))
    df = spark.createDataFrame(data, "`row id` long, `Lot Area` double, `1st Flr SF` double, "
                                     "`Year Remod/Add` long, `Kitchen Qual` string, `sale.price` double")
    cfg = {
        "key": "row id", "target": "sale.price",
        "data_split": {"train": 0.6, "valid": 0.2, "test": 0.2, "random_state": 42},
        "model": {"active": "linear_regression"}, "selection": {"k": 10},
        "features": {"categorical": ["Kitchen Qual"], "continuous": ["Lot Area", "1st Flr SF"],
                     "ordinal": ["Year Remod/Add"], "most_relevant_features": []},
        "preprocessing": {
            "fillna_groupby": {"column": "Lot Area", "groupby": "Kitchen Qual", "method": "mean"},
            "dropna_rows": ["1st Flr SF"],
            "encoding": {"one_hot": {"drop": "first", "handle_unknown": "ignore"}},
            "scaling": {"method": "standard", "apply_to": ["continuous", "ordinal"]},
        },
    }
    t = jobs.train_job(df, cfg)
    preds = t.predictions
    assert preds.count() == 299
    truth = dict(rows(df.select("`row id`", "`sale.price`")))
    for k, y in rows(preds.select("`row id`", "y_true")):
        assert truth[k] == y                      # every target still belongs to its own row
    scored, dropped = jobs.score_batch(df.drop("sale.price"), cfg, t.params, t.coefficients, t.features,
                                       group_means=t.group_means)
    assert [r[0] for r in dropped.collect()] == [150]
    assert scored.count() == 299
    assert {"onehot__Kitchen Qual_Gd", "scaler__Year Remod/Add"} <= set(t.features)
