"""Committed runs, splits and stream batches; counts taken while writing; header lines; alignment; digests."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.config import ORDER_FEATURES
from tessera.functions.columns import wide_agg
from tessera.operators import profile as P
from tessera.operators.joins import align, align_counts
from tessera.plans import catalog_io as io
from tessera.plans import jobs, runs
from tessera.plans.views import order_features
from tessera.session import ensure_checkpoint_dir, materialize, scratch_scope
from tessera.sources import readers as R
from tessera.sources import sinks as K
from tessera.streaming import scoring

from .conftest import SF_SMALL, rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def of(spark):
    return order_features(spark, SF_SMALL)


def test_steps_with_a_store_write_and_read_everything(spark, of, tmp_path):
    cfg = {**ORDER_FEATURES, "store": str(tmp_path)}
    state = jobs.run(spark, cfg, "model,evaluation,inference", state={"raw": of})
    # K3: every input column of the model and the target, by split, under one version.
    full = R.read_full_or_splits(spark, str(tmp_path), "features")
    assert {*state["train"].features, "o_orderkey", "o_totalprice", "split"} == set(full.columns)
    assert full.count() == of.where("last_ship_year is not null").count()
    # Metrics from the files equal those of the training job.
    saved = {(r["split"], r["metric"]): r["value"] for r in state["metrics"].collect()}
    for r in state["train"].metrics.collect():
        assert saved[r["split"], "rmse"] == pytest.approx(r["rmse"])
    # L4 + K10: the newest committed model gives the predictions of training.
    a = dict(rows(state["predictions"], "o_orderkey", "prediction"))
    b = dict(rows(state["train"].predictions, "o_orderkey", "prediction"))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    # One row per run, with counts and the input's fingerprint.
    manifest = {r["job"]: r for r in runs.runs(spark, str(tmp_path)).collect()}
    assert set(manifest) == {"train", "evaluate", "score"}
    counts = json.loads(manifest["score"]["counts"])
    assert counts["n_scored"] == len(a) and counts["n_rows"] == of.count() and counts["absent_inputs"] == []
    assert manifest["score"]["fingerprint"] == P.fingerprint(of).first()["fingerprint"]
    assert counts["min"] == pytest.approx(min(a.values())) and counts["mean"] == pytest.approx(sum(a.values()) / len(a))
    with pytest.raises(FileNotFoundError, match="No score run"):
        runs.scored(spark, str(tmp_path), "o_orderkey", "unknown")


def test_all_steps_from_a_csv_parse_it_once(spark, of, tmp_path):
    path, store = str(tmp_path / "in"), str(tmp_path / "store")
    K.write_csv(of, path)
    kinds = {"bigint": "int", "double": "float", "string": "str"}
    cfg = {**ORDER_FEATURES, "store": store, "data_source": {"raw_path": path, "type": "csv"},
           "data_validation": {"schema": {"columns": [{"name": c, "dtype": kinds[t]} for c, t in of.dtypes]}}}
    state = jobs.run(spark, cfg, "all")
    assert state["version"] == 1 and state["report"].where("status = 'fail'").count() == 0
    assert f"{store}/raw/" in state["raw"].inputFiles()[0].replace("file:///", "/").replace("file:", "")
    assert state["raw"].count() == of.count()
    assert state["predictions"].count() + state["dropped"].count() == of.count()
    assert {r["job"] for r in runs.runs(spark, store).collect()} == {"train", "evaluate", "score"}
    cfg["data_validation"]["schema"]["columns"][-1] = {"name": "n_name", "dtype": "int"}
    with pytest.raises(ValueError, match="error"):
        jobs.run(spark, cfg, "data_load")
    assert R.latest_version(spark, store, "raw") == 1


def test_a_training_and_ten_scorings_leave_no_table_behind(spark, of, tmp_path):
    tables = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "tables"
    before = set(tables.glob("*")) if tables.exists() else set()
    t = runs.training_run(of, ORDER_FEATURES, str(tmp_path))
    for _ in range(10):
        runs.scoring_run(of.limit(30), ORDER_FEATURES, str(tmp_path))
    assert set(tables.glob("*")) == before
    assert t.predictions.count() == t.data.count() and t.scores.count() > 6 and t.metrics.count() == 2
    with pytest.raises(RuntimeError, match="stop"), scratch_scope(spark):
        materialize(of.limit(3))
        raise RuntimeError("stop")
    assert set(tables.glob("*")) == before


def test_scoring_reads_its_input_once(spark, of, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    inputs = of.drop("o_totalprice").mapInArrow(count, of.drop("o_totalprice").schema)
    runs.scoring_run(inputs, io._fixed_cfg(), str(tmp_path), io._fixed_model(spark))
    assert seen.value == of.count()


def test_a_model_input_that_scoring_lacks_counts_as_zero_and_is_reported(spark, of, tmp_path):
    m = io._fixed_model(spark)
    less = jobs.TrainedModel(m.params.where("source != 'order_year'"), m.coefficients, m.features)
    runs.scoring_run(of, io._fixed_cfg(), str(tmp_path), less)
    assert json.loads(runs.run_row(spark, str(tmp_path), "score")["counts"])["absent_inputs"] == ["scaler__order_year"]
    preds, _ = runs.scored(spark, str(tmp_path), "o_orderkey")
    one = preds.join(of.select("o_orderkey", "lines_cnt"), "o_orderkey").where("lines_cnt is not null").first()
    assert one["prediction"] == pytest.approx(1000 + 2.5 * one["lines_cnt"])


def test_splits_are_committed_and_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(i, ("train", "valid", "test")[i % 3]) for i in range(30)], "k long, split string")
    with pytest.raises(FileNotFoundError):
        R.read_splits(spark, root, "f")
    with pytest.raises(FileNotFoundError):
        K.replace_split(df, root, "f", "test")
    assert K.publish_splits(df, root, "f") == 1
    K.stage(df.limit(1), root, "f", ["split"])  # a publish that died: not seen
    assert rows(R.read_splits(spark, root, "f")) == rows(df)
    before = R.split_folders(spark, root, "f")
    assert K.replace_split(spark.createDataFrame([(99,)], "k long"), root, "f", "valid") == 2
    after = R.split_folders(spark, root, "f")
    assert before["train"] == after["train"] and before["valid"] != after["valid"]
    assert rows(R.read_splits(spark, root, "f", ["valid"])) == [(99, "valid")]
    assert R.read_splits(spark, root, "f", version=1).count() == 30
    plan = _plan(R.read_splits(spark, root, "f", ["train"]))
    assert "split=test" not in plan and "split=valid" not in plan
    with pytest.raises(FileNotFoundError, match="other"):
        R.read_splits(spark, root, "f", ["other"])
    K.publish(df.limit(3), root, "f")  # a full table goes before its splits
    assert R.read_full_or_splits(spark, root, "f").count() == 3


def test_a_failed_data_stage_leaves_no_version_and_no_folder(spark, tmp_path):
    path, store = str(tmp_path / "in.csv"), str(tmp_path / "store")
    with open(path, "w") as f:
        f.write("a,b\n1,x\n2.5,y\nNA,z\n")
    cfg = {"data_source": {"raw_path": path, "type": "csv"}, "data_validation": {
        "action_on_error": "raise", "schema": {"columns": [{"name": "a", "dtype": "int", "required": True}, {"name": "b", "dtype": "str"}]}}}
    with pytest.raises(ValueError, match="1 error"):
        jobs.data_stage(spark, cfg, out_root=store)
    assert R.latest_version(spark, store, "raw") == 0 and not list((tmp_path / "store" / "raw").glob("data-*"))
    assert [r["status"] for r in spark.read.json(f"{store}/validation_report_summary").collect()] == ["fail"]
    cfg["data_validation"]["action_on_error"] = "warn"
    out = jobs.data_stage(spark, cfg, out_root=store)
    assert (out["version"], out["n_rows"]) == (1, 3) and rows(R.latest(spark, store, "raw"), "b") == [(None, "x")[1:], ("y",), ("z",)]


def _stream_args(spark, of, tmp_path):
    inputs = of.drop("o_totalprice")
    inputs.select(F.to_json(F.struct(*inputs.columns)).alias("value")).repartition(3).write.text(str(tmp_path / "in"))
    m = io._fixed_model(spark)
    paths = [str(tmp_path / p) for p in ("out", "rejected", "ckpt")]
    return (spark, io._fixed_cfg(), io._order_contract(inputs), str(tmp_path / "in"), m.params, m.coefficients, *paths), paths


def test_a_batch_that_stops_between_its_two_outputs_is_not_seen(spark, of, tmp_path, monkeypatch):
    args, (out, rejected, _) = _stream_args(spark, of, tmp_path)
    commit, calls = scoring.commit_batch, []

    def fails_once(*a):
        calls.append(a[2])
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        return commit(*a)

    monkeypatch.setattr(scoring, "commit_batch", fails_once)
    query = scoring.score_stream(*args, max_files=1)
    with pytest.raises(Exception, match="lost driver"):
        query.awaitTermination(300)
    seen = scoring.committed(spark, out, rejected)
    written = spark.read.parquet(out).select("batch_id").distinct().count()
    assert rows(scoring.ledger(spark, out), "batch_id") == [(0,)] and written == 2
    assert {r["batch_id"] for r in seen[0].select("batch_id").distinct().collect()} == {0}
    scoring.score_stream(*args, max_files=1).awaitTermination(300)  # goes on from the checkpoint
    preds, bad = scoring.committed(spark, out, rejected)
    assert preds.count() + bad.count() == of.count() and preds.count() == preds.select("o_orderkey").distinct().count()
    counts = scoring.ledger(spark, out).agg(F.sum("n_scored"), F.sum("n_rejected")).first()
    assert tuple(counts) == (preds.count(), bad.count())


def test_a_committed_batch_is_left_alone_on_replay(spark, of, tmp_path):
    (_, cfg, contract, _, params, coefs, *_), (out, rejected, _) = _stream_args(spark, of, tmp_path)
    model = jobs.TrainedModel(params, coefs, [])
    batch = spark.read.text(str(tmp_path / "in")).limit(20)
    scoring.score_batch_once(batch, 7, cfg, contract, model, out, rejected)
    first = rows(scoring.committed(spark, out, rejected)[0])
    scoring.score_batch_once(batch.limit(1), 7, cfg, contract, model, out, rejected)
    assert rows(scoring.committed(spark, out, rejected)[0]) == first
    with pytest.raises(FileNotFoundError, match="No committed batch"):
        scoring.ledger(spark, str(tmp_path / "elsewhere"))


def test_each_batch_takes_the_newest_model(spark, of, tmp_path):
    args, (out, rejected, _) = _stream_args(spark, of, tmp_path)
    store, m = str(tmp_path / "store"), io._fixed_model(spark)

    def save(name, factor):
        coefs = m.coefficients.withColumn("coefficient", F.col("coefficient") * factor)
        K.write_params(m.params, f"{store}/model/{name}/transformer")
        K.write_params(coefs, f"{store}/model/{name}/model")
        K.write_feature_list(spark, m.features, f"{store}/model/{name}/selected_features")
        return K.commit(spark, store, "model", f"model/{name}")

    assert save("one", 1.0) == 1
    models = scoring.Models(spark, store)
    version, first = models.current()
    assert version == 1 and models.current()[1] is first  # not read again while nothing is new
    assert save("two", 10.0) == 2
    scoring.score_stream(*args[:4], None, None, *args[6:], models=models).awaitTermination(300)
    assert {r["model_version"] for r in scoring.ledger(spark, out).collect()} == {2}
    got = dict(rows(scoring.committed(spark, out, rejected)[0], "o_orderkey", "prediction"))
    want = of.where("last_ship_year is not null").selectExpr("o_orderkey", "10 * (1000 + 2.5 * coalesce(lines_cnt, 0) - 0.25 * order_year) as p")
    assert {k: pytest.approx(v) for k, v in rows(want)} == got


def test_header_below_the_first_line(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("notes\n\n, more notes\n\"id\",\"a b\"\n" + "".join(f'{k}{i},"x, ""{i}"""\n' for i in range(k * 5)))
    df = R.read_table(spark, str(tmp_path), header=2)
    assert df.columns == ["id", "a b"] and df.count() == 15 and ("10", 'x, "0"') in rows(df)
    assert R.read_table(spark, str(tmp_path), header=2, schema="id int, t string").agg(F.sum("id")).first()[0] == sum(
        int(f"{k}{i}") for k in range(3) for i in range(k * 5))
    with pytest.raises(ValueError, match="No common header"):
        R.read_table(spark, str(tmp_path), header=5)
    with pytest.raises(ValueError, match="multi_line"):
        R.read_table(spark, str(tmp_path), header=2, multi_line=True)
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, str(tmp_path / "absent"), header=2)
    (tmp_path / "3.csv").write_text("a\nb\n\"id\",\"a b\"\n1,2,3\n")
    with pytest.raises(Exception, match="Expected 2 values"):
        R.read_table(spark, str(tmp_path), header=2).collect()


def test_header_below_the_first_line_of_files_in_many_blocks(spark, tmp_path):
    n = 20_000
    (tmp_path / "big.csv").write_text("skip\nk,v\n" + "".join(f"{i},{'y' * 20}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = R.read_table(spark, str(tmp_path / "big.csv"), header=1)
        assert df.agg(F.count("*"), F.sum(F.col("k").cast("long"))).first()[:] == (n, n * (n - 1) // 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_alignment_takes_one_exchange(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1.0), (None, "z", 2.0)], "`k.1` long, v string, w double")
    b = spark.createDataFrame([(2, 5.0), (1, None)], "`k.1` long, p double")
    good = a.where("`k.1` is not null")
    assert align(good, b, "k.1").columns == ["k.1", "v", "w", "p"]
    assert rows(align(good, b, "k.1")) == [(1, "x", None, None), (2, "y", 1.0, 5.0)]
    with pytest.raises(ValueError, match="1 key"):
        align(a, b, "k.1")  # a null key matches nothing
    with pytest.raises(ValueError, match=r"repeated in first: 0, in second: 1"):
        align(good, b.union(b.limit(1)), "k.1")
    counted = align_counts(a, b, "k.1")
    # One exchange by key; the other gathers the partial counts.
    assert _plan(counted).count("Exchange hashpartitioning") == 1 and _plan(counted).count("Exchange SinglePartition") == 1
    assert counted.first().asDict() == {"n_matched": 2, "only_a": 1, "only_b": 0, "dup_a": 0, "dup_b": 0, "bad": 1}
    assert rows(align(a.limit(0), b.limit(0), "k.1")) == []


def test_duplicate_digests_tell_rows_apart(spark):
    data = [("ab", "c", 0.0, None), ("a", "bc", 0.0, None), ("ab", "c", -0.0, None), (None, "abc", float("nan"), b"1"), (None, "abc", float("nan"), b"1"),
            ("-", None, 1.0, b""), (None, "-", 1.0, b""), ("1:a", "", 2.0, None), ("1", ":a", 2.0, None)]
    df = spark.createDataFrame(data, "a string, b string, c double, d binary")
    assert P.duplicate_count(df).first().asDict() == {"n_rows": 9, "n_distinct": 7, "n_duplicates": 2, "has_duplicates": True}
    assert P.duplicate_count(df.limit(0)).first()["n_rows"] == 0
    plan = _plan(P.duplicate_count(df.select("a")))
    assert "keys=[digest" in plan and "keys=[a#" not in plan
    arrays = spark.createDataFrame([([1], "x"), ([1], "x"), ([2], "x")], "a array<int>, b string")
    assert P.duplicate_count(arrays).first()["n_distinct"] == 2


def test_profiles_never_multiply_rows(spark):
    wide = spark.range(50).select(*[F.when(F.col("id") % (i + 2) == 0, F.col("id").cast("double")).alias(f"c.{i}") for i in range(200)])
    info = P.null_counts(wide)
    got = {r["column_name"]: r["n_null"] for r in info.collect()}
    assert got == {f"c.{i}": 50 - len([k for k in range(50) if k % (i + 2) == 0]) for i in range(200)}
    plan = _plan(info)
    for part in plan.split("Generate inline")[1:]:  # only above an aggregate's single row
        assert "HashAggregate" in part
    assert "explode" not in plan
    assert dict(rows(wide_agg(wide.limit(0), ["c.0"], lambda c, _n: {"n": F.count(c)}))) == {"c.0": 0}


def test_whole_numbers_with_a_null_are_floats(spark):
    df = spark.createDataFrame([("1", "1"), (None, "2")], "a string, b string")
    assert dict(rows(R.infer_types(df))) == {"a": "float", "b": "int"}
