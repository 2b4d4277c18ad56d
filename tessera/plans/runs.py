"""Jobs that write what the steps of the reference write, each input read once.

One store folder holds everything: versions and splits with their manifests, models, runs.

* :func:`training_run` — L3 with K2/K3/K4/K8/K9/K11: features and target by split, predictions,
  metrics, and the model as a committed version.
* :func:`scoring_run` — L4 with K10: predictions and the rows without one in a single write; row
  counts, prediction range and non-finite values are counted while the rows are written.
* :func:`evaluation_run` — R7 with K4: metrics of saved predictions.

Every run appends one manifest row (L5) after its data is in place; readers go by the
manifest, so a run that died has left nothing that they see.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col, is_finite
from ..operators.metrics import evaluate_saved, metrics_long
from ..operators.observe import Watch
from ..operators.profile import fingerprint_columns, fingerprint_text
from ..operators.transform import apply_transformer, wanted_params
from ..session import scratch_scope
from ..sources import readers as R
from ..sources import sinks as K
from . import jobs

RUNS = "_runs"
RUN_SCHEMA = ("run_id string, job string, at timestamp_ntz, folder string, n_rows long, fingerprint string, schema string, "
              "counts string, config string")


def _schema(df: DataFrame) -> str:
    return json.dumps({f.name: f.dataType.simpleString() for f in df.schema.fields})


def record_run(spark: SparkSession, store: str, run_id: str, job: str, folder: str, schema: str, counts: Mapping, cfg: Mapping) -> None:
    """Appends a run's manifest row; its data is in place already."""
    row = (run_id, job, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), folder, counts.get("n_rows"), counts.get("fingerprint"),
           schema, json.dumps(dict(counts)), json.dumps(cfg, default=str))
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(f"{store}/{RUNS}")


def runs(spark: SparkSession, store: str) -> DataFrame:
    """The manifest, one row per finished run."""
    if not R.exists(spark, f"{store}/{RUNS}"):
        raise FileNotFoundError(f"No run under {store}")
    return spark.read.parquet(f"{store}/{RUNS}")


def run_row(spark: SparkSession, store: str, job: str, run_id: str | None = None):
    found = runs(spark, store).where(F.col("job") == job)
    row = (found.where(F.col("run_id") == run_id) if run_id else found).orderBy(F.desc("at"), F.desc("run_id")).first()
    if row is None:
        raise FileNotFoundError(f"No {job} run {run_id or ''} under {store}")
    return row


def training_run(df_raw: DataFrame, cfg: Mapping, store: str, split_method: str = "hash") -> jobs.TrainResult:
    """L3, written out; the run's folder holds ``predictions`` by split, ``metrics`` and ``scores``.

    The result's frames read the store; no intermediate table outlives the run.
    """
    spark, run_id = df_raw.sparkSession, uuid.uuid4().hex[:12]
    key, target, own, folder = cfg["key"], cfg["target"], f"{store}/train/{run_id}", f"model/data-{run_id}"
    with scratch_scope(spark):
        result = jobs.train_job(df_raw, cfg, split_method)
        # K3: the model's inputs and the target of every row, by split, under one version.
        wide = [] if result.wide is None else sorted(r["source"] for r in result.wide.select("source").distinct().collect())
        matrix = apply_transformer(result.data, result.params, keep=[key, target, "split", *[w for w in wide if w != key]], outputs=result.features)
        K.publish_splits(matrix, store, "features")
        jobs.save_training(result, f"{store}/{folder}")
        rows = Watch(F.count(F.lit(1)).alias("n_rows"), F.count_if(~is_finite(F.col("prediction"))).alias("n_not_finite"),
                     F.count_if(F.col("split") == "train").alias("n_train"))
        K.write_splits(rows.on(result.predictions).withColumnRenamed("prediction", "y_pred"), f"{own}/predictions")
        K.write_params(result.metrics, f"{own}/metrics_table")
        K.write_json(metrics_long(spark.read.parquet(f"{own}/metrics_table"), by="split"), f"{own}/metrics")
        K.write_params(result.scores, f"{own}/scores")
    version = K.commit(spark, store, "model", folder)
    record_run(spark, store, run_id, "train", f"train/{run_id}", _schema(df_raw), {**rows.get(), "model_version": version}, cfg)
    model, read = jobs.load_training(spark, f"{store}/{folder}"), spark.read.parquet
    return jobs.TrainResult(model.params, read(f"{own}/scores"), read(f"{store}/{folder}/selected_features"), model.coefficients,
                            R.read_predictions(spark, f"{own}/predictions").withColumnRenamed("y_pred", "prediction"),
                            read(f"{own}/metrics_table"), model.features, model.group_means, model.wide, R.read_splits(spark, store, "features"))


def scoring_run(df_raw: DataFrame, cfg: Mapping, store: str, model: jobs.TrainedModel | None = None,
                require_rows: bool = False) -> str:
    """L4 + K10: scores every row of ``df_raw`` with the newest committed model and returns the run's id.

    One write, by ``status``: ``scored`` rows with key and prediction, ``dropped`` rows with
    key and reason. ``require_rows`` (V9): nothing scored is an error, and the run is not recorded. Input
    columns that the model lacks and takes as 0 (F9) are listed in the manifest (U2).
    """
    spark, run_id, key = df_raw.sparkSession, uuid.uuid4().hex[:12], cfg["key"]
    if model is None:
        model = jobs.load_training(spark, R.version_folder(spark, store, "model"))
    coef_rows = model.coefficients.collect()
    selected = [r["term"] for r in coef_rows if r["term"] != "__intercept__"]
    params = wanted_params(model.params, selected)
    made = {r["output"] for r in params}
    absent = [f for f in selected if f not in made]
    seen = Watch(F.count(F.lit(1)).alias("n_rows"), *fingerprint_columns(df_raw))
    rows = jobs.score_rows(seen.on(df_raw), cfg, params, coef_rows, selected, model.group_means, model.wide)
    rows = rows.withColumn("status", F.when(F.col("reason").isNull(), "scored").otherwise("dropped"))
    p = F.col("prediction")
    out = Watch(F.count_if(F.col("status") == "scored").alias("n_scored"), F.count_if(F.col("reason") == jobs.REMOVED).alias("n_removed"),
                F.count_if(F.col("reason") == jobs.NO_INPUT).alias("n_no_input"),
                F.count_if(p.isNotNull() & ~is_finite(p)).alias("n_not_finite"),
                F.avg(p).alias("mean"), F.min(p).alias("min"), F.max(p).alias("max"))
    folder = f"score/{run_id}"
    with scratch_scope(spark):
        out.on(rows).write.partitionBy("status").parquet(f"{store}/{folder}")
    first, counts = seen.get(), out.get()
    counts = {"n_rows": first["n_rows"], "fingerprint": fingerprint_text(first), **counts, "absent_inputs": absent}
    if require_rows and not counts["n_scored"]:
        K.discard(spark, store, folder)
        raise ValueError("No rows left to score after cleaning")
    record_run(spark, store, run_id, "score", folder, _schema(df_raw), counts, cfg)
    return run_id


def scored(spark: SparkSession, store: str, key: str, run_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(predictions (key, prediction), dropped (key, reason))`` of the newest (or a given) scoring run."""
    rows = spark.read.parquet(f"{store}/{run_row(spark, store, 'score', run_id)['folder']}")
    return (rows.where("status = 'scored'").select(col(key), "prediction"),
            rows.where("status = 'dropped'").select(col(key), "reason"))


def evaluation_run(spark: SparkSession, store: str, run_id: str | None = None, by: str | None = "split") -> DataFrame:
    """Metrics of a training run's saved predictions, from the files alone; written (K4) and returned."""
    row = run_row(spark, store, "train", run_id)
    saved = R.read_predictions(spark, f"{store}/{row['folder']}/predictions")
    rows = Watch(F.count(F.lit(1)).alias("n_rows"))
    metrics = evaluate_saved(rows.on(saved), by=by)
    own = uuid.uuid4().hex[:12]
    long = metrics_long(metrics, by=by)
    K.write_json(long, f"{store}/evaluate/{own}/metrics")
    record_run(spark, store, own, "evaluate", f"evaluate/{own}", _schema(saved), {**rows.get(), "of_run": row["run_id"]}, {})
    return spark.read.schema(long.schema).json(f"{store}/evaluate/{own}/metrics")
