"""Streaming scoring (L4 stream): the reference's per-record HTTP scorer, re-aimed.

JSON records arrive as files; each micro-batch is parsed against the record
contract, engineered, cleaned, transformed with the fitted parameters and
scored — the same projection as batch scoring, so batch and stream agree row
for row, however the records are dealt over micro-batches: every fitted value, group means
included, comes from the training run. Each micro-batch runs through ``foreachBatch``.

A micro-batch is parsed and scored once; predictions and rejected records go to folders named
by the batch id, and a row in the ledger commits the batch after both. Readers
(:func:`committed`) see committed batches only, so never one half of a batch. A batch replayed after
a failure replaces its own folders; one that is in the ledger already is whole and is left alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators.observe import Watch
from ..operators.transform import wanted_params
from ..plans.jobs import TrainedModel, load_training, score_rows
from ..sources import readers as R
from ..sources.records import records_from_path, tag_records

LEDGER = "_ledger"


def score_all(records: DataFrame, cfg: Mapping, contract: Sequence[Mapping], model: TrainedModel) -> DataFrame:
    """Every record in one frame: key, prediction, value and reasons (null where it is scored)."""
    key = cfg["key"]
    coef_rows = model.coefficients.collect()
    selected = [r["term"] for r in coef_rows if r["term"] != "__intercept__"]
    tagged = tag_records(records, contract, keep=["value"])
    names = [c["name"] for c in contract]
    typed = tagged.select(*[col(n) for n in names], "value", "reasons")
    scored = score_rows(typed, cfg, wanted_params(model.params, selected), coef_rows, selected, model.group_means, model.wide,
                        keep=["value", "reasons"])
    reasons = F.when(F.size("reasons") > 0, F.col("reasons")).when(F.col("reason").isNotNull(), F.array("reason"))
    return scored.select(col(key), F.when(reasons.isNull(), F.col("prediction")).alias("prediction"), "value", reasons.alias("reasons"))


class Models:
    """The model of a micro-batch: a given one, or the newest committed version under ``root``, read again only when it changes."""

    def __init__(self, spark: SparkSession, root: str, name: str = "model"):
        self.spark, self.root, self.name, self.version, self.model = spark, root, name, 0, None

    def current(self) -> tuple[int, TrainedModel]:
        version = R.latest_version(self.spark, self.root, self.name)
        if version != self.version:
            self.version, self.model = version, load_training(self.spark, R.version_folder(self.spark, self.root, self.name, version))
        return self.version, self.model


def score_batch_once(batch: DataFrame, batch_id: int, cfg: Mapping, contract: Sequence[Mapping], model: TrainedModel,
                     out_path: str, rejected_path: str, version: int = 0) -> None:
    """One micro-batch: both outputs from one parse, then the ledger row."""
    if R.exists(batch.sparkSession, f"{out_path}/{LEDGER}/batch_id={batch_id}"):
        return
    # Both outputs read the scored rows; they are kept for the second write instead of being parsed again.
    rows = score_all(batch, cfg, contract, model).persist()
    try:
        scored, rejected = Watch(F.count(F.lit(1)).alias("n")), Watch(F.count(F.lit(1)).alias("n"))
        scored.on(rows.where("reasons is null").select(col(cfg["key"]), "prediction")).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        rejected.on(rows.where("reasons is not null").select("value", "reasons")).write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}")
        commit_batch(batch.sparkSession, out_path, batch_id, version, scored.get()["n"], rejected.get()["n"])
    finally:
        rows.unpersist()


def commit_batch(spark: SparkSession, out_path: str, batch_id: int, version: int, n_scored: int, n_rejected: int) -> None:
    row = spark.createDataFrame([(version, n_scored, n_rejected)], "model_version int, n_scored long, n_rejected long")
    row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(f"{out_path}/{LEDGER}/batch_id={batch_id}")


def ledger(spark: SparkSession, out_path: str) -> DataFrame:
    """One row per committed batch: batch_id, model_version, n_scored, n_rejected, committed_at."""
    if not R.exists(spark, f"{out_path}/{LEDGER}"):
        raise FileNotFoundError(f"No committed batch under {out_path}")
    return spark.read.parquet(f"{out_path}/{LEDGER}")


def committed(spark: SparkSession, out_path: str, rejected_path: str) -> tuple[DataFrame, DataFrame]:
    """``(predictions, rejected)`` of the committed batches, each with its ``batch_id``."""
    done = ledger(spark, out_path).select("batch_id")
    return tuple(spark.read.parquet(p).join(F.broadcast(done), "batch_id", "left_semi") for p in (out_path, rejected_path))


def score_stream(spark: SparkSession, cfg: Mapping, contract: Sequence[Mapping], source: str,
                 params: DataFrame | None, coefficients: DataFrame | None, out_path: str, rejected_path: str,
                 checkpoint: str, available_now: bool = True, max_files: int | None = None,
                 group_means: DataFrame | None = None, wide: DataFrame | None = None, models: Models | None = None):
    """Start the scoring stream and return its ``StreamingQuery``; :func:`committed` reads what it wrote.

    The model's parameters (bounded by its width) are compiled into the projection, exactly as
    in batch scoring. With ``models`` each micro-batch takes the newest committed model, and the
    ledger names its version.
    """
    fixed = TrainedModel(params, coefficients, [], group_means, wide)
    records = records_from_path(spark, source, streaming=True, max_files=max_files)

    def _batch(batch: DataFrame, batch_id: int) -> None:
        version, model = models.current() if models else (0, fixed)
        score_batch_once(batch, batch_id, cfg, contract, model, out_path, rejected_path, version)

    w = records.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
