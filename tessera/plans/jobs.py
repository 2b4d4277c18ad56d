"""Composed jobs L1–L5: data stage, training, batch scoring, run manifest.

Each job is a chain of DataFrame → DataFrame operators, so Catalyst sees one
plan per action. The training job materialises its cleaned, split input once
(a reliable checkpoint) because four fits read it; everything else stays lazy.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..operators import clean as C
from ..operators import profile as P
from ..operators import validate as V
from ..operators.features import engineer
from ..operators.joins import column_difference
from ..operators.metrics import metrics_long, regression_metrics
from ..operators.model import fit_linear, predict, prediction_expr
from ..operators.observe import Watch
from ..operators.select import select_k
from ..operators.sparse import add_wide, feature_index, fit_absorbed, fit_sparse, sparse_design, wide_sources, WIDE_FROM
from ..operators.split import split
from ..operators.transform import apply_transformer, fit_scored, output_columns, wanted_params
from ..session import materialize
from ..sources import readers as R
from ..sources import sinks as K

log = logging.getLogger(__name__)

# Why a row or record has no prediction.
REMOVED = "removed by cleaning"
NO_INPUT = "a model input is missing"


def prepare_flagged(df: DataFrame, cfg: Mapping, group_means: DataFrame | None = None) -> DataFrame:
    """NaN → null, E, then F6 with the group means fitted in training; ``_complete``: whether cleaning keeps the row.

    A configured group mean needs its fitted table, or predictions would depend on which
    rows arrive together.
    """
    if group_means is None and cfg.get("preprocessing", cfg).get("fillna_groupby"):
        raise ValueError("The configured group mean needs the fitted group_means of the training run")
    spec = cfg.get("engineering") or []
    out = nan_to_null(df)
    return C.impute_and_flag(C.row_local_clean(engineer(out, spec) if spec else out, cfg), cfg, group_means)


def split_fractions(cfg: Mapping) -> dict:
    s = cfg.get("data_split", {})
    if "train" in s:
        return {k: s[k] for k in ("train", "valid", "test") if k in s}
    test, valid = s.get("test_size", 0.2), s.get("valid_size", 0.2)
    return {"train": 1.0 - test - valid, "valid": valid, "test": test}


def training_columns(cfg: Mapping) -> list[str]:
    """Every column the training job reads after cleaning, in a stable order."""
    feats = cfg.get("features", {})
    pre = cfg.get("preprocessing", {}) or {}
    grp = pre.get("fillna_groupby") or {}
    names = [cfg["key"], cfg["target"]]
    for role in ("categorical", "ordinal", "continuous", "engineered", "most_relevant_features"):
        names += list(feats.get(role, []) or [])
    names += [grp.get("column"), grp.get("groupby")] + list(pre.get("dropna_rows", []) or [])
    out: list[str] = []
    for n in names:
        if n and n not in out:
            out.append(n)
    return out


@dataclass
class TrainResult:
    params: DataFrame            # fitted transformer (M6)
    scores: DataFrame            # F-scores of every transformed feature (M8)
    selected: DataFrame          # (position, feature) (M9/M10)
    coefficients: DataFrame      # (position, term, coefficient) (M13)
    predictions: DataFrame       # (key, split, y_true, prediction) for every row (M14)
    metrics: DataFrame           # per split (R5)
    features: list = field(default_factory=list)
    group_means: DataFrame | None = None   # fitted (group, mean) table of W1, if configured
    wide: DataFrame | None = None          # (source, category, output, coefficient) of wide kept columns
    data: DataFrame | None = None          # the cleaned, split rows that the fits read


def _fit(train: DataFrame, data: DataFrame, params: DataFrame, chosen: list, wide: list, key: str, target: str,
         kind: str) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """``(coefficients, wide coefficients, predictions)``; wide sources never become columns."""
    others = [key, target, "split"]
    matrix = apply_transformer(data, params, keep=[*others, *[w for w in wide if w not in others]], outputs=chosen)
    of_train = matrix.where(F.col("split") == "train")
    if not wide:
        coefs = fit_linear(of_train, chosen, target, kind=kind)
        return coefs, None, predict(matrix, coefs, keep=[key, "split", target])
    if len(wide) == 1:
        coefs, table = fit_absorbed(of_train, chosen, wide[0], params, target)
    else:
        outputs = (params.where(F.col("source").isin(wide) | F.col("output").isin(chosen)).select(F.col("output").alias("feature")))
        index = materialize(feature_index(params, outputs), name="feature-index")
        fitted = materialize(fit_sparse(sparse_design(train, index, keep=[target]), index, target), name="sparse-fit")
        rows = {r["output"]: r["coefficient"] for r in fitted.where(F.col("output").isin([*chosen, "__intercept__"])).collect()}
        coefs = train.sparkSession.createDataFrame(
            [(i, t, rows[t]) for i, t in enumerate([*chosen, "__intercept__"])], "position int, term string, coefficient double")
        table = materialize(index.where(F.col("source").isin(wide)).select("source", "category", "output")
                            .join(fitted.select("output", "coefficient"), "output")
                            .select("source", "category", "output", "coefficient"), name="wide-coefficients")
    preds = add_wide(predict(matrix, coefs, keep=[key, "split", target, *[w for w in wide if w not in others]]), table)
    return coefs, table, preds.select(C.col(key), "split", C.col(target), "prediction")


def train_job(df_raw: DataFrame, cfg: Mapping, split_method: str = "hash") -> TrainResult:
    """L3: clean → engineer → split → fit transformer on train → select → OLS → metrics.

    Every fit uses the train split only; the target and key stay in the row
    throughout, so nothing needs re-aligning.
    """
    key, target = cfg["key"], cfg["target"]
    seed = cfg.get("data_split", {}).get("random_state", 42)
    spec = cfg.get("engineering") or []
    df_raw = nan_to_null(df_raw)
    row_clean = C.row_local_clean(engineer(df_raw, spec) if spec else df_raw, cfg)
    buckets = 1000 if split_method == "arith" else 10_000
    # The upstream plan (scans, joins, projections) runs once; every later pass —
    # group means, transformer fit with F-scores, OLS, metrics — reads these files.
    # Only the columns the job uses are written (and so only those are scanned).
    used = C.select_columns(row_clean, [c for c in training_columns(cfg) if c in row_clean.columns])
    staged = materialize(split(used, key, split_fractions(cfg), seed=seed, buckets=buckets,
                               method=split_method), partition_by=["split"], name="train-input")
    means = C.fit_group_means(staged.where(F.col("split") == "train"), cfg)
    data, _ = C.impute_and_filter(staged, cfg, means)
    train = data.where(F.col("split") == "train")
    params, scores = fit_scored(train, cfg, target)
    k = cfg.get("selection", {}).get("k", 10)
    keep = cfg["features"].get("most_relevant_features", [])
    wide = wide_sources(params, keep, cfg.get("selection", {}).get("wide_from", WIDE_FROM))
    selected = select_k(scores, k, keep=keep, wide=wide)
    chosen = [r["feature"] for r in sorted(selected.collect(), key=lambda r: r["position"])]
    coefs, table, preds = _fit(train, data, params, chosen, wide, key, target, cfg.get("model", {}).get("active", "linear_regression"))
    preds = preds.withColumnRenamed(target, "y_true")
    metrics = regression_metrics(preds.where(F.col("split") != "train"), "y_true", "prediction",
                                 by="split", metrics=cfg.get("metrics"))
    return TrainResult(params, scores, selected, coefs, preds, metrics, chosen, means, table, data)


@dataclass
class TrainedModel:
    """What scoring needs of a training run."""
    params: DataFrame
    coefficients: DataFrame
    features: list
    group_means: DataFrame | None = None
    wide: DataFrame | None = None


def load_training(spark: SparkSession, out_dir: str) -> TrainedModel:
    """K8 (load): the fitted tables that :func:`save_training` wrote, for scoring in a new process."""
    def optional(name: str) -> DataFrame | None:
        return spark.read.parquet(f"{out_dir}/{name}") if R.exists(spark, f"{out_dir}/{name}") else None

    return TrainedModel(spark.read.parquet(f"{out_dir}/transformer"), spark.read.parquet(f"{out_dir}/model"),
                        R.read_feature_list(spark, f"{out_dir}/selected_features"), optional("group_means"), optional("wide_model"))


def save_training(result: TrainResult, out_dir: str) -> None:
    """Write every training artefact as a table."""
    if result.group_means is not None:
        K.write_params(result.group_means, f"{out_dir}/group_means")
    if result.wide is not None:
        K.write_params(result.wide, f"{out_dir}/wide_model")
    K.write_params(result.params, f"{out_dir}/transformer")
    K.write_params(result.coefficients, f"{out_dir}/model")
    K.write_params(result.selected, f"{out_dir}/selected_features")
    K.write_json(metrics_long(result.metrics, by="split"), f"{out_dir}/metrics")
    K.write_splits(result.predictions.withColumnRenamed("prediction", "y_pred"), f"{out_dir}/predictions")


def score_rows(df_raw: DataFrame, cfg: Mapping, params_rows: list, coef_rows: list, selected: list[str],
               group_means: DataFrame | None = None, wide: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """L4: every row with its ``prediction``, or with the ``reason`` why it has none (one plan over the input)."""
    keep = [cfg["key"], *[k for k in keep if k != cfg["key"]]]
    prepared = prepare_flagged(df_raw, cfg, group_means)
    missing = column_difference(prepared, sorted({r["source"] for r in params_rows}))
    if missing:
        raise KeyError(f"Columns required by the fitted transformer are missing: {missing}")
    sources = [] if wide is None else sorted(r["source"] for r in wide.select("source").distinct().collect())
    passed = [*keep, "_complete", *[s for s in sources if s not in keep]]
    matrix = prepared.select(*[C.col(c) for c in passed], *output_columns(params_rows))
    inputs = C.select_or_default(matrix, selected, default=0.0, keep=passed)
    scored = inputs.select(*[C.col(c) for c in passed], prediction_expr(coef_rows).alias("prediction"))
    if wide is not None:
        scored = add_wide(scored, wide)
    value = F.when(F.col("_complete"), F.col("prediction"))
    reason = F.when(~F.col("_complete"), F.lit(REMOVED)).when(F.col("prediction").isNull(), F.lit(NO_INPUT))
    return scored.select(*[C.col(k) for k in keep], value.alias("prediction"), reason.alias("reason"))


def score_batch(df_raw: DataFrame, cfg: Mapping, params: DataFrame, coefficients: DataFrame,
                selected: list[str] | None = None, require_rows: bool = False,
                group_means: DataFrame | None = None, wide: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """L4 batch: engineer → clean → transform → default absent features → predict.

    Returns ``(predictions (key, prediction), dropped (key, reason))``; a row removed by
    cleaning, or without a prediction because an input is missing, is reported instead of
    silently disappearing. ``require_rows`` (V9) raises when nothing is left to score after
    cleaning. ``group_means`` are those of the training run: a row's prediction never
    depends on the other rows of its batch. ``wide`` holds the coefficients of wide one-hot
    columns; a category it lacks adds nothing, as an all-zero encoding does.
    :func:`.runs.scoring_run` writes both in one pass over the input.
    """
    key = cfg["key"]
    coef_rows = coefficients.collect()
    if selected is None:
        selected = [r["term"] for r in coef_rows if r["term"] != "__intercept__"]
    rows = score_rows(df_raw, cfg, wanted_params(params, selected), coef_rows, selected, group_means, wide)
    if require_rows and rows.where(F.col("reason").isNull() | (F.col("reason") != REMOVED)).isEmpty():
        raise ValueError("No rows left to score after cleaning")
    return (rows.where(F.col("reason").isNull()).select(C.col(key), "prediction"),
            rows.where(F.col("reason").isNotNull()).select(C.col(key), "reason"))


def data_stage(spark: SparkSession, cfg: Mapping, root: str | None = None,
               out_root: str | None = None, df: DataFrame | None = None, profiles: bool = True) -> dict:
    """L2: read → validate → publish a new version → profile it (without ``out_root``: nothing is written)."""
    text = R.read_stage_text(spark, cfg, "raw", root=root) if df is None else df
    typed = R.declared_types if df is None else (lambda frame, _cfg: frame)
    dv = cfg.get("data_validation", {})
    declared = (dv.get("schema") or {}).get("columns") if dv.get("enabled", True) else None
    action = dv.get("action_on_error", "raise")
    report, out = None, {}
    if out_root:
        # One pass over the source: its rows are counted and checked (V3, V6) while they are
        # written. Only a version that passes is committed.
        aggregates, columns = V.conformance_counts(text, declared if declared and df is None else [])
        watch = Watch(*aggregates)
        raw = typed(watch.on(text), cfg)
        folder = K.stage(raw, out_root, "raw")
        counts = watch.get()
        if declared:
            rows = V.observed_report(raw, declared, counts, columns)
            report = spark.createDataFrame(rows, V.REPORT_SCHEMA)
            V.write_report(report, f"{out_root}/validation_report")
            try:
                V.apply_policy(rows, action, f"{out_root}/validation_report")
            except ValueError:
                K.discard(spark, out_root, folder)
                raise
        if not counts["n_rows"]:
            log.warning("raw data has no rows")
        out |= {"version": K.commit(spark, out_root, "raw", folder), "n_rows": counts["n_rows"]}
        # The profiles below read the published Parquet.
        raw = R.latest(spark, out_root, "raw", out["version"])
    else:
        raw = typed(text, cfg)
        V.require_non_empty(raw, "raw data")
        if declared:
            report = V.validate(raw, declared, action=action, text=text if df is None else None)
    if not profiles:
        return out | {"report": report}
    duplicates = P.duplicate_count(raw)
    out |= {
        "report": report,
        "duplicates": duplicates,
        "describe": P.describe_all(raw),
        "shape": duplicates.select("n_rows", F.lit(len(raw.columns)).cast("long").alias("n_cols"), "n_duplicates"),
        "sample": P.sample_rows(raw, 100, _raw_key(raw, cfg)),
    }
    return out


def _raw_key(raw: DataFrame, cfg: Mapping) -> str:
    """The key's column before renaming (the first column where the frame has neither name)."""
    renames = (cfg.get("preprocessing") or {}).get("rename_columns") or {}
    names = [cfg.get("key"), *[old for old, new in renames.items() if new == cfg.get("key")]]
    return next((n for n in names if n in raw.columns), raw.columns[0])


def append_manifest(df: DataFrame, path: str, job: str, metrics: DataFrame | None = None,
                    config: Mapping | None = None) -> str:
    """One row per run — id, job, input fingerprint, schema, row count, metrics."""
    spark = df.sparkSession
    run_id = uuid.uuid4().hex[:12]
    fp = P.fingerprint(df).first()
    schema = json.dumps({f.name: f.dataType.simpleString() for f in df.schema.fields})
    metric_json = json.dumps([r.asDict() for r in metrics.collect()]) if metrics is not None else None
    row = [(run_id, job, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), fp["n_rows"],
            fp["fingerprint"], schema, metric_json, json.dumps(config or {}, default=str))]
    spark.createDataFrame(
        row, "run_id string, job string, at timestamp_ntz, n_rows long, fingerprint string, "
             "schema string, metrics string, config string",
    ).write.mode("append").parquet(path)
    return run_id


DEFAULT_STEPS = ("data_load", "data_validation", "model", "evaluation", "inference")


def run(spark: SparkSession, cfg: Mapping, steps: str = "all",
        registry: Mapping[str, Callable] | None = None, state: dict | None = None) -> dict:
    """L1: run named steps in order; ``"all"`` means the default list."""
    names = list(DEFAULT_STEPS) if steps == "all" else [s.strip() for s in steps.split(",") if s.strip()]
    reg = dict(registry or default_steps())
    unknown = [s for s in names if s not in reg]
    if unknown:
        raise ValueError(f"Unknown step(s): {unknown}")
    state = dict(state or {})
    for name in names:
        log.info("step %s", name)
        state = reg[name](spark, cfg, state) or state
    return state


def default_steps() -> dict:
    # With a ``store`` folder in the configuration the steps write what they make (:mod:`.runs`): the
    # source is parsed, checked and published once, later steps read the published version, and
    # evaluation reads the saved predictions.
    def data_load(spark, cfg, st):
        if cfg.get("store"):
            out = data_stage(spark, cfg, root=cfg.get("root"), out_root=cfg["store"], df=st.get("raw"), profiles=False)
            st["report"], st["version"] = out["report"], out["version"]
            st["raw"] = R.latest(spark, cfg["store"], "raw", out["version"])
            return st
        if "raw" not in st:
            st["raw_text"] = R.read_stage_text(spark, cfg, "raw", root=cfg.get("root"))
            st["raw"] = R.declared_types(st["raw_text"], cfg)
        V.require_non_empty(st["raw"], "raw data")
        return st

    def data_validation(spark, cfg, st):
        dv = cfg.get("data_validation", {})
        if st.get("report") is None and dv.get("enabled", True) and dv.get("schema"):
            st["report"] = V.validate(st["raw"], dv["schema"]["columns"],
                                      action=dv.get("action_on_error", "raise"), text=st.get("raw_text"))
        return st

    def model(spark, cfg, st):
        if cfg.get("store"):
            from .runs import training_run
            st["train"] = training_run(st["raw"], cfg, cfg["store"], cfg.get("split_method", "hash"))
        else:
            st["train"] = train_job(st["raw"], cfg, cfg.get("split_method", "hash"))
        return st

    def evaluation(spark, cfg, st):
        if cfg.get("store"):
            from .runs import evaluation_run
            st["metrics"] = evaluation_run(spark, cfg["store"])
        else:
            st["metrics"] = st["train"].metrics
        return st

    def inference(spark, cfg, st):
        src = st.get("inference_input", st["raw"])
        if cfg.get("store"):
            from .runs import scored, scoring_run
            st["run"] = scoring_run(src, cfg, cfg["store"])
            st["predictions"], st["dropped"] = scored(spark, cfg["store"], cfg["key"], st["run"])
            return st
        t = st["train"]
        st["predictions"], st["dropped"] = score_batch(src, cfg, t.params, t.coefficients, t.features,
                                                       group_means=t.group_means, wide=t.wide)
        return st

    return {"data_load": data_load, "data_validation": data_validation, "model": model,
            "evaluation": evaluation, "inference": inference}
