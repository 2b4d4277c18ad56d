"""Registered queries of sources, sinks, committed runs and wide one-hot columns.

Each writes rows of the driver's tables through a sink, reads them back through a source, and
is compared with SQL over the tables themselves. Files go to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators import profile as P
from ..operators import sparse as S
from ..operators import validate as V
from ..operators.joins import align_counts, column_difference
from ..operators.metrics import metric_names, metrics_long, regression_metrics
from ..operators.model import predict
from ..operators.split import split
from ..operators.transform import PARAMS_SCHEMA, apply_transformer, fit_transformer
from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks as K
from ..streaming.scoring import committed, score_stream
from . import jobs, runs
from .catalog import (METRIC_SQL, MSE_DIGITS, OF_CTE, PRED_SQL, SPLIT_SQL, _cfg, _of, _order_contract, _predicted_orders, _with, register,
                      rounded)
from .views import table

ORDERS = [{"name": "o_orderkey", "dtype": "int", "required": True}, {"name": "o_custkey", "dtype": "int", "required": True},
          {"name": "o_orderstatus", "dtype": "str", "required": True}, {"name": "o_totalprice", "dtype": "float", "required": True},
          {"name": "o_orderpriority", "dtype": "str"}]
ORDER_NAMES = [c["name"] for c in ORDERS]
ORDERS_SQL = ("SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, "
              "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders")


def _orders(spark, d) -> DataFrame:
    """Orders with a text null in every ninth row."""
    o = table(spark, d, "orders").select(*ORDER_NAMES)
    return o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")))


def _source(path: str, **more) -> dict:
    return {"key": "o_orderkey", "data_source": {"raw_path": path, "type": "csv", "delimiter": ",", "header": 0, **more},
            "data_validation": {"enabled": True, "action_on_error": "raise", "schema": {"columns": ORDERS}}}


# ---- S: sources -----------------------------------------------------------------------------

@register("s1_csv_scan", ORDERS_SQL)
def q_s1(spark, d):
    """K1 → S1, S5: nulls are written as a null token, other delimiter."""
    path = scratch_path(spark, "csv")
    _orders(spark, d).fillna("NA", ["o_orderpriority"]).write.option("header", True).option("sep", ";").csv(path)
    return rounded(R.read_declared(spark, path, ORDERS, sep=";"))


@register("s1_header_row", ORDERS_SQL)
def q_s1h(spark, d):
    """Several files, each with two lines above its header."""
    path = scratch_path(spark, "header")
    lines = _orders(spark, d).fillna("NA", ["o_orderpriority"]).select(
        F.pmod(F.xxhash64("o_orderkey"), F.lit(5)).alias("file"), F.concat_ws(",", *ORDER_NAMES).alias("line"), F.lit(1).alias("at"))
    heads = spark.range(5).select(F.col("id").alias("file"), F.explode(F.array(
        F.struct(F.lit("exported table").alias("line"), F.lit(-3).alias("at")), F.struct(F.lit("second, line").alias("line"), F.lit(-2).alias("at")),
        F.struct(F.lit(",".join(ORDER_NAMES)).alias("line"), F.lit(-1).alias("at")))).alias("h")).select("file", "h.line", "h.at")
    (lines.unionByName(heads).repartition(5, "file").sortWithinPartitions("file", "at").select("line", "file")
     .write.partitionBy("file").text(path))
    return rounded(R.cast_to(R.normalise_nulls(R.read_table(spark, path, header=2)), ORDERS))


@register("s2_formats", "\nUNION ALL\n".join(f"SELECT '{f}' AS fmt, c_custkey, c_name, round(c_acctbal, 4) AS c_acctbal FROM customer"
                                            for f in ("json", "parquet", "orc")))
def q_s2(spark, d):
    base, out = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), None
    for fmt in ("json", "parquet", "orc"):
        path = scratch_path(spark, fmt)
        base.write.format(fmt).save(path)
        part = R.read_table(spark, path, fmt=fmt, schema=base.schema).select(F.lit(fmt).alias("fmt"), *base.columns)
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@register("s4_stage_source", ORDERS_SQL)
def q_s4(spark, d):
    """S3 + S4: the configured stage, its path relative to a root folder."""
    root = scratch_path(spark, "stage")
    K.write_csv(_orders(spark, d).fillna("null", ["o_orderpriority"]), f"{root}/in/orders")
    return rounded(R.read_stage(spark, _source("in/orders"), "raw", root=root))


@register("s6_infer_types", """
SELECT 'a' AS column_name, 'int' AS inferred UNION ALL SELECT 'b', 'float' UNION ALL SELECT 'c', 'float'
UNION ALL SELECT 'd', 'str' UNION ALL SELECT 'e', 'float'""")
def q_s6(spark, d):
    """Whole numbers; with fractions; whole with a null; text; all null."""
    key = F.col("o_orderkey")
    return R.infer_types(table(spark, d, "orders").select(
        key.cast("string").alias("a"), F.col("o_totalprice").cast("string").alias("b"),
        F.when(key != 1, key.cast("string")).alias("c"), F.col("o_orderstatus").alias("d"), F.lit(None).cast("string").alias("e")))


@register("s7_latest_version", """
SELECT 2 AS version, o_orderkey FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 1, o_orderkey FROM orders WHERE o_orderkey % 3 = 0""")
def q_s7(spark, d):
    """K2 → S7: the newest version, and an older one by number."""
    root, keys = scratch_path(spark, "versions"), table(spark, d, "orders").select("o_orderkey")
    K.publish(keys.where("o_orderkey % 3 = 0"), root, "raw")
    K.publish(keys.where("o_orderkey % 2 = 0"), root, "raw")
    K.stage(keys, root, "raw")  # never committed, never seen
    return (R.latest(spark, root, "raw").select(F.lit(R.latest_version(spark, root, "raw")).alias("version"), "o_orderkey")
            .unionByName(R.latest(spark, root, "raw", version=1).select(F.lit(1).alias("version"), "o_orderkey")))


@register("s9_feature_list", "SELECT 0 AS position, 'lines_cnt' AS feature UNION ALL SELECT 1, 'c acct.bal' UNION ALL SELECT 2, 'order_year'")
def q_s9(spark, d):
    """K9 → S9, over features that the orders view has."""
    path = scratch_path(spark, "features")
    have = _of(spark, d).withColumnRenamed("c_acctbal", "c acct.bal")
    wanted = ["lines_cnt", "c acct.bal", "order_year"]
    K.write_feature_list(spark, [w for w in wanted if w not in column_difference(have, wanted)], path)
    return K.feature_list_frame(spark, R.read_feature_list(spark, path))


@register("s11_saved_predictions", f"SELECT o_orderkey, {SPLIT_SQL} AS split, round(o_totalprice, 4) AS y_true, round(p, 4) AS y_pred FROM {PRED_SQL}")
def q_s11(spark, d):
    """K11 → S11."""
    path = scratch_path(spark, "predictions")
    K.write_splits(_split_predictions(spark, d), path)
    return rounded(R.read_predictions(spark, path).select("o_orderkey", F.col("split").cast("string").alias("split"), "y_true", "y_pred"))


def _split_predictions(spark, d) -> DataFrame:
    return (split(_predicted_orders(spark, d), "o_orderkey", seed=42, buckets=1000, method="arith")
            .select("o_orderkey", "split", F.col("o_totalprice").alias("y_true"), F.col("p").alias("y_pred")))


# ---- K: sinks -------------------------------------------------------------------------------

@register("k1_csv_quotes", """
SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS note FROM customer""")
def q_k1(spark, d):
    path = scratch_path(spark, "quotes")
    c = table(spark, d, "customer")
    K.write_csv(c.select("c_custkey", F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("note")), path)
    return R.read_table(spark, path).select(F.col("c_custkey").cast("long").alias("c_custkey"), "note")


@register("k3_split_roundtrip", f"""
WITH s AS (SELECT o_orderkey, o_totalprice, {SPLIT_SQL} AS split FROM orders)
SELECT o_orderkey, round(CASE WHEN split = 'test' THEN o_totalprice + 1 ELSE o_totalprice END, 4) AS o_totalprice, split FROM s
WHERE NOT (split = 'test' AND o_orderkey % 2 = 0)""")
def q_k3(spark, d):
    """K3 → S8: features and target by split under one version, one split replaced, the full table put together again."""
    root = scratch_path(spark, "splits")
    rows = split(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", seed=42, buckets=1000, method="arith")
    K.publish_splits(rows, root, "features")
    test = R.read_splits(spark, root, "features", ["test"])
    K.replace_split(test.where("o_orderkey % 2 != 0").withColumn("o_totalprice", F.col("o_totalprice") + 1).drop("split"), root, "features", "test")
    return rounded(R.read_full_or_splits(spark, root, "features"))


@register("k4_metrics_sink", f"""
WITH m AS (SELECT split, {METRIC_SQL} FROM (SELECT *, {SPLIT_SQL} AS split FROM {PRED_SQL}) GROUP BY split)
SELECT split, 'mse' AS metric, round(mse, 0) AS value FROM m UNION ALL SELECT split, 'mae', round(mae, 0) FROM m""")
def q_k4(spark, d):
    path = scratch_path(spark, "metrics")
    long = metrics_long(regression_metrics(_split_predictions(spark, d), "y_true", "y_pred", by="split", metrics=["MSE", "mae"]))
    K.write_json(long, path)
    return rounded(spark.read.schema(long.schema).json(path), MSE_DIGITS)


@register("k5_report_summary", "SELECT 'fail' AS status, 2::BIGINT AS error_count FROM (SELECT count(*) AS n FROM orders WHERE o_custkey IS NOT NULL) WHERE n > 0")
def q_k5(spark, d):
    """V5 → K5: one wrong type and one missing column."""
    path = scratch_path(spark, "report")
    declared = [*ORDERS[:1], {"name": "o_custkey", "dtype": "str"}, {"name": "absent", "dtype": "int", "required": True}]
    V.validate(table(spark, d, "orders"), declared, action="warn", report_path=path)
    return spark.read.schema("status string, error_count long").json(f"{path}_summary")


@register("k6_schema_snapshot", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c})::BIGINT AS n_non_null FROM nation" for c, t in
    (("n_nationkey", "bigint"), ("n_name", "string"), ("n_regionkey", "bigint"))))
def q_k6(spark, d):
    path = scratch_path(spark, "schema")
    info = P.column_info(table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name",
                                                         F.col("n_regionkey").cast("long").alias("n_regionkey")))
    K.write_json(info, path)
    return spark.read.schema(info.schema).json(path)


@register("k7_sample", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 50")
def q_k7(spark, d):
    path = scratch_path(spark, "sample")
    K.write_sample(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, "o_orderkey", n=50)
    return spark.read.parquet(path)


FIXED = [("lines_cnt", 2.5), ("order_year", -0.25)]
FIXED_SQL = "1000 + 2.5::DOUBLE * coalesce(lines_cnt, 0) - 0.25::DOUBLE * order_year"


def _fixed_model(spark) -> jobs.TrainedModel:
    """A model of known coefficients over unscaled inputs."""
    params = [(i, "scaler", c, f"scaler__{c}", None, None, "standard", 0.0, 1.0) for i, (c, _) in enumerate(FIXED)]
    coefs = [(i, f"scaler__{c}", w) for i, (c, w) in enumerate(FIXED)] + [(len(FIXED), "__intercept__", 1000.0)]
    return jobs.TrainedModel(spark.createDataFrame(params, PARAMS_SCHEMA),
                             spark.createDataFrame(coefs, "position int, term string, coefficient double"), [f"scaler__{c}" for c, _ in FIXED])


def _fixed_cfg() -> dict:
    cfg = _cfg()
    cfg["preprocessing"]["fillna_groupby"] = {}
    return cfg


@register("k8_model_reload", _with(OF_CTE) + f"SELECT o_orderkey, round({FIXED_SQL}, 4) AS prediction FROM of WHERE last_ship_year IS NOT NULL")
def q_k8(spark, d):
    """K8: parameters and coefficients written, committed, loaded, and used."""
    store, m = scratch_path(spark, "models"), _fixed_model(spark)
    K.write_params(m.params, f"{store}/model/one/transformer")
    K.write_params(m.coefficients, f"{store}/model/one/model")
    K.write_feature_list(spark, m.features, f"{store}/model/one/selected_features")
    K.commit(spark, store, "model", "model/one")
    run = runs.scoring_run(_of(spark, d).drop("o_totalprice"), _fixed_cfg(), store)
    return rounded(runs.scored(spark, store, "o_orderkey", run)[0])


@register("k10_predictions", _with(OF_CTE) + f"""
SELECT o_orderkey, round(CASE WHEN last_ship_year IS NOT NULL THEN {FIXED_SQL} END, 4) AS prediction,
       CASE WHEN last_ship_year IS NULL THEN 'removed by cleaning' END AS reason FROM of""")
def q_k10(spark, d):
    """L4 + K10: both outputs of a scoring run, read back from its folder."""
    store = scratch_path(spark, "scores")
    runs.scoring_run(_of(spark, d).drop("o_totalprice"), _fixed_cfg(), store, _fixed_model(spark))
    preds, dropped = runs.scored(spark, store, "o_orderkey")
    return rounded(preds.unionByName(dropped, allowMissingColumns=True).select("o_orderkey", "prediction", "reason"))


# ---- V: validation while writing ------------------------------------------------------------

@register("v4_error_policy", """
SELECT 'raise' AS action, count(*) FILTER (WHERE o_orderkey % 7 = 0)::BIGINT AS n_bad, 0 AS version FROM orders
UNION ALL SELECT 'warn', count(*) FILTER (WHERE o_orderkey % 7 = 0)::BIGINT, 1 FROM orders""")
def q_v4(spark, d):
    """The data stage on text with wrong values: ``raise`` commits nothing, ``warn`` commits."""
    path = scratch_path(spark, "bad")
    bad = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"))
    K.write_csv(bad, path)
    out = []
    for action in ("raise", "warn"):
        store = scratch_path(spark, "store")
        cfg = _source(path)
        cfg["data_validation"] |= {"action_on_error": action, "schema": {"columns": ORDERS[:2]}}
        try:
            jobs.data_stage(spark, cfg, out_root=store, profiles=False)
        except ValueError:
            pass
        failed = spark.read.json(f"{store}/validation_report").where("status = 'fail'").first()["message"]
        out.append((action, int(failed.split(": ")[1].split()[0]), R.latest_version(spark, store, "raw")))
    return spark.createDataFrame(out, "action string, n_bad long, version int")


@register("v6_rows_while_writing", """
SELECT 'all' AS name, count(*)::BIGINT AS n_rows, 1 AS version FROM orders UNION ALL SELECT 'none', 0, 1""")
def q_v6(spark, d):
    """Rows counted by the write of the data stage; an empty table is published with a warning."""
    out = []
    for name, cond in (("all", "true"), ("none", "false")):
        res = jobs.data_stage(spark, {"key": "o_orderkey", "data_validation": {"enabled": False}}, out_root=scratch_path(spark, "store"),
                              df=table(spark, d, "orders").where(cond), profiles=False)
        out.append((name, res["n_rows"], res["version"]))
    return spark.createDataFrame(out, "name string, n_rows long, version int")


@register("v9_nothing_to_score", _with(OF_CTE) + "SELECT count(*)::BIGINT AS n_rows, 0::BIGINT AS n_scored, false AS recorded FROM of WHERE last_ship_year IS NULL")
def q_v9(spark, d):
    """Every row is removed by cleaning: an error, and no run in the manifest."""
    store, of = scratch_path(spark, "empty"), _of(spark, d).where("last_ship_year is null")
    n_scored, n_rows = None, of.count()
    if n_rows:
        try:
            runs.scoring_run(of, _fixed_cfg(), store, _fixed_model(spark), require_rows=True)
        except ValueError:
            n_scored = 0
    return spark.createDataFrame([(n_rows, n_scored or 0, R.exists(spark, f"{store}/{runs.RUNS}"))], "n_rows long, n_scored long, recorded boolean")


# ---- R, J, U, L -----------------------------------------------------------------------------

@register("r6_metric_list", f"SELECT round(avg(abs(o_totalprice - p)), 4) AS mae, round(sqrt(avg((o_totalprice - p) * (o_totalprice - p))), 4) AS rmse, "
                            f"count(*)::BIGINT AS n FROM {PRED_SQL}")
def q_r6(spark, d):
    names = metric_names(["MAE", "Rmse"])
    return rounded(regression_metrics(_predicted_orders(spark, d), "o_totalprice", "p", metrics=names).select(*names, "n"))


@register("r7_reevaluate", f"""
WITH m AS (SELECT split, {METRIC_SQL} FROM (SELECT *, {SPLIT_SQL} AS split FROM {PRED_SQL}) GROUP BY split)
SELECT split, 'mae' AS metric, round(mae, 2) AS value FROM m UNION ALL SELECT split, 'rmse', round(rmse, 2) FROM m
UNION ALL SELECT split, 'r2', round(r2, 2) FROM m""")
def q_r7(spark, d):
    """A training run's predictions, evaluated again from its files."""
    store = scratch_path(spark, "evaluate")
    saved = _split_predictions(spark, d)
    K.write_splits(saved, f"{store}/train/one/predictions")
    runs.record_run(spark, store, "one", "train", "train/one", "{}", {"n_rows": None}, {})
    return rounded(runs.evaluation_run(spark, store).where("metric != 'mse'"), 2)


@register("j2_align_strict", """
WITH a AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 <> 0),
b AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 11 = 0),
g AS (SELECT k, sum(na) AS na, sum(nb) AS nb FROM (SELECT k, 1 AS na, 0 AS nb FROM a UNION ALL SELECT k, 0, 1 FROM b) GROUP BY k)
SELECT count(*) FILTER (WHERE na = 1 AND nb = 1)::BIGINT AS n_matched, count(*) FILTER (WHERE nb = 0)::BIGINT AS only_a,
       count(*) FILTER (WHERE na = 0)::BIGINT AS only_b, count(*) FILTER (WHERE na > 1)::BIGINT AS dup_a,
       count(*) FILTER (WHERE nb > 1)::BIGINT AS dup_b, count(*) FILTER (WHERE NOT (na = 1 AND nb = 1))::BIGINT AS bad FROM g""")
def q_j2(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    b = o.where("o_orderkey % 7 != 0").unionByName(o.where("o_orderkey % 11 = 0")).withColumnRenamed("o_totalprice", "prediction")
    return align_counts(o.where("o_orderkey % 10 != 0"), b, "o_orderkey")


@register("l4_stream_rows", _with(OF_CTE) + f"SELECT o_orderkey, round({FIXED_SQL}, 4) AS prediction FROM of WHERE last_ship_year IS NOT NULL")
def q_l4r(spark, d):
    """Records in several files, scored in several micro-batches; the committed rows."""
    root, inputs = scratch_path(spark, "stream"), _of(spark, d).drop("o_totalprice")
    inputs.select(F.to_json(F.struct(*[col(c) for c in inputs.columns])).alias("value")).repartition(3).write.text(f"{root}/in")
    m = _fixed_model(spark)
    score_stream(spark, _fixed_cfg(), _order_contract(inputs), f"{root}/in", m.params, m.coefficients, f"{root}/out", f"{root}/rejected",
                 f"{root}/checkpoint", max_files=2).awaitTermination()
    return rounded(committed(spark, f"{root}/out", f"{root}/rejected")[0].select("o_orderkey", "prediction"))


@register("l5_run_counts", _with(OF_CTE) + f"""
SELECT count(*)::BIGINT AS n_rows, count(last_ship_year)::BIGINT AS n_scored, (count(*) - count(last_ship_year))::BIGINT AS n_removed,
       0::BIGINT AS n_no_input, 0::BIGINT AS n_not_finite, round(avg(p), 4) AS mean, round(min(p), 4) AS min, round(max(p), 4) AS max
FROM (SELECT *, CASE WHEN last_ship_year IS NOT NULL THEN {FIXED_SQL} END AS p FROM of)""")
def q_l5r(spark, d):
    """The manifest row of a scoring run: its counts were taken while its rows were written."""
    store = scratch_path(spark, "counts")
    runs.scoring_run(_of(spark, d).drop("o_totalprice"), _fixed_cfg(), store, _fixed_model(spark))
    fields = "n_rows long, n_scored long, n_removed long, n_no_input long, n_not_finite long, mean double, min double, max double"
    return rounded(runs.runs(spark, store).select(F.from_json("counts", fields).alias("c")).select("c.*"))


# ---- M: wide one-hot columns ----------------------------------------------------------------

def _wide(spark, d) -> tuple[DataFrame, DataFrame]:
    """Orders with a one-hot column per customer, and the fitted transformer (names are text in SQL order)."""
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), F.lpad(F.col("o_custkey").cast("string"), 12, "0")).alias("cust"),
                                         F.col("o_orderkey").cast("double").alias("x"), "o_totalprice")
    cfg = {"features": {"categorical": ["cust"], "continuous": ["x"]},
           "preprocessing": {"encoding": {"one_hot": {"drop": "first", "handle_unknown": "ignore"}},
                             "scaling": {"method": "minmax", "apply_to": ["continuous"]}}}
    return o, fit_transformer(o, cfg)


WIDE_CTE = """
o AS (SELECT o_orderkey, 'c' || lpad(o_custkey::VARCHAR, 12, '0') AS cust, o_totalprice AS y,
             (o_orderkey - (SELECT min(o_orderkey) FROM orders))::DOUBLE / (SELECT max(o_orderkey) - min(o_orderkey) FROM orders) AS x FROM orders),
cat AS (SELECT cust, row_number() OVER (ORDER BY cust) - 2 AS pos FROM (SELECT DISTINCT cust FROM o))"""


@register("m15_sparse_design", _with(WIDE_CTE) + """
SELECT o_orderkey, pos::BIGINT AS pos, 1.0::DOUBLE AS value FROM o JOIN cat USING (cust) WHERE pos >= 0
UNION ALL SELECT o_orderkey, (SELECT max(pos) + 1 FROM cat)::BIGINT, round(x, 4) FROM o""")
def q_m15s(spark, d):
    """Every entry of the sparse design: one column per customer (the first dropped), then the scaled number."""
    o, params = _wide(spark, d)
    design = S.sparse_design(o, S.feature_index(params), keep=["o_orderkey"])
    return rounded(design.select("o_orderkey", F.explode(F.arrays_zip("indices", "values")).alias("e"))
                   .select("o_orderkey", F.col("e.indices").alias("pos"), F.col("e.values").alias("value")))


WIDE_FIT = _with(WIDE_CTE, """
g AS (SELECT cust, avg(x) AS mx, avg(y) AS my FROM o GROUP BY cust),
b AS (SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS b FROM o JOIN g USING (cust)),
l AS (SELECT cust, pos, my - b * mx AS level FROM g JOIN cat USING (cust), b),
i AS (SELECT level AS i FROM l WHERE pos = -1)""")


@register("m13_wide_onehot", WIDE_FIT + """
SELECT 'scaler__x' AS term, round(b, 2) AS coefficient FROM b UNION ALL SELECT '__intercept__', round(i, 2) FROM i
UNION ALL SELECT 'onehot__cust_' || cust, round(level - i, 2) FROM l, i WHERE pos >= 0""")
def q_m13w(spark, d):
    """Least squares with a column per customer, by sums within customers."""
    o, params = _wide(spark, d)
    narrow = apply_transformer(o, params, keep=["cust", "o_totalprice"], outputs=["scaler__x"])
    coefs, wide = S.fit_absorbed(narrow, ["scaler__x"], "cust", params, "o_totalprice")
    return rounded(coefs.select("term", "coefficient").unionByName(wide.select(F.col("output").alias("term"), "coefficient")), 2)


@register("m14_wide_predict", WIDE_FIT + """
SELECT o_orderkey, round(b * x + level, 1) AS prediction FROM o JOIN l USING (cust), b""")
def q_m14w(spark, d):
    o, params = _wide(spark, d)
    narrow = apply_transformer(o, params, keep=["o_orderkey", "cust", "o_totalprice"], outputs=["scaler__x"])
    coefs, wide = S.fit_absorbed(narrow, ["scaler__x"], "cust", params, "o_totalprice")
    preds = S.add_wide(predict(narrow, coefs, keep=["o_orderkey", "cust"]), wide)
    return rounded(preds.select("o_orderkey", "prediction"), 1)


# ---- L: whole jobs with a closed form -------------------------------------------------------

def _closed_cfg() -> dict:
    """The training flow on two numeric inputs: scaling leaves the predictions as they are."""
    cfg = _cfg()
    cfg["features"] = {"continuous": ["c_acctbal"], "ordinal": ["lines_cnt"], "most_relevant_features": []}
    cfg["engineering"] = []
    cfg["preprocessing"] |= {"fillna": {}, "fillna_groupby": {}, "encoding": {}}
    cfg["selection"] = {"k": 2}
    return cfg


CLOSED_CTE = _with(OF_CTE, f"""
cl AS (SELECT *, {SPLIT_SQL} AS split FROM of WHERE last_ship_year IS NOT NULL),
s AS (SELECT covar_pop(c_acctbal, c_acctbal) AS s11, covar_pop(lines_cnt, lines_cnt) AS s22, covar_pop(c_acctbal, lines_cnt) AS s12,
             covar_pop(c_acctbal, o_totalprice) AS s1y, covar_pop(lines_cnt, o_totalprice) AS s2y, avg(c_acctbal) AS m1, avg(lines_cnt) AS m2,
             avg(o_totalprice) AS my FROM cl WHERE split = 'train'),
b AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM s),
pr AS (SELECT o_orderkey, split, o_totalprice AS y, my + b1 * (c_acctbal - m1) + b2 * (lines_cnt - m2) AS p FROM cl, b)""")


@register("l1_run_steps", CLOSED_CTE + """
SELECT split, 'mae' AS metric, round(avg(abs(y - p)), 2) AS value FROM pr GROUP BY split
UNION ALL SELECT split, 'rmse', round(sqrt(avg((y - p) * (y - p))), 2) FROM pr GROUP BY split""")
def q_l1(spark, d):
    """Steps by name, writing to a store: trained on the train split, evaluated from the saved predictions of every split."""
    cfg = {**_closed_cfg(), "store": scratch_path(spark, "steps"), "split_method": "arith"}
    state = jobs.run(spark, cfg, "model,evaluation", state={"raw": _of(spark, d)})
    return rounded(state["metrics"].where("metric in ('mae', 'rmse')"), 2)


@register("l2_data_stage", """
SELECT count(*)::BIGINT AS n_rows, 5::BIGINT AS n_cols, 0::BIGINT AS n_duplicates, 1 AS version, 0::BIGINT AS n_errors FROM orders""")
def q_l2(spark, d):
    """CSV → null tokens, declared types, checks and counts while it is written → committed version → shape."""
    path, store = scratch_path(spark, "csv"), scratch_path(spark, "store")
    K.write_csv(_orders(spark, d).fillna("NA", ["o_orderpriority"]), path)
    out = jobs.data_stage(spark, _source(path), out_root=store)
    errors = out["report"].agg(F.count_if(F.col("status") == "fail").alias("n_errors"))
    return out["shape"].select("*", F.lit(out["version"]).alias("version"), F.lit(errors.first()[0]).cast("long").alias("n_errors"))


@register("l3_closed_form", CLOSED_CTE + "SELECT o_orderkey, split, round(y, 4) AS y_true, round(p, 1) AS prediction FROM pr")
def q_l3c(spark, d):
    """The whole training job; every row keeps its own target."""
    t = jobs.train_job(_of(spark, d), _closed_cfg(), split_method="arith")
    return rounded(t.predictions.select("o_orderkey", F.col("split").cast("string").alias("split"), "y_true", "prediction"), 4, {"prediction": 1})


@register("l4_closed_form", CLOSED_CTE + ", all_rows AS (SELECT o_orderkey, my + b1 * (c_acctbal - m1) + b2 * (lines_cnt - m2) AS p FROM of, b WHERE last_ship_year IS NOT NULL)\n"
          "SELECT o_orderkey, round(p, 1) AS prediction FROM all_rows")
def q_l4c(spark, d):
    """Training run, model committed; scoring run with the reloaded model."""
    store = scratch_path(spark, "closed")
    of = _of(spark, d)
    runs.training_run(of, _closed_cfg(), store, split_method="arith")
    run = runs.scoring_run(of.drop("o_totalprice"), _closed_cfg(), store)
    return rounded(runs.scored(spark, store, "o_orderkey", run)[0], 1)
