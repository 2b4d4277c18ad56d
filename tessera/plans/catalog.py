"""Registered queries: each operator of the inventory run over the driver's tables.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame built only from the
package's operators; ``ORACLE[name]`` is an independent SQL statement over the
same tables (DuckDB dialect). Every double in an output is rounded to
``DIGITS`` decimals on both sides, because the two engines add floating-point
numbers in different orders.
"""

from __future__ import annotations

import copy

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ORDER_FEATURES
from ..functions.columns import PANDAS_NULL_TOKENS, col
from ..operators import clean as C
from ..operators import profile as P
from ..operators import validate as V
from ..operators.features import difference, engineer, weighted_sum
from ..operators.joins import align, dropped_keys, union_splits
from ..operators.metrics import regression_metrics
from ..operators.model import fit_linear, predict
from ..operators.select import f_scores, select_k, top_k
from ..operators.split import split
from ..operators.transform import apply_transformer, fit_scored, fit_transformer
from ..sources.readers import cast_to, normalise_nulls
from ..sources.records import tag_records
from ..session import scratch_path
from ..streaming.scoring import score_stream
from . import jobs
from .views import doc_labels, order_features, orders_text, table

DIGITS = 4
# Model predictions: Spark's solver and the SQL closed form agree to ~1e-8 absolute on
# values near 2.5e5, so one decimal keeps a rounding edge from splitting them.
PREDICTION_DIGITS = 1


# Squared errors of prices reach ~1e9: whole units keep nine significant digits, which
# stays far above the ~1e-14 relative noise of different summation orders.
MSE_DIGITS = 0


def rounded(df: DataFrame, digits: int = DIGITS, per_column: dict | None = None) -> DataFrame:
    """Round every double column (sum order differs between engines); ``-0.0`` becomes ``0.0``."""
    per_column = per_column or {}
    return df.select(*[
        ((F.round(col(f.name), per_column.get(f.name, digits)) + F.lit(0.0)).alias(f.name)
         if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else col(f.name))
        for f in df.schema.fields])


def _sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


# ---------------------------------------------------------------------------------------------
# Shared SQL views (DuckDB) mirroring tessera.plans.views
# ---------------------------------------------------------------------------------------------

OF_CTE = """
lt AS (
  SELECT l_orderkey, sum(l_quantity) AS lines_qty, sum(l_extendedprice) AS lines_value,
         count(*)::BIGINT AS lines_cnt,
         CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN 'R' ELSE 'N' END AS lines_flag,
         year(max(l_shipdate))::BIGINT AS last_ship_year
  FROM lineitem GROUP BY l_orderkey),
of AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
         year(o.o_orderdate)::BIGINT AS order_year, c.c_acctbal, c.c_mktsegment, n.n_name,
         lt.lines_qty, lt.lines_value, lt.lines_cnt, lt.lines_flag, lt.last_ship_year
  FROM orders o LEFT JOIN lt ON o.o_orderkey = lt.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

OF_COLUMNS = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderpriority", "string"), ("order_year", "bigint"),
    ("c_acctbal", "double"), ("c_mktsegment", "string"), ("n_name", "string"),
    ("lines_qty", "double"), ("lines_value", "double"), ("lines_cnt", "bigint"),
    ("lines_flag", "string"), ("last_ship_year", "bigint"),
]

DL_CTE = """
dl AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
DL_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]

TOKENS_SQL = _sql_list(PANDAS_NULL_TOKENS)

# Raw text form of orders (tessera.plans.views.orders_text) after null tokens are removed.
OT_CTE = f"""
ot_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         CASE WHEN o_orderkey % 10 = 0 THEN 'NA' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_totalprice AS VARCHAR)
              ELSE CAST(o_custkey AS VARCHAR) END AS o_items,
         CAST(o_totalprice AS VARCHAR) AS o_totalprice,
         o_orderstatus
  FROM orders),
ot AS (
  SELECT CASE WHEN o_orderkey IN ({TOKENS_SQL}) THEN NULL ELSE o_orderkey END AS o_orderkey,
         CASE WHEN o_custkey IN ({TOKENS_SQL}) THEN NULL ELSE o_custkey END AS o_custkey,
         CASE WHEN o_items IN ({TOKENS_SQL}) THEN NULL ELSE o_items END AS o_items,
         CASE WHEN o_totalprice IN ({TOKENS_SQL}) THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderstatus IN ({TOKENS_SQL}) THEN NULL ELSE o_orderstatus END AS o_orderstatus
  FROM ot_raw)"""


def _sql_int(x: str) -> str:
    """Text → BIGINT with the package's rule: integer text, or a whole number."""
    return (f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS BIGINT) "
            f"WHEN TRY_CAST({x} AS DOUBLE) = floor(TRY_CAST({x} AS DOUBLE)) "
            f"THEN TRY_CAST(TRY_CAST({x} AS DOUBLE) AS BIGINT) END")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# Split used by the SQL-checked queries: (key mod 1000003 · 7919 + 42 · 104729) mod 1000.
SPLIT_SQL = ("CASE WHEN ((o_orderkey % 1000003) * 7919 + 42 * 104729) % 1000 < 600 THEN 'train' "
             "WHEN ((o_orderkey % 1000003) * 7919 + 42 * 104729) % 1000 < 800 THEN 'valid' "
             "ELSE 'test' END")


def _of(spark, d):
    return order_features(spark, d)


def _cfg() -> dict:
    return copy.deepcopy(ORDER_FEATURES)


QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------------------------
# P — profiling
# ---------------------------------------------------------------------------------------------

@register("p1_duplicate_rows", """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT sum(c)::BIGINT AS n_rows, count(*)::BIGINT AS n_distinct, sum(c - 1)::BIGINT AS n_duplicates,
       sum(c - 1) > 0 AS has_duplicates FROM g""")
def q_p1(spark, d):
    return P.duplicate_count(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@register("p2_any_duplicates", """
WITH g AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
                  count(*) AS c FROM orders GROUP BY ALL)
SELECT sum(c)::BIGINT AS n_rows, count(*)::BIGINT AS n_distinct, sum(c - 1)::BIGINT AS n_duplicates,
       sum(c - 1) > 0 AS has_duplicates FROM g""")
def q_p2(spark, d):
    return P.duplicate_count(table(spark, d, "orders"))


def _describe_num_sql(tbl: str, cols: list[str], cte: str = "") -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, count({c})::BIGINT AS count, round(avg({c}), 4) AS mean, "
            f"round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min, "
            f"round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, "
            f"round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c})::DOUBLE, 4) AS max FROM {tbl}")
    return cte + "\nUNION ALL\n".join(parts)


P3_NUM = ["o_orderkey", "o_custkey", "o_totalprice"]


@register("p3_describe_numeric", _describe_num_sql("orders", P3_NUM))
def q_p3n(spark, d):
    out = P.describe_all(table(spark, d, "orders"), P3_NUM)
    return rounded(out.select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


@register("p3_describe_numeric_nulls", _describe_num_sql(
    "of", ["lines_qty", "lines_value", "lines_cnt", "last_ship_year", "c_acctbal"], _with(OF_CTE)))
def q_p3nn(spark, d):
    out = P.describe_all(_of(spark, d), ["lines_qty", "lines_value", "lines_cnt", "last_ship_year", "c_acctbal"],
                         materialize_input=True)
    return rounded(out.select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def _describe_cat_sql(tbl: str, cols: list[str], cte: str = "") -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, sum(cnt)::BIGINT AS count, count(*)::BIGINT AS unique, "
            f"arg_min(v, (-cnt, v)) AS top, max(cnt)::BIGINT AS freq "
            f"FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS cnt FROM {tbl} "
            f"WHERE {c} IS NOT NULL GROUP BY 1)")
    return cte + "\nUNION ALL\n".join(parts)


P3_CAT = ["c_mktsegment", "c_name"]


@register("p3_describe_categorical", _describe_cat_sql("customer", P3_CAT))
def q_p3c(spark, d):
    out = P.describe_all(table(spark, d, "customer"), P3_CAT)
    return out.select("column_name", "count", "unique", "top", "freq")


@register("p1_duplicate_documents", """
WITH g AS (SELECT text, count(*) AS c FROM documents GROUP BY text)
SELECT sum(c)::BIGINT AS n_rows, count(*)::BIGINT AS n_distinct, sum(c - 1)::BIGINT AS n_duplicates,
       sum(c - 1) > 0 AS has_duplicates FROM g""")
def q_p1d(spark, d):
    """Exact copies among whole document texts (P1 on the text column)."""
    return P.duplicate_count(table(spark, d, "documents").select("text"))


@register("p3_describe_events", _describe_num_sql("events", ["value", "user_id", "event_id"]))
def q_p3e(spark, d):
    out = P.describe_all(table(spark, d, "events"), ["value", "user_id", "event_id"])
    return rounded(out.select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


@register("p3_describe_text_columns", _describe_cat_sql("events", ["event_type"]) + "\nUNION ALL\n" +
          _describe_cat_sql("conversations", ["role"]) + "\nUNION ALL\n" + _describe_cat_sql("documents", ["lang", "source"]))
def q_p3t(spark, d):
    parts = [P.describe_all(table(spark, d, "events"), ["event_type"]),
             P.describe_all(table(spark, d, "conversations"), ["role"]),
             P.describe_all(table(spark, d, "documents"), ["lang", "source"])]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("column_name", "count", "unique", "top", "freq")


@register("p13_histogram_events", """
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
h AS (SELECT least(floor((value - lo) / (hi - lo) * 20)::BIGINT, 19) AS bucket, lo, hi FROM events, b)
SELECT bucket, round(any_value(lo) + bucket * ((any_value(hi) - any_value(lo)) / 20), 4) AS lower,
       round(any_value(lo) + (bucket + 1) * ((any_value(hi) - any_value(lo)) / 20), 4) AS upper,
       count(*)::BIGINT AS n
FROM h GROUP BY bucket""")
def q_p13e(spark, d):
    return rounded(P.histogram(table(spark, d, "events"), "value", bins=20))


def _null_counts_sql(tbl: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, (count(*) - count({c}))::BIGINT AS n_null, count(*)::BIGINT AS n_rows "
        f"FROM {tbl}" for c in cols)


OF_NAMES = [c for c, _ in OF_COLUMNS]


@register("p4_null_counts", _with(OF_CTE) + _null_counts_sql("of", OF_NAMES))
def q_p4(spark, d):
    return P.null_counts(_of(spark, d))


@register("p5_percent_missing", _with(DL_CTE) + f"""
SELECT column_name, n_null, round(100.0 * n_null / n_rows, 4) AS pct FROM (
{_null_counts_sql("dl", DL_COLUMNS)}) WHERE 100.0 * n_null / n_rows > 0""")
def q_p5(spark, d):
    return rounded(P.missing_profile(doc_labels(spark, d), above=0.0))


@register("p6_missing_threshold", _with(OF_CTE) + f"""
SELECT column_name, n_null, round(100.0 * n_null / n_rows, 4) AS pct FROM (
{_null_counts_sql("of", OF_NAMES)}) WHERE 100.0 * n_null / n_rows < 1.0""")
def q_p6(spark, d):
    return rounded(P.missing_profile(_of(spark, d), above=None, below=1.0))


@register("p7_total_nulls", _with(DL_CTE) + f"""
SELECT sum(n_null)::BIGINT AS total_nulls FROM ({_null_counts_sql("dl", DL_COLUMNS)})""")
def q_p7(spark, d):
    return P.total_nulls(doc_labels(spark, d))


@register("p8_shape", """
WITH g AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
                  count(*) AS c FROM orders GROUP BY ALL)
SELECT sum(c)::BIGINT AS n_rows, 6::BIGINT AS n_cols, sum(c - 1)::BIGINT AS n_duplicates FROM g""")
def q_p8(spark, d):
    return P.shape(table(spark, d, "orders"))


@register("p8_column_info", _with(OF_CTE) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c})::BIGINT AS n_non_null FROM of"
    for c, t in OF_COLUMNS))
def q_p8c(spark, d):
    return P.column_info(_of(spark, d))


@register("p9_fingerprint")
def q_p9(spark, d):
    return P.fingerprint(table(spark, d, "orders"))


def _scoring_view(of: DataFrame) -> DataFrame:
    """The scoring-time shape of order_features: no target, a retyped and a new column."""
    cleaned = C.drop_null_rows(of, ["last_ship_year"])
    return (difference(cleaned, "ship_lag", "last_ship_year", "order_year")
            .drop("o_totalprice").withColumn("lines_cnt", F.col("lines_cnt").cast("double")))


_CUR_COLUMNS = [(c, "double" if c == "lines_cnt" else t) for c, t in OF_COLUMNS if c != "o_totalprice"] + \
    [("ship_lag", "bigint")]


@register("p10_schema_drift", _with(OF_CTE, """
cur AS (SELECT *, last_ship_year - order_year AS ship_lag FROM of WHERE last_ship_year IS NOT NULL)""",
                                      "\nref_info AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS ref_dtype, count({c})::BIGINT AS ref_non_null FROM of"
    for c, t in OF_COLUMNS) + ")", "\ncur_info AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS cur_dtype, count({c})::BIGINT AS cur_non_null FROM cur"
    for c, t in _CUR_COLUMNS) + ")") + """
SELECT coalesce(r.column_name, c.column_name) AS column_name, ref_dtype, cur_dtype, ref_non_null, cur_non_null,
       CASE WHEN ref_dtype IS NULL THEN 'added' WHEN cur_dtype IS NULL THEN 'removed'
            WHEN ref_dtype <> cur_dtype THEN 'type_changed' ELSE 'same' END AS status
FROM ref_info r FULL OUTER JOIN cur_info c ON r.column_name = c.column_name""")
def q_p10(spark, d):
    of = _of(spark, d)
    return P.schema_drift(P.column_info(of), P.column_info(_scoring_view(of)))


@register("p11_sample", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50")
def q_p11(spark, d):
    return P.sample_rows(table(spark, d, "orders"), 50, "o_orderkey")


@register("t3_head", "SELECT * FROM customer ORDER BY c_custkey LIMIT 100")
def q_t3(spark, d):
    return P.sample_rows(table(spark, d, "customer"), 100, "c_custkey")


@register("p12_mean", _with(OF_CTE) + "SELECT round(avg(o_totalprice), 4) AS mean FROM of")
def q_p12(spark, d):
    return rounded(P.mean_of(_of(spark, d), "o_totalprice"))


@register("p13_histogram", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
h AS (SELECT least(floor((o_totalprice - lo) / (hi - lo) * 10)::BIGINT, 9) AS bucket, lo, hi
      FROM orders, b)
SELECT bucket, round(any_value(lo) + bucket * ((any_value(hi) - any_value(lo)) / 10), 4) AS lower,
       round(any_value(lo) + (bucket + 1) * ((any_value(hi) - any_value(lo)) / 10), 4) AS upper,
       count(*)::BIGINT AS n
FROM h GROUP BY bucket""")
def q_p13(spark, d):
    return rounded(P.histogram(table(spark, d, "orders"), "o_totalprice", bins=10))


@register("p14_one_row_pct", "SELECT round(100.0 / count(*), 4) AS one_row_pct FROM orders")
def q_p14(spark, d):
    return rounded(P.one_row_pct(table(spark, d, "orders")))


@register("p15_null_rows", _with(OF_CTE) + """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, o_orderpriority,
       order_year, round(c_acctbal, 4) AS c_acctbal, c_mktsegment, n_name, round(lines_qty, 4) AS lines_qty,
       round(lines_value, 4) AS lines_value, lines_cnt, lines_flag, last_ship_year
FROM of WHERE lines_qty IS NULL""")
def q_p15(spark, d):
    return rounded(P.null_rows(_of(spark, d), "lines_qty"))


@register("p16_prediction_summary", """
SELECT count(*)::BIGINT AS n_rows, 3::BIGINT AS n_cols, round(avg(0.9 * o_totalprice + 1000), 4) AS mean,
       round(min(0.9 * o_totalprice + 1000), 4) AS min, round(max(0.9 * o_totalprice + 1000), 4) AS max
FROM orders""")
def q_p16(spark, d):
    preds = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", (F.lit(0.9) * F.col("o_totalprice") + F.lit(1000.0)).alias("prediction"))
    return rounded(P.prediction_summary(preds))


# ---------------------------------------------------------------------------------------------
# F / W — cleaning
# ---------------------------------------------------------------------------------------------

@register("f1_rename_drop", """
SELECT c_custkey, c_name AS name, c_acctbal AS balance, c_mktsegment FROM customer""")
def q_f1(spark, d):
    df = C.rename(table(spark, d, "customer"), {"c_name": "name", "c_acctbal": "balance", "absent": "x"})
    df = C.drop(df, ["c_nationkey", "not_a_column"])
    return C.select_columns(df, ["c_custkey", "name", "balance", "c_mktsegment"])


@register("f3_fill_zero", _with(OF_CTE) + """
SELECT o_orderkey, round(coalesce(lines_qty, 0), 4) AS lines_qty, coalesce(lines_cnt, 0) AS lines_cnt,
       round(lines_value, 4) AS lines_value FROM of""")
def q_f3(spark, d):
    df = C.fill_zero(_of(spark, d), ["lines_qty", "lines_cnt", "absent_col"])
    return rounded(df.select("o_orderkey", "lines_qty", "lines_cnt", "lines_value"))


@register("f4_fill_none", _with(OF_CTE) + """
SELECT o_orderkey, coalesce(lines_flag, 'None') AS lines_flag, c_mktsegment FROM of""")
def q_f4(spark, d):
    df = C.fill_label(_of(spark, d), ["lines_flag", "c_mktsegment", "absent_col"])
    return df.select("o_orderkey", "lines_flag", "c_mktsegment")


@register("f5_drop_null_rows", _with(OF_CTE) + """
SELECT o_orderkey, last_ship_year, lines_cnt FROM of WHERE last_ship_year IS NOT NULL""")
def q_f5(spark, d):
    df = C.drop_null_rows(_of(spark, d), ["last_ship_year", "absent_col"])
    return df.select("o_orderkey", "last_ship_year", "lines_cnt")


@register("f6_clean", _with(OF_CTE, """
filled AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, order_year, c_acctbal,
         coalesce(c_mktsegment, 'None') AS c_mktsegment, n_name,
         coalesce(lines_qty, 0) AS lines_qty,
         coalesce(lines_value, avg(lines_value) OVER (PARTITION BY n_name)) AS lines_value,
         coalesce(lines_cnt, 0) AS lines_cnt, lines_flag, last_ship_year
  FROM of)""") + """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice, o_orderpriority,
       order_year, round(c_acctbal, 4) AS c_acctbal, c_mktsegment, n_name, round(lines_qty, 4) AS lines_qty,
       round(lines_value, 4) AS lines_value, lines_cnt, lines_flag, last_ship_year
FROM filled WHERE last_ship_year IS NOT NULL""")
def q_f6(spark, d):
    return rounded(C.clean(_of(spark, d), _cfg()))


@register("f7_outliers", _with(OF_CTE) + """
SELECT o_orderkey, round(o_totalprice, 4) AS o_totalprice, round(lines_value, 4) AS lines_value FROM of
WHERE NOT coalesce(lines_value > 300000 AND o_totalprice < 100000, false)""")
def q_f7(spark, d):
    of = _of(spark, d)
    out = C.exclude(of, (F.col("lines_value") > 300000) & (F.col("o_totalprice") < 100000))
    return rounded(out.select("o_orderkey", "o_totalprice", "lines_value"))


@register("f9_default_absent", _with(OF_CTE) + """
SELECT o_orderkey, round(o_totalprice, 4) AS o_totalprice, round(c_acctbal, 4) AS c_acctbal,
       0.0::DOUBLE AS missing_feature FROM of""")
def q_f9(spark, d):
    out = C.select_or_default(_of(spark, d), ["o_totalprice", "c_acctbal", "missing_feature"],
                              keep=["o_orderkey"])
    return rounded(out)


@register("f11_by_type", _with(OF_CTE) + """
SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice, order_year, round(c_acctbal, 4) AS c_acctbal,
       round(lines_qty, 4) AS lines_qty, round(lines_value, 4) AS lines_value, lines_cnt, last_ship_year FROM of""")
def q_f11(spark, d):
    return rounded(C.by_type(_of(spark, d), "numeric"))


@register("f11_by_type_text", _with(OF_CTE) + """
SELECT o_orderstatus, o_orderpriority, c_mktsegment, n_name, lines_flag FROM of""")
def q_f11t(spark, d):
    return C.by_type(_of(spark, d), "text")


@register("f12_cast_code", """
SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""")
def q_f12(spark, d):
    return C.as_label(table(spark, d, "nation"), ["n_regionkey"])


@register("f14_drop_sparse_cols", _with(DL_CTE) + "SELECT doc_id, lang, source, n_chars FROM dl")
def q_f14(spark, d):
    return C.drop_sparse(doc_labels(spark, d), max_pct=50.0)


@register("w1_group_mean_impute", _with(OF_CTE) + """
SELECT o_orderkey, n_name,
       round(coalesce(lines_value, avg(lines_value) OVER (PARTITION BY n_name)), 4) AS lines_value FROM of""")
def q_w1(spark, d):
    out = C.impute_group_mean(_of(spark, d), "lines_value", "n_name")
    return rounded(out.select("o_orderkey", "n_name", "lines_value"))


@register("w2_residual", _with(OF_CTE) + """
SELECT o_orderkey, lines_flag,
       round(coalesce(lines_qty,
                      CASE WHEN lines_flag IS NOT NULL THEN avg(lines_qty) OVER (PARTITION BY lines_flag) END,
                      0.0), 4) AS lines_qty FROM of""")
def q_w2(spark, d):
    out = C.impute_group_mean(_of(spark, d), "lines_qty", "lines_flag", residual=0.0)
    return rounded(out.select("o_orderkey", "lines_flag", "lines_qty"))


# ---------------------------------------------------------------------------------------------
# S / V — null tokens, conformance, validation, records, dropped keys
# ---------------------------------------------------------------------------------------------

TEXT_DECLARED = [
    {"name": "o_orderkey", "dtype": "int", "required": True},
    {"name": "o_custkey", "dtype": "int", "required": True},
    {"name": "o_items", "dtype": "int"},
    {"name": "o_totalprice", "dtype": "float", "required": True},
    {"name": "o_orderstatus", "dtype": "str"},
]


@register("s5_null_tokens", _with(OT_CTE) + f"""
SELECT {_sql_int("o_orderkey")} AS o_orderkey, {_sql_int("o_custkey")} AS o_custkey,
       {_sql_int("o_items")} AS o_items, round(TRY_CAST(o_totalprice AS DOUBLE), 4) AS o_totalprice,
       o_orderstatus FROM ot""")
def q_s5(spark, d):
    return rounded(cast_to(normalise_nulls(orders_text(spark, d)), TEXT_DECLARED))


def _conformance_sql() -> str:
    parts = []
    for dcl in TEXT_DECLARED:
        c, k = dcl["name"], dcl["dtype"]
        if k == "int":
            bad = (f"{c} IS NOT NULL AND (TRY_CAST({c} AS DOUBLE) IS NULL "
                   f"OR TRY_CAST({c} AS DOUBLE) <> floor(TRY_CAST({c} AS DOUBLE)))")
        elif k == "float":
            bad = f"{c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL"
        else:
            bad = "false"
        parts.append(f"SELECT '{c}' AS column_name, '{k}' AS expected, count(*)::BIGINT AS n_rows, "
                     f"(count(*) - count({c}))::BIGINT AS n_null, "
                     f"count(*) FILTER (WHERE {bad})::BIGINT AS n_nonconforming FROM ot")
    return _with(OT_CTE) + "\nUNION ALL\n".join(parts)


@register("v3_value_conformance", _conformance_sql())
def q_v3(spark, d):
    return V.value_conformance(normalise_nulls(orders_text(spark, d)), TEXT_DECLARED)


V1_DECLARED = ORDER_FEATURES["data_validation"]["schema"]["columns"] + [
    {"name": "order_year", "dtype": "str"},
    {"name": "o_clerk", "dtype": "str", "required": True},
]


def _v1_sql() -> str:
    types = dict(OF_COLUMNS)
    fam = {"bigint": "int", "double": "float", "string": "str"}
    parts = []
    for dcl in V1_DECLARED:
        c, k, req = dcl["name"], dcl["dtype"], dcl.get("required", False)
        if c not in types:
            status, msg = ("fail", f"'Missing required column: {c}'") if req else ("skipped", "NULL")
            parts.append(f"SELECT '{c}' AS column_name, 'presence' AS \"check\", '{status}' AS status, "
                         f"'{k}' AS expected, NULL::VARCHAR AS actual, {msg}::VARCHAR AS message, "
                         f"NULL::BIGINT AS n_rows, NULL::BIGINT AS n_null")
            continue
        ok = fam[types[c]] == k
        status = "pass" if ok else "fail"
        msg = "NULL" if ok else f"'Column ''{c}'' expected {k} but found {types[c]}'"
        parts.append(f"SELECT '{c}' AS column_name, 'dtype' AS \"check\", '{status}' AS status, "
                     f"'{k}' AS expected, '{types[c]}' AS actual, {msg}::VARCHAR AS message, "
                     f"count(*)::BIGINT AS n_rows, (count(*) - count({c}))::BIGINT AS n_null FROM of")
    return _with(OF_CTE) + "\nUNION ALL\n".join(parts)


@register("v1_schema_report", _v1_sql())
def q_v1(spark, d):
    of = _of(spark, d)
    report = V.validate(of, V1_DECLARED, action="warn")
    present = [x["name"] for x in V1_DECLARED if x["name"] in of.columns]
    counts = P.null_counts(of, present)
    return report.join(counts, on="column_name", how="left")


@register("v7_finite_check", _with(OF_CTE) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*)::BIGINT AS n_rows, "
    f"count(*) FILTER (WHERE NOT coalesce(isfinite({c}::DOUBLE), false))::BIGINT AS n_not_finite FROM of"
    for c in ["lines_qty", "lines_value", "c_acctbal", "o_totalprice"]))
def q_v7(spark, d):
    return V.finite_counts(_of(spark, d), ["lines_qty", "lines_value", "c_acctbal", "o_totalprice"])


RECORD_CONTRACT = [
    {"name": "k", "dtype": "int", "required": True},
    {"name": "note", "dtype": "str"},
]


def _event_records(spark, d) -> DataFrame:
    """JSON text per event: the event's props, a fractional ``k`` for errors, no ``k`` for views."""
    ev = table(spark, d, "events")
    text = (F.when(F.col("event_type") == "error",
                   F.concat(F.lit('{"k": '), F.col("value").cast("string"), F.lit("}")))
            .when(F.col("event_type") == "view",
                  F.concat(F.lit('{"user": '), F.col("user_id").cast("string"), F.lit("}")))
            .otherwise(F.col("props")))
    return ev.select("event_id", text.alias("value"))


@register("v8_record_contract", """
WITH r AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN '{"k": ' || CAST(value AS VARCHAR) || '}'
              WHEN event_type = 'view' THEN '{"user": ' || CAST(user_id AS VARCHAR) || '}'
              ELSE props END AS txt
  FROM events),
p AS (SELECT event_id, TRY_CAST(json_extract_string(txt, '$.k') AS DOUBLE) AS k FROM r)
SELECT event_id,
       CASE WHEN k IS NOT NULL AND k = floor(k) THEN 'valid' ELSE 'rejected' END AS status,
       CASE WHEN k IS NOT NULL AND k = floor(k) THEN k::BIGINT END AS k,
       CASE WHEN k IS NULL THEN 'missing required field: k'
            WHEN k <> floor(k) THEN 'not an integer: k' ELSE '' END AS reasons
FROM p""")
def q_v8(spark, d):
    tagged = tag_records(_event_records(spark, d), RECORD_CONTRACT, keep=["event_id"])
    ok = F.size("reasons") == 0
    return tagged.select("event_id", F.when(ok, F.lit("valid")).otherwise(F.lit("rejected")).alias("status"),
                         F.when(ok, F.col("k")).alias("k"), F.array_join("reasons", ";").alias("reasons"))


@register("j4_dropped_keys", _with(OF_CTE) + "SELECT o_orderkey FROM of WHERE last_ship_year IS NULL")
def q_j4(spark, d):
    of = _of(spark, d)
    return dropped_keys(of, C.clean(of, _cfg()), "o_orderkey")


# ---------------------------------------------------------------------------------------------
# E — feature expressions
# ---------------------------------------------------------------------------------------------

@register("e1_weighted_sum", _with(OF_CTE) + """
SELECT o_orderkey, round(lines_value + c_acctbal * 0.5, 4) AS value_and_balance FROM of""")
def q_e1(spark, d):
    out = weighted_sum(_of(spark, d), "value_and_balance", {"lines_value": 1, "c_acctbal": 0.5})
    return rounded(out.select("o_orderkey", "value_and_balance"))


@register("e3_age", _with(OF_CTE) + "SELECT o_orderkey, last_ship_year - order_year AS ship_lag FROM of")
def q_e3(spark, d):
    return difference(_of(spark, d), "ship_lag", "last_ship_year", "order_year").select("o_orderkey", "ship_lag")


@register("e_engineer", _with(OF_CTE) + """
SELECT o_orderkey, last_ship_year - order_year AS ship_lag,
       round(lines_value + c_acctbal * 0.5, 4) AS value_and_balance FROM of""")
def q_e(spark, d):
    out = engineer(_of(spark, d), _cfg()["engineering"])
    return rounded(out.select("o_orderkey", "ship_lag", "value_and_balance"))


# ---------------------------------------------------------------------------------------------
# M — transformers, selection, split, model
# ---------------------------------------------------------------------------------------------

CATS = {
    "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "o_orderstatus": ["F", "O", "P"],
    "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}


def _onehot_sql(drop_first: bool = True) -> list[str]:
    cols = []
    for c, values in CATS.items():
        for v in (values[1:] if drop_first else values):
            cols.append(f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"onehot__{c}_{v}\"")
    return cols


def _onehot_cfg() -> dict:
    cfg = _cfg()
    cfg["preprocessing"]["scaling"] = {}
    cfg["features"]["engineered"] = []
    return cfg


@register("m1_onehot", _with(OF_CTE) + "SELECT o_orderkey, " + ", ".join(_onehot_sql()) + " FROM of")
def q_m1(spark, d):
    of = _of(spark, d)
    params = fit_transformer(of, _onehot_cfg())
    return apply_transformer(of, params, keep=["o_orderkey"])


SCALED = ["c_acctbal", "lines_qty", "lines_value", "lines_cnt", "order_year"]


def _scale_cfg(method: str) -> dict:
    cfg = _cfg()
    cfg["preprocessing"]["encoding"] = {}
    cfg["preprocessing"]["scaling"] = {"method": method, "apply_to": ["continuous", "ordinal"]}
    cfg["features"]["engineered"] = []
    return cfg


def _std_expr(c: str, src: str = "") -> str:
    return (f"round(({c} - (SELECT avg({c}) FROM {src or 'of'})) / "
            f"coalesce(nullif((SELECT stddev_pop({c}) FROM {src or 'of'}), 0), 1), 4) + 0.0 AS scaler__{c}")


def _minmax_expr(c: str, src: str = "") -> str:
    t = src or "of"
    return (f"round(({c} - (SELECT min({c}) FROM {t})) / "
            f"coalesce(nullif((SELECT max({c}) - min({c}) FROM {t}), 0), 1), 4) + 0.0 AS scaler__{c}")


@register("m2_standard", _with(OF_CTE) + "SELECT o_orderkey, " + ", ".join(_std_expr(c) for c in SCALED) + " FROM of")
def q_m2(spark, d):
    of = _of(spark, d)
    return rounded(apply_transformer(of, fit_transformer(of, _scale_cfg("standard")), keep=["o_orderkey"]))


@register("m3_minmax", _with(OF_CTE) + "SELECT o_orderkey, " + ", ".join(_minmax_expr(c) for c in SCALED) + " FROM of")
def q_m3(spark, d):
    of = _of(spark, d)
    return rounded(apply_transformer(of, fit_transformer(of, _scale_cfg("minmax")), keep=["o_orderkey"]))


def _m4_cfg() -> dict:
    cfg = _cfg()
    cfg["features"]["engineered"] = []
    return cfg


@register("m4_column_transform", _with(OF_CTE, f"\nsp AS (SELECT *, {SPLIT_SQL} AS split FROM of)",
                                       "\ntr AS (SELECT * FROM sp WHERE split = 'train')") +
          "SELECT o_orderkey, split, " + ", ".join(_onehot_sql()) + ", " +
          ", ".join(_std_expr(c, "tr") for c in SCALED) + " FROM sp")
def q_m4(spark, d):
    data = split(_of(spark, d), "o_orderkey", seed=42, buckets=1000, method="arith")
    params = fit_transformer(data.where(F.col("split") == "train"), _m4_cfg())
    return rounded(apply_transformer(data, params, keep=["o_orderkey", "split"]))


SCORED = ["c_acctbal", "lines_qty", "lines_value", "lines_cnt", "order_year", "last_ship_year"]


def _fscore_sql() -> str:
    parts = []
    for c in SCORED:
        parts.append(
            f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NOT NULL AND o_totalprice IS NOT NULL)::BIGINT AS n, "
            f"covar_pop({c}, o_totalprice) / sqrt(var_pop(CASE WHEN o_totalprice IS NOT NULL THEN {c} END) * "
            f"var_pop(CASE WHEN {c} IS NOT NULL THEN o_totalprice END)) AS r FROM of")
    return _with(OF_CTE, "\nfs AS (" + "\nUNION ALL\n".join(parts) + ")")


FSCORE_SQL = _fscore_sql() + """
SELECT feature, n, round(r, 4) AS r, round(r * r / (1 - r * r) * (n - 2), 4) AS f_score FROM fs"""


@register("m8_f_scores", FSCORE_SQL)
def q_m8(spark, d):
    return rounded(f_scores(_of(spark, d), SCORED, "o_totalprice"))


@register("m8_onehot_scores", """
WITH base AS (SELECT o_custkey, o_totalprice FROM orders),
tot AS (SELECT count(o_totalprice) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM base),
per AS (SELECT o_custkey, count(o_totalprice) AS k, avg(o_totalprice) AS my FROM base WHERE o_custkey IS NOT NULL GROUP BY o_custkey),
rs AS (SELECT 'onehot__o_custkey_' || o_custkey::VARCHAR AS feature, n,
              (k::DOUBLE / n) * (my - m) / sqrt((k::DOUBLE / n) * (1 - k::DOUBLE / n) * v) AS r FROM per, tot)
SELECT feature, 'o_custkey' AS source, n::BIGINT AS n, round(r, 4) + 0.0 AS r,
       round(r * r / (1 - r * r) * (n - 2), 4) + 0.0 AS f_score FROM rs""")
def q_m8_onehot(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice")
    cfg = {"features": {"categorical": ["o_custkey"]}, "preprocessing": {"encoding": {"one_hot": {"handle_unknown": "ignore"}}}}
    return rounded(fit_scored(orders, cfg, "o_totalprice")[1])


@register("m9_top_k", _fscore_sql() + """
SELECT feature, round(r * r / (1 - r * r) * (n - 2), 4) AS f_score FROM fs
ORDER BY r * r / (1 - r * r) * (n - 2) DESC NULLS LAST, feature LIMIT 3""")
def q_m9(spark, d):
    return rounded(top_k(f_scores(_of(spark, d), SCORED, "o_totalprice"), 3).select("feature", "f_score"))


@register("m10_always_keep", _fscore_sql() + """
, ranked AS (SELECT feature, row_number() OVER (ORDER BY r * r / (1 - r * r) * (n - 2) DESC NULLS LAST, feature) - 1
                    AS position FROM fs WHERE feature <> 'c_acctbal')
SELECT position::INTEGER AS position, feature FROM ranked WHERE position < 2
UNION ALL SELECT 2, 'c_acctbal'""")
def q_m10(spark, d):
    scores = f_scores(_of(spark, d), SCORED, "o_totalprice")
    return select_k(scores, 2, keep=["c_acctbal"])


@register("m11_split", f"SELECT o_orderkey, {SPLIT_SQL} AS split FROM orders")
def q_m11(spark, d):
    return split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", seed=42, buckets=1000,
                 method="arith")


@register("m12_split2", """
SELECT o_orderkey, CASE WHEN ((o_orderkey % 1000003) * 7919 + 42 * 104729) % 1000 < 800 THEN 'train'
                        ELSE 'test' END AS split FROM orders""")
def q_m12(spark, d):
    return split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", {"train": 0.8, "test": 0.2},
                 seed=42, buckets=1000, method="arith")


@register("m13_ols_simple", """
SELECT 0::INTEGER AS position, 'l_quantity' AS term, round(regr_slope(l_extendedprice, l_quantity), 4) AS coefficient
FROM lineitem
UNION ALL
SELECT 1, '__intercept__', round(regr_intercept(l_extendedprice, l_quantity), 4) FROM lineitem""")
def q_m13s(spark, d):
    return rounded(fit_linear(table(spark, d, "lineitem"), ["l_quantity"], "l_extendedprice"))


@register("m13_ols_closed_form", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       regr_count(l_extendedprice, l_quantity)::BIGINT AS n FROM lineitem""")
def q_m13c(spark, d):
    from ..operators.model import fit_simple
    return rounded(fit_simple(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice"))


OLS2 = ["c_acctbal", "lines_cnt"]
OLS2_CTE = _with(OF_CTE, """
cl AS (SELECT * FROM of WHERE last_ship_year IS NOT NULL),
s AS (SELECT covar_pop(c_acctbal, c_acctbal) AS s11, covar_pop(lines_cnt, lines_cnt) AS s22,
             covar_pop(c_acctbal, lines_cnt) AS s12, covar_pop(c_acctbal, o_totalprice) AS s1y,
             covar_pop(lines_cnt, o_totalprice) AS s2y, avg(c_acctbal) AS m1, avg(lines_cnt) AS m2,
             avg(o_totalprice) AS my FROM cl),
b AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM s),
coef AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b)""")


@register("m13_ols_multi", OLS2_CTE + """
SELECT 0::INTEGER AS position, 'c_acctbal' AS term, round(b1, 4) AS coefficient FROM coef
UNION ALL SELECT 1, 'lines_cnt', round(b2, 4) FROM coef
UNION ALL SELECT 2, '__intercept__', round(b0, 4) FROM coef""")
def q_m13m(spark, d):
    cl = C.drop_null_rows(_of(spark, d), ["last_ship_year"])
    return rounded(fit_linear(cl, OLS2, "o_totalprice"))


@register("m14_predict", OLS2_CTE + """
SELECT o_orderkey, round(b0 + b1 * c_acctbal + b2 * lines_cnt, 1) AS prediction FROM cl, coef""")
def q_m14(spark, d):
    cl = C.drop_null_rows(_of(spark, d), ["last_ship_year"])
    coefs = fit_linear(cl, OLS2, "o_totalprice")
    return rounded(predict(cl, coefs, keep=["o_orderkey"]), PREDICTION_DIGITS)


# ---------------------------------------------------------------------------------------------
# R — metrics; J / U — alignment and union
# ---------------------------------------------------------------------------------------------

METRIC_SQL = """count(*)::BIGINT AS n,
       round(avg((o_totalprice - p) * (o_totalprice - p)), 0) AS mse,
       round(sqrt(avg((o_totalprice - p) * (o_totalprice - p))), 4) AS rmse,
       round(avg(abs(o_totalprice - p)), 4) AS mae,
       round(CASE WHEN count(*) < 2 THEN 'nan'::DOUBLE
                  WHEN var_pop(o_totalprice) = 0 THEN
                       CASE WHEN avg((o_totalprice - p) * (o_totalprice - p)) = 0 THEN 1.0 ELSE 0.0 END
                  ELSE 1 - avg((o_totalprice - p) * (o_totalprice - p)) / var_pop(o_totalprice) END, 4) AS r2"""


def _predicted_orders(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_totalprice",
                    (F.lit(0.9) * F.col("o_totalprice") + F.lit(1000.0) + (F.col("o_custkey") % 100) * 10.0)
                    .alias("p"))


PRED_SQL = "(SELECT o_orderkey, o_totalprice, 0.9 * o_totalprice + 1000.0 + (o_custkey % 100) * 10.0 AS p FROM orders)"


@register("r1_metrics", f"SELECT {METRIC_SQL} FROM {PRED_SQL}")
def q_r1(spark, d):
    return rounded(regression_metrics(_predicted_orders(spark, d), "o_totalprice", "p"), per_column={"mse": MSE_DIGITS})


@register("r5_metrics_by_split", f"SELECT split, {METRIC_SQL} FROM (SELECT *, {SPLIT_SQL} AS split FROM {PRED_SQL}) "
                                 "GROUP BY split")
def q_r5(spark, d):
    df = split(_predicted_orders(spark, d), "o_orderkey", seed=42, buckets=1000, method="arith")
    return rounded(regression_metrics(df, "o_totalprice", "p", by="split"), per_column={"mse": MSE_DIGITS})


@register("u1_union_splits", f"""
WITH sp AS (SELECT o_orderkey, o_custkey, o_totalprice, {SPLIT_SQL} AS split FROM orders)
SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice, split FROM sp WHERE split = 'train'
UNION ALL SELECT o_orderkey, NULL, round(o_totalprice, 4), split FROM sp WHERE split = 'valid'
UNION ALL SELECT o_orderkey, o_custkey, NULL, split FROM sp WHERE split = 'test'""")
def q_u1(spark, d):
    sp = split(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey",
               seed=42, buckets=1000, method="arith")
    parts = [sp.where(F.col("split") == "train"),
             sp.where(F.col("split") == "valid").drop("o_custkey"),
             sp.where(F.col("split") == "test").drop("o_totalprice")]
    return rounded(union_splits(*parts))


@register("j1_align", f"""
SELECT o.o_orderkey, round(o.o_totalprice, 4) AS y_true, round(p.p, 4) AS prediction
FROM orders o JOIN {PRED_SQL} p ON o.o_orderkey = p.o_orderkey""")
def q_j1(spark, d):
    truth = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("y_true"))
    preds = _predicted_orders(spark, d).select("o_orderkey", F.col("p").alias("prediction"))
    return rounded(align(truth, preds, "o_orderkey"))


# ---------------------------------------------------------------------------------------------
# L — composed jobs (checked by row count and by tests, no SQL form)
# ---------------------------------------------------------------------------------------------

@register("l3_train")
def q_l3(spark, d):
    return jobs.train_job(_of(spark, d), _cfg()).metrics


@register("l3_selected_features")
def q_l3s(spark, d):
    return jobs.train_job(_of(spark, d), _cfg()).selected


@register("l4_score_batch")
def q_l4(spark, d):
    of = _of(spark, d)
    cfg = _cfg()
    t = jobs.train_job(of, cfg)
    preds, _ = jobs.score_batch(of.drop("o_totalprice"), cfg, t.params, t.coefficients, t.features,
                                group_means=t.group_means)
    return preds


def _order_contract(df: DataFrame) -> list[dict]:
    kinds = {"bigint": "int", "int": "int", "double": "float", "string": "str"}
    return [{"name": c, "dtype": kinds[t], "required": c == "o_orderkey"} for c, t in df.dtypes]


@register("l4_score_stream")
def q_l4s(spark, d):
    """Train, export the scoring input as JSON-lines files, score them with the streaming job."""
    of = _of(spark, d)
    cfg = _cfg()
    t = jobs.train_job(of, cfg)
    root = scratch_path(spark, "stream")
    inputs = of.drop("o_totalprice")
    inputs.select(F.to_json(F.struct(*[col(c) for c in inputs.columns])).alias("value")).write.text(f"{root}/in")
    query = score_stream(spark, cfg, _order_contract(inputs), f"{root}/in", t.params, t.coefficients,
                         f"{root}/out", f"{root}/rejected", f"{root}/checkpoint", group_means=t.group_means)
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("l5_manifest_fingerprint")
def q_l5(spark, d):
    return P.fingerprint(_of(spark, d))


from . import catalog_io  # noqa: E402,F401  (registers its queries in the same tables)
