"""Profiling aggregates P1–P16.

Each profile is one (or a fixed few) aggregate jobs over the whole table:
wide aggregates are computed map-side (partial aggregation) and only one row
per task crosses the shuffle, so a hot value or key costs nothing extra.
Results come back as small DataFrames with one row per input column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, is_numeric, nan_to_null, wide_agg
from ..session import materialize
from .quantiles import described_quantiles, sketched_quantiles


# ---- P1 / P2 -------------------------------------------------------------------------

def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and duplicates (= rows − distinct; null equals null).

    Rows with text are grouped by a SHA-256 digest, so the shuffle carries 32 bytes per
    distinct row whatever the texts' length. A second, independent 64-bit hash must agree within each
    digest, else the job stops.
    """
    cols = list(columns or df.columns)
    kinds = {c: df.schema[c].dataType for c in cols}
    if not any(isinstance(k, (T.StringType, T.BinaryType)) for k in kinds.values()) or not all(map(_has_text_form, kinds.values())):
        groups = df.groupBy(*[col(c) for c in cols]).count()
    else:
        other = F.xxhash64(*[x for c in cols for x in (col(c), col(c).isNull())])
        groups = (df.select(row_digest(df, cols).alias("digest"), other.alias("other")).groupBy("digest")
                  .agg(F.count("*").alias("n"), F.min("other").alias("lo"), F.max("other").alias("hi"))
                  .select(F.when(F.col("lo") == F.col("hi"), F.col("n"))
                          .otherwise(F.raise_error(F.lit("Two different rows have one digest")).cast("long")).alias("count")))
    return groups.agg(
        F.sum("count").cast("long").alias("n_rows"),
        F.count(F.lit(1)).cast("long").alias("n_distinct"),
        F.sum(F.col("count") - 1).cast("long").alias("n_duplicates"),
    ).select(
        F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"),
        "n_distinct",
        F.coalesce("n_duplicates", F.lit(0).cast("long")).alias("n_duplicates"),
        (F.coalesce("n_duplicates", F.lit(0)) > 0).alias("has_duplicates"),
    )


def _has_text_form(kind: T.DataType) -> bool:
    """Types whose text tells all their values apart."""
    return isinstance(kind, (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 (32 bytes) of a row: each value with a null mark and its length, so no two rows meet by concatenation.

    As in a grouping, ``-0.0`` equals ``0.0`` and NaN equals NaN.
    """
    parts = []
    for c in columns or df.columns:
        kind = df.schema[c].dataType
        value = col(c) + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else col(c)
        text = F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


# ---- P3 ------------------------------------------------------------------------------

DESCRIBE_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType(), False),
    T.StructField("count", T.LongType(), True),
    T.StructField("unique", T.LongType(), True),
    T.StructField("top", T.StringType(), True),
    T.StructField("freq", T.LongType(), True),
    T.StructField("mean", T.DoubleType(), True),
    T.StructField("std", T.DoubleType(), True),
    T.StructField("min", T.DoubleType(), True),
    T.StructField("p25", T.DoubleType(), True),
    T.StructField("p50", T.DoubleType(), True),
    T.StructField("p75", T.DoubleType(), True),
    T.StructField("max", T.DoubleType(), True),
])


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long ``(column_name, value, cnt)`` frequency table for several columns in one pass."""
    parts = [F.struct(F.lit(c).alias("column_name"), col(c).cast("string").alias("value"))
             for c in columns]
    return (df.select(F.explode(F.array(*parts)).alias("e"))
            .select("e.column_name", "e.value")
            .where(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt")))


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count / unique / top / freq for text columns (top ties → smallest value)."""
    vc = value_counts(df, columns)
    return vc.groupBy("column_name").agg(
        F.sum("cnt").cast("long").alias("count"),
        F.count(F.lit(1)).cast("long").alias("unique"),
        F.min_by("value", F.struct((-F.col("cnt")).alias("neg"), F.col("value").alias("v"))).alias("top"),
        F.max("cnt").cast("long").alias("freq"),
    )


NUMERIC_SCHEMA = "column_name string, count long, mean double, std double, min double, max double, p25 double, p50 double, p75 double"


def describe_numeric(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """count, mean, std (ddof 1), min, quartiles (linear), max for numeric columns.

    Exact quartiles read the input three times at most, the moments among them. ``exact=False``
    takes moments and sketched quartiles from one scan.
    """
    probs = [0.25, 0.5, 0.75]
    found, first = (described_quantiles if exact else sketched_quantiles)(nan_to_null(df, columns), columns, probs)
    rows = []
    for c in columns:
        r = first.get(c)
        moments = (r["n"], r["mean"], r["std"], r["mn"], r["mx"]) if r else (0, None, None, None, None)
        rows.append((c, *moments, *[found[(c, p)] for p in probs]))
    return df.sparkSession.createDataFrame(rows, NUMERIC_SCHEMA)


def describe_all(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
                 materialize_input: bool = False) -> DataFrame:
    """The reference's ``describe(include="all")`` transposed, one row per column.

    Exact quartiles read the input three times at most. For an input that is
    itself a join or aggregate, ``materialize_input`` writes the profiled
    columns once so the passes read files instead of recomputing the joins.
    """
    cols = list(columns or df.columns)
    if materialize_input:
        df = materialize(df.select(*[col(c) for c in cols]), name="profile-input")
    nums = [c for c in cols if is_numeric(df.schema[c].dataType)]
    txt = [c for c in cols if c not in nums]
    frames = []
    if nums:
        frames.append(describe_numeric(df, nums, exact=exact))
    if txt:
        frames.append(describe_categorical(df, txt))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    have = set(out.columns)
    return out.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                        for f in DESCRIBE_SCHEMA.fields])


# ---- P4 – P7, P14 ----------------------------------------------------------------------

def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """P4 (+P14 denominator): ``(column_name, n_null, n_rows)`` from one aggregate."""
    return wide_agg(df, list(columns or df.columns), lambda c, _n: {
        "n_null": F.count_if(c.isNull()).cast("long"), "n_rows": F.count(F.lit(1)).cast("long")})


def missing_profile(df: DataFrame, above: float | None = 0.0, below: float | None = None,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Percent missing per column, kept when ``above < pct`` (and ``pct < below``)."""
    prof = null_counts(df, columns).select(
        "column_name", "n_null",
        F.when(F.col("n_rows") > 0, F.lit(100.0) * F.col("n_null") / F.col("n_rows")).alias("pct"),
    )
    if above is not None:
        prof = prof.where(F.col("pct") > F.lit(float(above)))
    if below is not None:
        prof = prof.where(F.col("pct") < F.lit(float(below)))
    return prof.orderBy("pct", "column_name")


def total_nulls(df: DataFrame) -> DataFrame:
    """One number, all nulls in the table."""
    return null_counts(df).agg(F.sum("n_null").cast("long").alias("total_nulls"))


def one_row_pct(df: DataFrame) -> DataFrame:
    """The share of the table one row represents, in percent."""
    return df.agg(F.try_divide(F.lit(100.0), F.count(F.lit(1)).cast("double")).alias("one_row_pct"))


# ---- P8, P10 ---------------------------------------------------------------------------

def shape(df: DataFrame, with_duplicates: bool = True) -> DataFrame:
    """n_rows, n_cols (and n_duplicates) as one row."""
    if with_duplicates:
        d = duplicate_count(df)
        return d.select("n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"), "n_duplicates")
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))


def column_info(df: DataFrame) -> DataFrame:
    """``(column_name, dtype, n_non_null)`` — schema snapshot with counts."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    info = wide_agg(df, df.columns, lambda c, _n: {"n_non_null": F.count(c).cast("long")})
    mapping = F.create_map(*[x for n, t in types.items() for x in (F.lit(n), F.lit(t))])
    return info.select("column_name", mapping[F.col("column_name")].alias("dtype"), "n_non_null")


def schema_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """P10: full outer join of two schema snapshots (from :func:`column_info`)."""
    a = reference.select("column_name", F.col("dtype").alias("ref_dtype"),
                         F.col("n_non_null").alias("ref_non_null"))
    b = current.select("column_name", F.col("dtype").alias("cur_dtype"),
                       F.col("n_non_null").alias("cur_non_null"))
    j = a.join(b, on="column_name", how="full_outer")
    status = (F.when(F.col("ref_dtype").isNull(), F.lit("added"))
              .when(F.col("cur_dtype").isNull(), F.lit("removed"))
              .when(F.col("ref_dtype") != F.col("cur_dtype"), F.lit("type_changed"))
              .otherwise(F.lit("same")))
    return j.select("column_name", "ref_dtype", "cur_dtype", "ref_non_null", "cur_non_null",
                    status.alias("status"))


# ---- P9 --------------------------------------------------------------------------------

def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive dataset hash ``(n_rows, fingerprint)``.

    Nulls are hashed by a mark per column, so it matters which column holds one. Per-row
    xxhash64 summed as a 38-digit decimal (duplicate rows add up, they do not cancel as
    with XOR), plus a second seed to lower collision odds.
    """
    agg = df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"), *fingerprint_columns(df, columns))
    text = F.concat_ws(":", F.col("n_rows").cast("string"),
                       F.coalesce(F.col("s1").cast("string"), F.lit("0")),
                       F.coalesce(F.col("s2").cast("string"), F.lit("0")))
    return agg.select("n_rows", F.sha2(text, 256).alias("fingerprint"))


def fingerprint_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list:
    """The two sums of :func:`fingerprint`, as aggregates (``s1``, ``s2``)."""
    cols = [x for c in (columns or df.columns) for x in (col(c), col(c).isNull())]
    h1 = F.xxhash64(*cols).cast("decimal(38,0)")
    h2 = F.xxhash64(F.lit(7919), *cols).cast("decimal(38,0)")
    return [F.sum(h1).alias("s1"), F.sum(h2).alias("s2")]


def fingerprint_text(sums) -> str:
    """:func:`fingerprint`'s digest from observed ``n_rows``, ``s1`` and ``s2``."""
    text = ":".join(str(int(sums[k] or 0)) for k in ("n_rows", "s1", "s2"))
    return hashlib.sha256(text.encode()).hexdigest()


# ---- P11 – P13, P15, P16 ---------------------------------------------------------------

def sample_rows(df: DataFrame, n: int, key: str | Sequence[str]) -> DataFrame:
    """First ``n`` rows by key — a per-partition top-n, never a full sort."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*[col(k) for k in keys]).limit(n)


def mean_of(df: DataFrame, column: str) -> DataFrame:
    """P12."""
    return nan_to_null(df, [column]).agg(F.avg(col(column).cast("double")).alias("mean"))


def histogram(df: DataFrame, column: str, bins: int = 10,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram data ``(bucket, lower, upper, n)``.

    The last bucket is closed on the right (as numpy's). Bounds default to the
    column's min / max, computed in one small aggregate.
    """
    df = nan_to_null(df, [column])
    v = col(column).cast("double")
    if lo is None or hi is None:
        r = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
    if lo is None:
        return df.sparkSession.createDataFrame(
            [], "bucket long, lower double, upper double, n long")
    width = (hi - lo) if hi > lo else 1.0
    b = F.least(F.floor((v - F.lit(lo)) / F.lit(width) * F.lit(bins)).cast("long"),
                F.lit(bins - 1).cast("long"))
    counted = (df.where(v.isNotNull() & (v >= F.lit(lo)) & (v <= F.lit(hi)))
               .select(b.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).cast("long").alias("n")))
    return counted.select(
        "bucket",
        (F.lit(lo) + F.col("bucket") * F.lit(width / bins)).alias("lower"),
        (F.lit(lo) + (F.col("bucket") + 1) * F.lit(width / bins)).alias("upper"),
        "n",
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows where a column is null or NaN."""
    missing = col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(col(column))
    return df.where(missing)


def prediction_summary(df: DataFrame, pred_col: str = "prediction", prob_col: str | None = None) -> DataFrame:
    """Row and column counts; mean / min / max of the probability (or prediction) column."""
    target = prob_col if prob_col and prob_col in df.columns else pred_col
    v = col(target).cast("double")
    return nan_to_null(df, [target]).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
    )
