"""Column-level helpers: name handling, type families and small expressions.

Everything here builds Catalyst expressions (``pyspark.sql.Column``) or works on
schema metadata; nothing touches rows on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens that the pandas CSV reader turns into a missing value by
# default (its ``na_values`` list). S5 recognises the same set.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def col(name: str) -> Column:
    """Reference a column by its exact name (spaces, slashes, dots allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Configured names that exist in ``df``, in configured order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def missing(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Configured names absent from ``df``."""
    have = set(df.columns)
    return [n for n in names if n not in have]


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def family(dt: T.DataType) -> str:
    """Map a Spark type onto the reference's three declared families."""
    if isinstance(dt, INTEGRAL):
        return "int"
    if isinstance(dt, FRACTIONAL):
        return "float"
    if isinstance(dt, T.StringType):
        return "str"
    if isinstance(dt, T.BooleanType):
        return "bool"
    return dt.simpleString()


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, INTEGRAL + FRACTIONAL)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def snake_name(raw: str) -> str:
    """Rename rule for the housing table: lower case, spaces and slashes to ``_``."""
    return re.sub(r"[ /]+", "_", raw.strip()).lower()


def safe_name(text: str) -> str:
    """Text for a generated column name: dots and backticks as percent codes, so no two texts meet."""
    return str(text).replace("%", "%25").replace(".", "%2E").replace("`", "%60")


def utc_year(c: Column, dt: T.DataType) -> Column:
    """Calendar year of a timestamp, independent of the session time zone.

    ``TIMESTAMP`` values are instants; their UTC date is derived from the epoch
    day so the result does not move with ``spark.sql.session.timeZone``.
    """
    if isinstance(dt, T.TimestampType):
        day = F.floor(F.unix_seconds(c) / F.lit(86400)).cast("int")
        return F.year(F.date_from_unix_date(day)).cast("long")
    return F.year(c).cast("long")


def is_finite(c: Column) -> Column:
    """True for a non-null, non-NaN, non-infinite number."""
    d = c.cast("double")
    return (
        d.isNotNull()
        & ~F.isnan(d)
        & (d != F.lit(float("inf")))
        & (d != F.lit(float("-inf")))
    )


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Normalise floating NaN to SQL NULL (pandas treats both as missing)."""
    names = list(columns) if columns is not None else df.columns
    frac = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    exprs = [
        (F.nanvl(col(n), F.lit(None).cast(dtype_of(df, n))).alias(n)
         if n in frac and n in names else col(n))
        for n in df.columns
    ]
    return df.select(*exprs)


def weighted_sum_expr(weights: Mapping[str, float]) -> Column:
    """``Σ wᵢ·colᵢ`` with SQL null propagation; weight 1 keeps the column's type."""
    terms = []
    for name, w in weights.items():
        terms.append(col(name) if w == 1 else col(name) * F.lit(w))
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def melt_columns(df: DataFrame, names: Sequence[str], fields, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """Long form ``(carry…, column_name, field…)``: one row per input row and column.

    ``fields(column, name) -> {field: per-row Column}`` must give the same field
    names and types for every column (flags, or values cast to one type). NaN counts
    as null. The rows are generated inside the scan's pipeline and never materialised.
    """
    names = list(names)
    if not names:
        raise ValueError("no columns to aggregate")
    df = nan_to_null(df)
    parts = [F.struct(F.lit(n).alias("column_name"), *[e.alias(k) for k, e in fields(col(n), n).items()])
             for n in names]
    carried = dict(carry or {})
    return (df.select(*[c.alias(k) for k, c in carried.items()], F.explode(F.array(*parts)).alias("_e"))
            .select(*[F.col(k) for k in carried], "_e.*"))


def per_column_agg(df: DataFrame, names: Sequence[str], fields, aggs,
                   carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One aggregate job over many columns: ``(column_name, agg…)``, one row per column.

    The table is melted to long form and grouped by column name, so the
    aggregation buffer stays a few fields wide however many columns there are
    (a wide aggregate with more than ``spark.sql.codegen.maxFields`` buffer
    fields loses whole-stage codegen). Partial aggregation runs before the
    shuffle: each task sends one row per column. ``aggs`` maps output names to
    aggregate Columns over the melted fields.
    """
    long = melt_columns(df, names, fields, carry)
    return long.groupBy("column_name").agg(*[e.alias(k) for k, e in aggs.items()])


#: Aggregates of one block: with its buffers an aggregate stays below ``spark.sql.codegen.maxFields`` (100).
BLOCK_AGGREGATES = 90


def wide_agg(df: DataFrame, names: Sequence[str], build) -> DataFrame:
    """``(column_name, agg…)``, one row per column, from wide aggregates over the rows as they are.

    ``build(column, name) -> {output: aggregate Column}`` must give the same outputs and types for every
    column, each with one buffer field (counts, minima, maxima). Columns are dealt to blocks narrow
    enough for whole-stage code generation; a block is one partial aggregate that scans
    only its own columns, and its single result row is turned into one row per column. No row of
    the input is ever multiplied. NaN counts as null.
    """
    names = list(names)
    if not names:
        raise ValueError("no columns to aggregate")
    outputs = list(build(col(names[0]), names[0]))
    per_block = max(1, BLOCK_AGGREGATES // len(outputs))
    out = None
    for first in range(0, len(names), per_block):
        block = names[first:first + per_block]
        slim = nan_to_null(df.select(*[col(n) for n in block]))
        row = slim.agg(*[e.alias(f"{k}_{i}") for i, n in enumerate(block) for k, e in build(col(n), n).items()])
        rows = row.select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("column_name"), *[F.col(f"{k}_{i}").alias(k) for k in outputs]) for i, n in enumerate(block)])))
        out = rows if out is None else out.unionByName(rows)
    return out
