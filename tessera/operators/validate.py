"""Validation V1–V10.

Schema checks (presence, type family) read only the DataFrame's schema. Value
checks (conformance of text to the declared type, finiteness, emptiness) are
single aggregate jobs over the whole table. The report is a DataFrame with one
row per declared column, so it can be written like any other table.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, family, is_finite, wide_agg

log = logging.getLogger(__name__)

REPORT_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType(), False),
    T.StructField("check", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("expected", T.StringType(), True),
    T.StructField("actual", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
])

_PARSE_AS = {"int": "long", "float": "double", "bool": "boolean"}


def schema_checks(df: DataFrame, declared: Sequence[Mapping]) -> list[tuple]:
    """V1/V2 on schema metadata: one ``(column, check, status, expected, actual, message)`` per entry."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for d in declared:
        name, expected, required = d["name"], d["dtype"], d.get("required", False)
        if name not in fields:
            if required:
                rows.append((name, "presence", "fail", expected, None, f"Missing required column: {name}"))
            else:
                rows.append((name, "presence", "skipped", expected, None, None))
            continue
        actual = family(fields[name])
        if expected in ("int", "float", "str", "bool") and actual != expected:
            # Text holding numbers is reported here and measured by value_conformance (V3).
            rows.append((name, "dtype", "fail", expected, fields[name].simpleString(),
                         f"Column '{name}' expected {expected} but found {fields[name].simpleString()}"))
        else:
            rows.append((name, "dtype", "pass", expected, fields[name].simpleString(), None))
    return rows


def validate(df: DataFrame, declared: Sequence[Mapping], action: str = "raise",
             report_path: str | None = None, text: DataFrame | None = None) -> DataFrame:
    """V1–V5: check a frame against a declared schema and apply the error policy.

    ``text`` is the untyped frame that ``df`` was cast from: its values that don't parse as
    their declared type are errors too (V3), although the cast has made them null.
    ``action="raise"`` raises ``ValueError`` after the report is written;
    ``"warn"`` logs and returns it; any other value returns it silently.
    """
    rows = schema_checks(df, declared)
    if text is not None:
        # One row per declared column.
        for r in value_conformance(text, declared).where("n_nonconforming > 0").orderBy("column_name").collect():
            rows.append((r["column_name"], "values", "fail", r["expected"], None,
                         f"Column '{r['column_name']}': {r['n_nonconforming']} value(s) are not {r['expected']}"))
    report = df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)
    if report_path:
        write_report(report, report_path)
    apply_policy(rows, action, report_path)
    return report


def write_report(report: DataFrame, path: str) -> None:
    """K5: the report's rows at ``path`` and ``{status, error_count}`` at ``path`` + ``_summary``."""
    report.coalesce(1).write.mode("overwrite").json(path)
    report_summary(report).coalesce(1).write.mode("overwrite").json(f"{path}_summary")


def report_summary(report: DataFrame) -> DataFrame:
    """V5: ``{status, error_count}`` as one row."""
    return report.agg(
        F.when(F.count_if(F.col("status") == "fail") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.count_if(F.col("status") == "fail").cast("long").alias("error_count"),
    )


def nonconforming(c: Column, kind: str) -> Column:
    """V3 per value: not null, and not readable as the declared type."""
    text = c.cast("string")
    if kind == "int":
        as_d = text.try_cast("double")
        return c.isNotNull() & F.coalesce(as_d.isNull() | (as_d != F.floor(as_d)), F.lit(True))
    if kind in _PARSE_AS:
        return c.isNotNull() & text.try_cast(_PARSE_AS[kind]).isNull()
    return F.lit(False)


def conformance_counts(df: DataFrame, declared: Sequence[Mapping]) -> tuple[list, list[tuple[str, str]]]:
    """V3 as aggregates for :class:`.observe.Watch`: ``n_rows`` and one count per declared present column.

    Returns the aggregates and the ``(column, declared type)`` that ``bad_<i>`` stands for.
    """
    present_ = [(d["name"], d["dtype"]) for d in declared if d["name"] in df.columns]
    counts = [F.count_if(nonconforming(col(name), kind)).alias(f"bad_{i}") for i, (name, kind) in enumerate(present_)]
    return [F.count(F.lit(1)).alias("n_rows"), *counts], present_


def observed_report(df: DataFrame, declared: Sequence[Mapping], counts: Mapping, columns: Sequence[tuple[str, str]]) -> list[tuple]:
    """The report rows (V1–V3) from the schema and the counts taken while the text was read."""
    rows = schema_checks(df, declared)
    for i, (name, kind) in enumerate(columns):
        if counts[f"bad_{i}"]:
            rows.append((name, "values", "fail", kind, None, f"Column '{name}': {counts[f'bad_{i}']} value(s) are not {kind}"))
    return rows


def apply_policy(rows: Sequence[tuple], action: str, report_path: str | None = None) -> int:
    """V4: raise, warn or stay silent about the report's errors; returns their number."""
    errors = sum(r[2] == "fail" for r in rows)
    if errors and action == "raise":
        raise ValueError(f"Data validation failed with {errors} error(s). See report at {report_path}")
    if errors and action == "warn":
        log.warning("Validation completed with %d error(s)", errors)
    return errors


def value_conformance(df: DataFrame, declared: Sequence[Mapping]) -> DataFrame:
    """V3: per declared present column, how many non-null values do not parse as the declared type.

    Output ``(column_name, expected, n_rows, n_null, n_nonconforming)`` from one aggregate.
    """
    kinds = {d["name"]: d["dtype"] for d in declared if d["name"] in df.columns}
    if not kinds:
        return df.sparkSession.createDataFrame(
            [], "column_name string, expected string, n_rows long, n_null long, n_nonconforming long")

    long = wide_agg(df, list(kinds), lambda c, name: {
        "n_rows": F.count(F.lit(1)).cast("long"),
        "n_null": F.count_if(c.isNull()).cast("long"),
        "n_nonconforming": F.count_if(nonconforming(c, kinds[name])).cast("long"),
    })
    expected = F.create_map(*[x for n, k in kinds.items() for x in (F.lit(n), F.lit(k))])
    return long.select("column_name", expected[F.col("column_name")].alias("expected"),
                       "n_rows", "n_null", "n_nonconforming")


def require_non_empty(df: DataFrame, what: str = "input", raise_error: bool = False) -> bool:
    """V6/V9: warn (or raise) on an empty frame; returns whether rows exist."""
    empty = df.isEmpty()
    if empty:
        if raise_error:
            raise ValueError(f"{what} has no rows")
        log.warning("%s has no rows", what)
    return not empty


def finite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """V7: ``(column_name, n_rows, n_not_finite)`` in one aggregate."""
    return wide_agg(df, columns, lambda c, _n: {
        "n_rows": F.count(F.lit(1)).cast("long"), "n_not_finite": F.count_if(~is_finite(c)).cast("long")})


def require_finite(df: DataFrame, columns: Sequence[str]) -> None:
    """V7: empty input or any null / NaN / ±inf value is a ``ValueError``."""
    bad = finite_counts(df, columns).agg(
        F.max("n_rows").alias("n"), F.sum("n_not_finite").alias("bad")).first()
    if not bad["n"]:
        raise ValueError("Found array with 0 sample(s)")
    if bad["bad"]:
        raise ValueError(f"Input contains NaN, infinity or a missing value ({bad['bad']} cell(s))")


def finite_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """V7 (mask form): keep rows whose listed columns are all finite."""
    cond = None
    for c in columns:
        ok = is_finite(col(c))
        cond = ok if cond is None else cond & ok
    return df.where(cond)
