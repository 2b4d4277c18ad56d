"""JSON record source and contract S10 / V8.

A record contract is a declared list ``{name, dtype, required}``. Records are
parsed with ``from_json`` against the contract's types; one that does not fit is parsed again
against a *lax* schema (integers read as decimals, so ``0.0`` is accepted for an int field and
64-bit integers stay exact), then typed and checked in one projection. Works unchanged on a streaming frame.
Each record lands in exactly one output: ``valid`` (typed columns) or
``rejected`` (raw text plus a ``reasons`` array).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LAX = {"int": T.DecimalType(38, 18), "float": T.DoubleType(), "str": T.StringType(), "bool": T.BooleanType()}
CORRUPT = "_corrupt_record"


_STRICT = _LAX | {"int": T.LongType()}


def lax_schema(contract: Sequence[Mapping], types: Mapping = _LAX) -> T.StructType:
    fields = [T.StructField(d["name"], types[d["dtype"]], True) for d in contract]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType(), True)])


def tag_records(df: DataFrame, contract: Sequence[Mapping], text_col: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """Parse once: ``keep…, typed contract columns, reasons`` (empty ``reasons`` = valid).

    Unknown JSON fields are ignored. A record is rejected when it is not a JSON
    object, misses a required field, or has a non-whole number in an int field.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.select(*[F.col(k) for k in keep if k != text_col], F.col(text_col).alias("_raw"),
                       F.from_json(F.col(text_col), lax_schema(contract, _STRICT), options).alias("_f"))
    fits = F.coalesce(F.col("_f").isNotNull() & F.col(f"_f.{CORRUPT}").isNull(), F.lit(False))
    parsed = parsed.withColumn("_fits", fits).withColumn("_r", F.when(~F.col("_fits"), F.from_json("_raw", lax_schema(contract), options)))
    fits = F.col("_fits")
    reasons = [F.when(~fits & (F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()),
                      F.lit("malformed record"))]
    typed = []
    for d in contract:
        name, kind = d["name"], d["dtype"]
        f, v = F.col("_f").getField(name), F.col("_r").getField(name)
        if d.get("required", False):
            reasons.append(F.when(F.when(fits, f.isNull()).otherwise(v.isNull()), F.lit(f"missing required field: {name}")))
        if kind == "int":
            reasons.append(F.when(~fits & v.isNotNull() & (v != F.floor(v)), F.lit(f"not an integer: {name}")))
            typed.append(F.when(fits, f).when(v == F.floor(v), v.try_cast("long")).alias(name))
        else:
            typed.append(F.when(fits, f).otherwise(v).alias(name))
    return parsed.select(*[(F.col("_raw").alias(k) if k == text_col else F.col(k)) for k in keep],
                         *typed, F.col("_raw").alias("_raw"),
                         F.filter(F.array(*reasons), lambda x: x.isNotNull()).alias("reasons"))


def parse_records(df: DataFrame, contract: Sequence[Mapping], text_col: str = "value",
                  keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split JSON text records into ``(valid, rejected)`` frames (see :func:`tag_records`).

    When both outputs are consumed, each is a filter of the same parse; write
    them from one ``foreachBatch`` (or persist the tagged frame) to parse once.
    """
    tagged = tag_records(df, contract, text_col, keep)
    names = [d["name"] for d in contract]
    valid = tagged.where(F.size("reasons") == 0).select(*[F.col(k) for k in keep], *[F.col(n) for n in names])
    rejected = tagged.where(F.size("reasons") > 0).select(
        *[F.col(k) for k in keep if k != text_col], F.col("_raw").alias(text_col), "reasons")
    return valid, rejected


def records_from_path(spark, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """JSON-lines files as a ``value`` text column (batch or stream)."""
    if streaming:
        reader = spark.readStream.format("text")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.load(path)
    return spark.read.text(path)
