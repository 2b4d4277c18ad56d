"""Sources S1–S11: file scans, stage lookup, null tokens, typed casts, versions.

Raw text is read as strings, null tokens are normalised, then values are cast
to the *declared* schema, so a column never changes type because a batch
happens to be all-null (the reference's inference flips such columns to float).
"""

from __future__ import annotations

import csv
import os
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import PANDAS_NULL_TOKENS, col, nan_to_null, wide_agg

SUPPORTED_FORMATS = ("csv", "json", "parquet", "orc")

DECLARED_TYPES: dict[str, T.DataType] = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "bool": T.BooleanType(),
}


def resolve_path(path, root: str | None = None) -> str:
    """S3: reject empty / non-text paths and resolve relative ones against ``root``."""
    if not isinstance(path, str) or not path.strip():
        raise ValueError("Data path must be a non-empty string")
    if "://" in path or os.path.isabs(path) or root is None:
        return path
    return os.path.join(root, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: int | bool | None = 0,
    encoding: str = "utf-8",
    root: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read one dataset with an allow-listed format.

    CSV quotes are doubled inside quoted text. ``multi_line`` also reads quoted line
    breaks, at the price that one file is then read by one task. A line with more values
    than columns stops the job that reads it; a shorter line is filled up with nulls.

    ``header`` follows the reference's config: ``0`` means the first line holds
    the names, ``n`` that it is the line after ``n`` others (blank lines don't count; those above
    are skipped in every file), ``None`` that there is no header row.
    """
    fmt = (fmt or "").lower()
    if fmt not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported file type: {fmt}")
    full = resolve_path(path, root)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if header is not None and not isinstance(header, bool) and header > 0:
            if multi_line:
                raise ValueError("A header below the first line can't be read together with multi_line")
            return _below_header(spark, full, header, schema, sep, encoding)
        if header not in (0, None, True, False):
            raise ValueError(f"Unsupported header line: {header}")
        reader = (reader.option("sep", sep)
                  .option("header", header in (0, True))
                  .option("encoding", encoding)
                  .option("quote", '"').option("escape", '"')
                  .option("multiLine", multi_line)
                  .option("mode", "PERMISSIVE"))
    try:
        return _no_surplus(reader, full, sep) if fmt == "csv" else reader.load(full)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"File not found: {full}") from exc
        raise


def _first_lines(line: int, head: bool):
    """Of each file's first block: the header line (``head``), or what follows it.

    Rows of a block reach a task in the file's order, so counting needs no sort and no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, seen = None, 0
        for batch in batches:
            keep = []
            for own in batch.column(0).to_pylist():
                file, seen = (own, 0) if own != file else (file, seen + 1)
                keep.append(seen == line if head else seen > line)
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def _below_header(spark: SparkSession, path: str, line: int, schema, sep: str, encoding: str) -> DataFrame:
    """CSV files whose names stand on line ``line`` (from 0, blank lines not counted).

    Only the first block of each file passes through Python, which drops the lines down to the
    header; all others are parsed as they come. Files whose headers differ are an error.
    """
    try:
        lines = (spark.read.option("encoding", encoding).text(path)
                 .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
                 .where(F.trim("value") != ""))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"File not found: {path}") from exc
        raise
    options = {"sep": sep, "quote": '"', "escape": '"'}
    first = lines.where("at = 0").select("file", "value")
    heads = first.mapInArrow(_first_lines(line, True), first.schema).groupBy("value").agg(F.count("*").alias("n")).limit(2).collect()
    files = lines.where("at = 0").select("file").distinct().count()
    if len(heads) != 1 or heads[0]["n"] != files:
        raise ValueError(f"No common header on line {line} of {path}")
    width = len(next(csv.reader([heads[0]["value"]], delimiter=sep)))
    names = next(csv.reader([heads[0]["value"]], delimiter=sep)) if schema is None else None
    fields = (T.StructType([T.StructField(n, T.StringType()) for n in names]) if schema is None
              else T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    if len(fields) != width:
        raise ValueError(f"The header has {width} names, the schema {len(fields)}")
    values = first.mapInArrow(_first_lines(line, False), first.schema).unionByName(lines.where("at > 0").select("file", "value"))
    wide = ", ".join(f"c{i} string" for i in range(width + 1))
    parsed = values.select("value", F.from_csv("value", wide, options).alias("r"))
    message = F.concat(F.lit(f"Expected {width} values: "), F.col("value"))
    fine = F.when(F.col(f"r.c{width}").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return parsed.where(fine).select(*[F.col(f"r.c{i}").try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


MALFORMED = "_malformed"


def _no_surplus(reader, path: str, sep: str) -> DataFrame:
    """The CSV frame, with an error for a line that has more values than columns."""
    schema = reader.load(path).schema          # from the header line, if none was given
    marked = T.StructType(schema.fields + [T.StructField(MALFORMED, T.StringType(), True)])
    # Without pruning inside the parser every line is checked, whichever columns the job reads.
    df = (reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
          .schema(marked).load(path))
    wide = ", ".join(f"c{i} string" for i in range(len(schema.fields) + 1))
    parsed = F.from_csv(F.col(MALFORMED), wide, {"sep": sep, "quote": '"', "escape": '"'})
    surplus = F.col(MALFORMED).isNotNull() & parsed.getField(f"c{len(schema.fields)}").isNotNull()
    # The message names a data column as well: Spark refuses a scan of the malformed mark alone.
    first = F.coalesce(col(schema.fields[0].name).cast("string"), F.lit(""))
    message = F.concat(F.lit(f"Expected {len(schema.fields)} values: "), F.col(MALFORMED), F.lit(" at "), first)
    fine = F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.where(fine).select(*[col(f.name) for f in schema.fields])


def read_stage(spark: SparkSession, cfg: Mapping, stage: str = "raw", root: str | None = None) -> DataFrame:
    """Pick the configured raw / processed source; null tokens and declared types applied."""
    return declared_types(read_stage_text(spark, cfg, stage, root), cfg)


def declared_types(df: DataFrame, cfg: Mapping) -> DataFrame:
    """A source's frame in the types that ``data_validation.schema`` declares (unchanged without one)."""
    declared = ((cfg.get("data_validation") or {}).get("schema") or {}).get("columns")
    return cast_to(df, declared) if declared else df


def read_stage_text(spark: SparkSession, cfg: Mapping, stage: str = "raw", root: str | None = None) -> DataFrame:
    """S4 + S5: the configured source as read, null tokens and NaN as NULL, values not yet cast."""
    src = cfg.get("data_source", {})
    key = {"raw": "raw_path", "processed": "processed_path"}.get(stage)
    if key is None:
        raise ValueError(f"Unknown data_stage: {stage}")
    path = src.get(key)
    if not path:
        raise ValueError(f"No path configured for data_stage '{stage}'")
    raw = read_table(
        spark, path, fmt=src.get("type", "csv"), schema=src.get("schema"),
        sep=src.get("delimiter", ","), header=src.get("header", 0),
        encoding=src.get("encoding", "utf-8"), root=root, multi_line=src.get("multi_line", False),
    )
    return normalise_nulls(raw) if src.get("type", "csv") == "csv" else nan_to_null(raw)


def declared_schema(declared: Iterable[Mapping]) -> T.StructType:
    """StructType built from the declared ``{name, dtype, required}`` list."""
    return T.StructType([
        T.StructField(d["name"], DECLARED_TYPES[d["dtype"]], not d.get("required", False))
        for d in declared
    ])


def normalise_nulls(df: DataFrame, tokens: Sequence[str] = PANDAS_NULL_TOKENS,
                    columns: Iterable[str] | None = None) -> DataFrame:
    """String cells equal to a null token become NULL (one projection)."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = set(columns) if columns is not None else strings
    toks = list(tokens)
    return df.select(*[
        (F.when(col(n).isin(toks), F.lit(None).cast("string")).otherwise(col(n)).alias(n)
         if n in targets and n in strings else col(n))
        for n in df.columns
    ])


def cast_to(df: DataFrame, declared: Iterable[Mapping]) -> DataFrame:
    """Cast present columns to their declared type; unparsable → NULL.

    Text such as ``"3.0"`` is accepted for an int column when it is a whole
    number (the reference's record parser does the same).
    """
    types = {d["name"]: d["dtype"] for d in declared}
    exprs = []
    for n in df.columns:
        kind = types.get(n)
        c = col(n)
        if kind == "int":
            if isinstance(df.schema[n].dataType, T.StringType):
                # Integer text first (exact beyond 2**53), then whole-number text such as "3.0".
                as_int = F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("long"))
                as_d = c.try_cast("double")
            else:
                as_int = F.when(c.cast("double") == F.floor(c.cast("double")), c.cast("long")) \
                    if isinstance(df.schema[n].dataType, (T.FloatType, T.DoubleType, T.DecimalType)) \
                    else c.cast("long")
                as_d = c.cast("double")
            whole = F.when(as_d == F.floor(as_d), as_d.try_cast("long"))
            exprs.append(F.coalesce(as_int, whole).alias(n))
        elif kind == "float":
            exprs.append(c.try_cast("double").alias(n))
        elif kind == "str":
            exprs.append(c.cast("string").alias(n))
        elif kind == "bool":
            exprs.append(c.try_cast("boolean").alias(n))
        else:
            exprs.append(c)
    return df.select(*exprs)


def read_declared(spark: SparkSession, path: str, declared: Sequence[Mapping], fmt: str = "csv",
                  tokens: Sequence[str] = PANDAS_NULL_TOKENS, **kw) -> DataFrame:
    """S1+S5+S6 in one plan: read text, normalise null tokens, cast to declared types."""
    if fmt == "csv":
        raw = read_table(spark, path, fmt="csv", **kw)
        return cast_to(normalise_nulls(raw, tokens), declared)
    return cast_to(read_table(spark, path, fmt=fmt, **kw), declared)


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """S6 (profiling): which family each text column's values fit, in one aggregate.

    Returns ``(column_name, inferred)`` where inferred is int, float or str — the
    narrowest type every non-null value parses as. As the reference's reader does, whole
    numbers with a null among them report ``float``, and so do all-null columns.
    """
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    long = wide_agg(df, names, lambda c, _n: {
        "n": F.count(c),
        "n_rows": F.count(F.lit(1)),
        "bad_int": F.count_if(c.isNotNull() & c.try_cast("long").isNull()),
        "bad_float": F.count_if(c.isNotNull() & c.try_cast("double").isNull())})
    return long.select(
        "column_name",
        F.when(F.col("n") == 0, F.lit("float"))
        .when((F.col("bad_int") == 0) & (F.col("n") == F.col("n_rows")), F.lit("int"))
        .when(F.col("bad_float") == 0, F.lit("float"))
        .otherwise(F.lit("str")).alias("inferred"),
    )


# ---- S7: versioned named datasets -------------------------------------------------

MANIFEST = "_versions"


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    return spark.read.parquet(f"{root}/{MANIFEST}") if exists(spark, f"{root}/{MANIFEST}") else None


def latest_version(spark: SparkSession, root: str, name: str) -> int:
    """Highest committed version of ``name`` (0 when none)."""
    m = _manifest(spark, root)
    if m is None:
        return 0
    v = m.filter(F.col("name") == name).agg(F.max("version")).first()[0]
    return int(v or 0)


def version_folder(spark: SparkSession, root: str, name: str, version: int | None = None) -> str:
    """The folder of the newest (or a given) committed version."""
    v = version or latest_version(spark, root, name)
    if v == 0:
        raise FileNotFoundError(f"No published version of '{name}' under {root}")
    row = _manifest(spark, root).where((F.col("name") == name) & (F.col("version") == v)).first()
    if row is None:
        raise FileNotFoundError(f"No version {v} of '{name}' under {root}")
    return f"{root}/{row['folder']}"


def latest(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """Read the newest (or a given) committed version of a dataset."""
    return spark.read.parquet(version_folder(spark, root, name, version))


# ---- S8: committed splits ------------------------------------------------------------

SPLITS = "_splits"


def _split_rows(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    return spark.read.parquet(f"{root}/{SPLITS}").where(F.col("name") == name) if exists(spark, f"{root}/{SPLITS}") else None


def latest_split_version(spark: SparkSession, root: str, name: str) -> int:
    rows = _split_rows(spark, root, name)
    return int((rows.agg(F.max("version")).first()[0] if rows is not None else 0) or 0)


def split_folders(spark: SparkSession, root: str, name: str, version: int | None = None) -> dict[str, str]:
    """The committed folder of each split (one row per split)."""
    version = version or latest_split_version(spark, root, name)
    return {r["split"]: r["folder"] for r in _split_rows(spark, root, name).where(F.col("version") == version).collect()} if version else {}


def read_splits(spark: SparkSession, root: str, name: str, splits: Sequence[str] | None = None,
                version: int | None = None, split_col: str = "split") -> DataFrame:
    """The wanted splits of one committed version; files of the others are not touched."""
    folders = split_folders(spark, root, name, version)
    wanted = sorted(folders) if splits is None else list(splits)
    absent = [s for s in wanted if s not in folders]
    if absent or not wanted:
        raise FileNotFoundError(f"No committed split {absent or 'at all'} of '{name}' under {root}")
    out = None
    for s in wanted:
        part = spark.read.parquet(f"{root}/{folders[s]}").withColumn(split_col, F.lit(s))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_full_or_splits(spark: SparkSession, root: str, name: str, split_col: str = "split") -> DataFrame:
    """The newest full version of a dataset, else its committed splits put together."""
    if latest_version(spark, root, name):
        return latest(spark, root, name)
    return read_splits(spark, root, name, split_col=split_col)


def read_or_rebuild(spark: SparkSession, full_path: str, split_paths: Mapping[str, str],
                    split_col: str = "split") -> DataFrame:
    """Read the full dataset, or rebuild it from its split files when it is absent.

    The splits are concatenated by column name (missing columns become null)
    and keep their name in ``split_col``.
    """
    try:
        return spark.read.parquet(full_path)
    except AnalysisException:
        parts = [spark.read.parquet(p).withColumn(split_col, F.lit(name)) for name, p in split_paths.items()]
        if not parts:
            raise FileNotFoundError(f"Neither {full_path} nor any split exists")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    """Ordered selected-feature names from a ``(position, feature)`` table.

    The list is schema metadata (one entry per model input), not data.
    """
    df = spark.read.parquet(path)
    return [r["feature"] for r in sorted(df.select("position", "feature").collect(), key=lambda r: r["position"])]


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Saved ``(key, y_true, y_pred)`` table; a missing path is FileNotFoundError."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"Predictions not found: {path}") from exc
