"""Sinks K1–K11.

Every artefact is a DataFrame written by executors: data, reports, metrics,
fitted parameters and feature lists alike. Nothing is serialised on the driver.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..operators.observe import Watch
from ..session import remove
from .readers import MANIFEST, SPLITS, latest_split_version, latest_version, split_folders


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: header row, no index column; quotes inside quoted text are doubled."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def stage(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> str:
    """K2, first half: write the data into a folder of its own; no reader sees it yet. Returns the folder."""
    folder = f"{name}/data-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/{folder}")
    return folder


def commit(spark: SparkSession, root: str, name: str, folder: str) -> int:
    """K2, second half: a manifest row makes the folder the newest version."""
    version = latest_version(spark, root, name) + 1
    row = spark.createDataFrame(
        [(name, version, folder, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))],
        "name string, version int, folder string, committed_at timestamp_ntz",
    )
    row.write.mode("append").parquet(f"{root}/{MANIFEST}")
    return version


def publish(df: DataFrame, root: str, name: str) -> int:
    """K2: write a new immutable version, then commit it in the manifest table.

    Data is written first, into a folder of its own, and the manifest row that names the
    folder is appended after. A reader that takes the newest committed version never sees a
    half-written one, and a publish that died leaves nothing in the way of the next.
    """
    return commit(df.sparkSession, root, name, stage(df, root, name))


def discard(spark: SparkSession, root: str, folder: str) -> None:
    """Deletes a staged folder that will not be committed."""
    remove(spark, f"{root}/{folder}")


def publish_splits(df: DataFrame, root: str, name: str, split_col: str = "split") -> int:
    """K3: features and target of all splits in one write, committed together as one version.

    The manifest names a folder per split, so that :func:`replace_split` can exchange one of
    them and readers (:func:`.readers.read_splits`) always get splits that belong together.
    """
    spark = df.sparkSession
    names = Watch(F.collect_set(col(split_col).cast("string")).alias("names"))
    folder = stage(names.on(df), root, name, [split_col])
    return _commit_splits(spark, root, name, {s: f"{folder}/{split_col}={s}" for s in names.get()["names"]})


def replace_split(df: DataFrame, root: str, name: str, split: str) -> int:
    """A new version in which one split has new rows and the others stay the files they are."""
    spark = df.sparkSession
    folders = split_folders(spark, root, name)
    if not folders:
        raise FileNotFoundError(f"No committed splits of '{name}' under {root}")
    return _commit_splits(spark, root, name, folders | {split: stage(df, root, name)})


def _commit_splits(spark: SparkSession, root: str, name: str, folders: dict) -> int:
    version = latest_split_version(spark, root, name) + 1
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    # One file, so the version's rows appear together.
    (spark.createDataFrame([(name, version, s, f, now) for s, f in sorted(folders.items())],
                           "name string, version int, split string, folder string, committed_at timestamp_ntz")
     .coalesce(1).write.mode("append").parquet(f"{root}/{SPLITS}"))
    return version


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """K3: one table partitioned by split, so reading one split prunes the rest."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4/K5/K6: metrics, validation report and schema snapshot as JSON lines."""
    df.write.mode(mode).json(path)


def write_sample(df: DataFrame, path: str, key: str, n: int = 50, mode: str = "overwrite") -> None:
    """K7: the first ``n`` rows by key (a top-n, not a full sort)."""
    df.orderBy(col(key)).limit(n).write.mode(mode).parquet(path)


def write_params(params: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K8: fitted transformer / model parameters."""
    params.write.mode(mode).parquet(path)


def feature_list_frame(spark, features: Sequence[str]) -> DataFrame:
    """K9: ordered feature names as a ``(position, feature)`` table."""
    schema = T.StructType([T.StructField("position", T.IntegerType(), False),
                           T.StructField("feature", T.StringType(), False)])
    return spark.createDataFrame([(i, f) for i, f in enumerate(features)], schema)


def write_feature_list(spark, features: Sequence[str], path: str, mode: str = "overwrite") -> None:
    feature_list_frame(spark, features).write.mode(mode).parquet(path)
