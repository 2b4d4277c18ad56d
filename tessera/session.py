"""Session construction and lineage helpers.

Every operator in the package is lazy; the only place that decides *where*
intermediate data lives is :func:`materialize`, which writes a reliable
checkpoint into the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    Master, shuffle partitions and memory stay what the platform or ``spark-submit`` gave,
    unless the caller passes them. AQE is on so shuffle partitions coalesce at
    runtime, skewed join partitions are split, and sort-merge joins whose build side turns
    out small become broadcast joins by measured size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only in local mode.

    On a cluster the folder must be given by the platform (``spark.checkpoint.dir``);
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; give a shared folder (HDFS/S3/…) for checkpoints"
        )
    folder = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


_SCOPE: ContextVar[list | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list]:
    """Owns the intermediate tables made inside it and deletes them at its end, also after an error.

    For jobs that write their results elsewhere: no frame that reads such a table may be used
    after the scope. A scope inside another one ends by itself; what is made outside any scope stays until
    the platform cleans the checkpoint folder.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield paths
    finally:
        _SCOPE.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through its own file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A fresh folder for an intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    if _SCOPE.get() is not None:
        _SCOPE.get().append(path)
    return path


def materialize(df: DataFrame, partition_by: Sequence[str] | None = None, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing joins)
    and keeps the intermediate columnar, so later passes read only the columns
    they use; ``partition_by`` lets a filter on that column prune whole folders.
    Used where one intermediate feeds several passes or fits, and where a small
    derived table has to be measured before choosing a join strategy.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
