"""Shared helpers: scratch tables with an end of life, a bounded row filter, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Characters between words: blanks, or all ASCII but digits and letters (for lower-cased text).
BLANKS = " \t\n\x0b\x0c\r"
NOT_ALNUM = "".join(chr(c) for c in range(128) if not ("0" <= chr(c) <= "9" or "a" <= chr(c) <= "z"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors through Spark, once per application.

    Needed where the workers don't find the package by themselves; a job submitted with
    ``--py-files`` has it already, and a second copy does no harm.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="tessera-py-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = "2m"


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of at most ``BATCH_BYTES`` and a row; a size that the session sets itself stays.

    Spark's default is 10,000 rows up to 64 MB, which executor and worker hold several times over beside the heap.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


class Scratch:
    """Intermediate tables in the shared checkpoint folder.

    ``write`` cuts the lineage: a lost executor makes Spark read files again instead of
    recomputing joins. ``drop`` deletes a table that a later one has replaced; tables the
    returned (lazy) result still reads stay until the platform cleans the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship_package(spark)
        self.spark, self.label, self.paths = spark, label, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mark_maybe(df: DataFrame, key: str, ids: DataFrame, id_col: str, name: str = "_maybe", bits: int = 1 << 25) -> DataFrame:
    """Adds ``name``: false only where the key is surely not in ``ids``; without shuffling ``df``.

    The ids become a bitmap of ``bits`` bits (4 MB at the default, whatever the number of
    ids), which is broadcast. With far more ids than bits it marks every row; the exact join
    that must follow then shuffles all of ``df`` and still gives the same rows.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    maps = (ids.where(F.col(id_col).isNotNull()).select(slot(F.col(id_col)).alias("slot"))
            .groupBy(F.expr("bitmap_bucket_number(slot)").alias("_bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("_bitmap")))
    marked = df.withColumn("_slot", F.when(F.col(f"`{key}`").isNotNull(), slot(F.col(f"`{key}`"))))
    byte = "cast(conv(hex(substring(_bitmap, cast(bitmap_bit_position(_slot) div 8 + 1 as int), 1)), 16, 10) as int)"
    bit = F.expr(f"coalesce(getbit({byte}, cast(bitmap_bit_position(_slot) % 8 as int)) = 1, false)")
    return (marked.join(F.broadcast(maps), F.expr("bitmap_bucket_number(_slot)") == F.col("_bucket"), "left")
            .select(*[F.col(f"`{c}`") for c in df.columns], bit.alias(name)))


def maybe_in(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose key may be in ``ids`` (a superset; see :func:`mark_maybe`)."""
    return mark_maybe(df, key, ids, id_col).where("_maybe").drop("_maybe")


def without(docs: DataFrame, key: Column, dropped: DataFrame, drop_col: str) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``dropped``; only rows that may be are shuffled."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("_key"))
    marked = mark_maybe(row, "_key", dropped, drop_col)
    gone = dropped.select(F.col(drop_col).alias("_key")).distinct()
    return (marked.where("not _maybe").select("row.*")
            .unionByName(marked.where("_maybe").join(gone, "_key", "left_anti").select("row.*")))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, component), component = smallest node.

    Alternates large-star and small-star steps; the number of rounds grows with the logarithm
    of the longest chain. Every step is joins and aggregates with partial combine, written out
    after each round; nothing but one checksum row per round reaches the driver.
    """
    current = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    current, seen, k = scratch.write(current, f"{name}-0"), None, 0
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u")
        small = (pairs.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        after = scratch.write(small, f"{name}-{k + 1}")
        scratch.drop(f"{name}-{k}")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        current, k = after, k + 1
        if state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state


def fits_broadcast(written: DataFrame, max_rows: int = 1_000_000) -> bool:
    """True if a written table of narrow, fixed-width rows is small enough to broadcast.

    A plain count (partial counts, one number back); a larger table is joined by shuffle.
    """
    return written.count() <= max_rows


def text_key(text: Column) -> Column:
    """Tells rows with the same id but different texts apart."""
    return F.xxhash64(text)


def word_list(text: Column, between: str = BLANKS) -> Column:
    """All words of a text in order; null has none. Splitting is far cheaper here than extracting matches."""
    pattern = {BLANKS: r"[\x20\x09-\x0D]+", NOT_ALNUM: r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"}[between]
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), pattern, -1), "")


def gram_hashes(words: str, k: int) -> Column:
    """Hash of the ``k`` words from each position on, as an array; word borders count.

    Every word is hashed once; a gram is the hash of its words' hashes.
    """
    gram = ", ".join(f"h[i + {j}]" for j in range(k))
    return F.expr(f"transform(array(transform({words}, w -> xxhash64(w))), h -> case when size(h) >= {k}"
                  f" then transform(sequence(0, size(h) - {k}), i -> xxhash64({gram})) else cast(array() as array<bigint>) end)[0]")
