"""Mixing sources to target weights by capped water-filling.

Targets: a budget is shared by weight; a source is clamped at ``max_epochs`` times its size
and what it can't take is reshared among the others until no target is above its cap.
Taking: every document is repeated whole as often as the target holds the source, and the
rest is taken once more from documents in a seeded order, the last of them in part, so a
source's taken words equal its target rounded down.

The order is never formed in one task: sums per (source, 1/4096 of the hash range) find the
range in which the rest runs out, and only that range's rows are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, word_list

_RANGE_DIGITS = 3  # hex digits of the hash that name a range


def number_sources(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``number`` (from 0) by ``source`` in code point order, null last, without one global sort task."""
    dealt = sources.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id())
    dealt = scratch.write(dealt, "numbered")
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"))  # at most one row per partition
    before = parts.withColumn("before", F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    order = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (dealt.join(before.select("part", "before"), "part")
            .withColumn("number", F.col("before") + F.row_number().over(order) - 1).drop("part", "before"))


def fill_targets(sources: DataFrame, budget: float, max_epochs: int) -> DataFrame:
    """Adds ``target`` to ``sources(source_size, weight)``.

    Each round is one small aggregate over the sources; the level only rises, and every
    round but the last clamps at least one more source, so it ends.
    """
    cap = F.col("source_size") * max_epochs
    level, clamped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > cap
        row = sources.agg(F.sum(full.cast("long")).alias("n"), F.sum(F.when(full, cap).otherwise(0)).alias("used"),
                          F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open")).first()
        if row["n"] is None or row["n"] == clamped:
            break
        if not row["open"]:
            level = float("inf")
            break
        clamped, level = row["n"], (budget - row["used"]) / row["open"]
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(share > cap, cap.cast("double")).otherwise(share))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share_percent: int = 150, max_epochs: int = 2,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42) -> DataFrame:
    """Per document: id, ``size`` (words), ``source_size``, ``target`` (of its source), ``taken`` (words).

    ``weights`` repeat over the sources in code point order, null last (a null source is a source
    of its own). The mix takes ``share_percent`` % of all words. ``taken`` counts repetitions and never
    exceeds ``max_epochs * size``.

    Defined cases: null text has size 0 and gives nothing; a source without words has
    target 0; rows with equal ids (or null ids) are ordered by size and otherwise alike, so any
    order among them gives the same rows; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    size = F.size(word_list(F.col(f"`{text_col}`"))).cast("long")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))))
    sizes = scratch.write(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                                      size.alias("size"), order.alias("place")), "sizes")
    bucket = F.substring("place", 1, _RANGE_DIGITS)
    ranges = scratch.write(sizes.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "ranges")
    sources = number_sources(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), scratch)
    listed = F.array(*[F.lit(int(w)) for w in weights])
    sources = scratch.write(sources.withColumn("weight", listed[(F.col("number") % len(weights)).cast("int")]), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    filled = fill_targets(sources, total * share_percent / 100, max_epochs)
    quota = F.floor("target").cast("long")
    filled = filled.select("source", "source_size", "target", F.expr("nvl(floor(target) div nullif(source_size, 0), 0)").alias("whole"))
    filled = filled.withColumn("rest", quota - F.col("whole") * F.col("source_size"))
    # The range in which the rest runs out; none if there is no rest.
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    cut = (ranges.withColumn("before", F.coalesce(upto, F.lit(0)))
           .join(filled.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
           .where("before < rest and before + words >= rest").select("s", F.col("bucket").alias("cut"), "before"))
    plan = filled.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "of")
    plan = scratch.write(plan, "plan")
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("of")))
    clear = joined.where(F.col("cut").isNull() | (bucket != F.col("cut"))).withColumn(
        "extra", F.when(bucket < F.col("cut"), F.col("size")).otherwise(0))
    seen = F.sum("size").over(Window.partitionBy("source").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, -1))
    edge = joined.where(bucket == F.col("cut")).withColumn("seen", F.col("before") + F.coalesce(seen, F.lit(0))).withColumn(
        "extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("seen")))).drop("seen")
    return clear.unionByName(edge).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"))
