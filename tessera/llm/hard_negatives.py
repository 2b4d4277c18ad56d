"""Hard negatives by lists shared among anchor clusters.

Anchors are clustered by angle. For a cluster with centre c whose members lie within the angle t of
c, no member's inner product with a vector q can exceed

    |anchor| * |q| * cos(max(0, angle(c, q) - t)).

The part without |anchor| is the same for all members: each block of candidates is sorted by it
once per cluster, and every member walks that list from the top until the bound of what is left
falls below what it still needs. That ends the walk with certainty; nothing is sampled.

Spark holds the candidates: every task walks the lists of its own blocks and gives its best few
per anchor, and windows with a limit per anchor (cut before the shuffle as well) merge them. Anchors come
to the tasks in blocks of ``anchors_per_block`` rows, so neither driver nor task ever holds more than one
block of them. First all positives are found; their scores give the intervals in which negatives are searched.

Inner products are whole numbers, computed in floating point only where that is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, mark_maybe

#: Scaled components are kept within this, so that inner products of up to 1,024 dimensions fit 64 bits.
LARGEST = 1 << 26
FIRST_STEP, LAST_STEP = 256, 4096


class Cluster(NamedTuple):
    members: np.ndarray  # rows of the block
    centre: np.ndarray
    angle: float  # the largest angle of a member to the centre


class Anchors(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # whole numbers as float64
    norms: np.ndarray
    clusters: list[Cluster]


class Intervals(NamedTuple):
    """Per anchor (row) and positive (column): lowest and highest score of a negative; lowest > highest where there is none."""
    low: np.ndarray
    high: np.ndarray


def _unit(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return vectors / np.where(norms > 0, norms, 1)[:, None]


def cluster_anchors(vectors: np.ndarray, norms: np.ndarray, members: int = 32, most: int = 32, rounds: int = 8) -> list[Cluster]:
    """Spherical k-means with seeded, spread first centres; zero vectors fit anywhere."""
    unit = _unit(vectors, norms)
    k = max(1, min(most, len(unit) // members))
    centres = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(rounds):
        own = np.argmax(unit @ centres.T, axis=1)
        sums = np.stack([unit[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(k)])
        centres = _unit(sums, np.linalg.norm(sums, axis=1))
    own = np.argmax(unit @ centres.T, axis=1)
    out = []
    for c in range(k):
        rows = np.flatnonzero(own == c)
        if len(rows):
            cosines = np.where(norms[rows] > 0, unit[rows] @ centres[c], 1.0)
            out.append(Cluster(rows, centres[c], float(np.arccos(np.clip(cosines.min(), -1, 1))) + 1e-9))
    return out


def _matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list column as a matrix; shorter vectors count as ending in zeros."""
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = np.asarray(lists.values)[offsets[0]:offsets[-1]].astype(np.float64)
    sizes = np.diff(offsets)
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - (offsets[:-1] - offsets[0])[row]] = flat
    return out


def make_anchors(table: pa.Table) -> Anchors:
    table = table.combine_chunks().sort_by("id")
    lists = table.column("q").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32()))
    vectors = _matrix(lists)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    ids, labels = (table.column(c).to_numpy().astype(np.int64) for c in ("id", "label"))
    return Anchors(ids, labels, vectors, norms, cluster_anchors(vectors, norms) if len(ids) else [])


class Best:
    """The best ``k`` (score, id) per slot: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, np.iinfo(np.int64).min)  # the k-th score of a full slot

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        full = place[keep] == self.k - 1
        self.least[self.slot[full]] = self.score[full]


def _products(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products: every partial sum is at most ``largest``, the product of the norms."""
    if largest < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if largest < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _walk(anchors: Anchors, batch: pa.RecordBatch, need, take) -> None:
    """Each member of each cluster walks the batch's list until ``need`` (lowest score of use, per anchor) exceeds the bound."""
    vectors = _matrix(batch.column("q"), anchors.vectors.shape[1])
    pad = vectors.shape[1] - anchors.vectors.shape[1]
    own = np.pad(anchors.vectors, ((0, 0), (0, pad))) if pad else anchors.vectors
    ids, labels = (np.asarray(batch.column(c)).astype(np.int64) for c in ("id", "label"))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    unit = _unit(vectors, norms)
    for cluster in anchors.clusters:
        centre = np.pad(cluster.centre, (0, pad)) if pad else cluster.centre
        angles = np.arccos(np.clip(unit @ centre, -1, 1))
        bound = norms * np.cos(np.maximum(0, angles - cluster.angle))
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        active, at, step = cluster.members, 0, FIRST_STEP
        while at < len(order):
            # Rounding of the bound is covered by a margin far above it.
            reach = anchors.norms[active] * (bound[at] + 1e-6 * norms.max(initial=0)) + 1e-3
            active = active[need(active) <= reach]
            if not len(active):
                break
            rows = order[at:at + step]
            largest = anchors.norms[active].max(initial=0) * norms[rows].max(initial=0)
            scores = _products(own[active], vectors[rows], largest)
            take(active, scores, labels[rows], ids[rows])
            at, step = at + step, min(step * 2, LAST_STEP)


def _best_rows(anchors: Anchors, best: Best, slots: int) -> Iterator[pa.RecordBatch]:
    row, slot = best.slot // slots, best.slot % slots
    batch = pa.RecordBatch.from_arrays([pa.array(anchors.ids[row]), pa.array(slot), pa.array(best.score), pa.array(best.id)],
                                       names=["anchor", "slot", "score", "id"])
    for a in range(0, batch.num_rows, 1 << 16):
        yield batch.slice(a, 1 << 16)


def _positives(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        best = Best(len(anchors.ids), k)

        def take(active, scores, labels, ids):
            hit = ((labels == anchors.labels[active][:, None]) & (ids != anchors.ids[active][:, None])
                   & (scores >= best.least[active][:, None]))
            r, c = np.nonzero(hit)
            best.add(active[r], scores[r, c], ids[c])

        for batch in batches:
            _walk(anchors, batch, lambda active: best.least[active], take)
        yield from _best_rows(anchors, best, 1)
    return run


def _negatives(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, (low, high) = shared.value
        slots = low.shape[1]
        best = Best(len(anchors.ids) * slots, k)
        none = np.iinfo(np.int64).max

        def lowest(active):
            """Per positive the lowest score of use: within the interval, and not below a full slot's last."""
            least = np.maximum(low[active], best.least.reshape(-1, slots)[active])
            return np.where(low[active] > high[active], none, least)

        def take(active, scores, labels, ids):
            use = lowest(active)
            hit = ((labels != anchors.labels[active][:, None]) & (scores >= use.min(axis=1)[:, None])
                   & (scores <= high[active].max(axis=1)[:, None]))
            r, c = np.nonzero(hit)
            found = scores[r, c]
            for slot in range(slots):
                fits = (found >= use[r, slot]) & (found <= high[active[r], slot])
                best.add(active[r[fits]] * slots + slot, found[fits], ids[c[fits]])

        for batch in batches:
            _walk(anchors, batch, lambda active: lowest(active).min(axis=1), take)
        yield from _best_rows(anchors, best, slots)
    return run


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column, scale: int) -> DataFrame:
    """(id, label, q, anchor) of the rows that take part."""
    x = F.col(f"`{vector_col}`")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    kind = dict(vectors.select(label.alias("l")).dtypes)["l"]
    number = label.cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint", "boolean") else F.xxhash64(label)
    return (vectors.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & x.isNotNull()).where(fine)
            .select(F.col(f"`{id_col}`").cast("bigint").alias("id"), number.alias("label"), F.transform(x, whole).alias("q"),
                    F.coalesce(anchor, F.lit(False)).alias("anchor")))


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   anchors_per_block: int = 16_384) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of another label whose score lies between
    ``low`` and ``high`` percent of the positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components count as ``floor(scale * x)``; a score is the whole-number inner product with the
    anchor; higher scores come first, ties by smaller id. An anchor's positives are its first
    ``positives`` other rows of the same label.

    Defined cases: rows with a null id, a null label, a null vector, or a null or non-finite
    component take no part. Rows that share an id are one row: the one with the smallest label,
    then the smallest vector. Shorter vectors count as ending in zeros; the empty vector has
    score 0 with all. Scaled components beyond 2**26 count as 2**26. A positive with a negative
    score has no negatives (the interval is empty). An anchor without positives or negatives has
    no rows; an empty table gives an empty result. Other columns are ignored. ``id_col`` is an integer column.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "hardneg")
    rows = _usable(vectors, id_col, vector_col, label, anchor, scale)
    twice = scratch.write(rows.groupBy("id").count().where("count > 1").select(F.col("id").alias("twice")), "twice")
    marked = mark_maybe(rows, "id", twice, "twice")
    one = marked.where("_maybe").groupBy("id").agg(F.min(F.struct("label", "q")).alias("row"), F.max("anchor").alias("anchor"))
    rows = scratch.write(marked.where("not _maybe").drop("_maybe").unionByName(one.select("id", "row.label", "row.q", "anchor")), "rows")
    asked = rows.where("anchor")
    blocks = max(1, -(-asked.count() // anchors_per_block))

    def block(i: int) -> Anchors:
        return make_anchors(asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).select("id", "label", "q").toArrow())

    found = []
    for i in range(blocks):
        shared = spark.sparkContext.broadcast(block(i))
        out = rows.select("id", "label", "q").mapInArrow(_positives(shared, positives), "anchor bigint, slot bigint, score bigint, id bigint")
        found.append(scratch.write(_top(out, positives).drop("slot"), f"positives-{i}"))
    results = []
    for i, own in enumerate(found):
        anchors = block(i)
        low_high = np.zeros((2, len(anchors.ids), positives), dtype=np.int64)
        low_high[0] = 1  # no interval
        known = own.select("anchor", "rank", "score").toArrow()
        where = np.searchsorted(anchors.ids, known.column("anchor").to_numpy()), known.column("rank").to_numpy() - 1
        score = known.column("score").to_numpy()
        low_high[0][where] = -((-low * score) // 100)
        low_high[1][where] = (high * score) // 100
        shared = spark.sparkContext.broadcast((anchors, Intervals(*low_high)))
        out = rows.select("id", "label", "q").mapInArrow(_negatives(shared, negatives), "anchor bigint, slot bigint, score bigint, id bigint")
        first = own.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        top = scratch.write(_top(out, negatives), f"negatives-{i}")
        results.append(top.join(first, ["anchor", "slot"]).select(
            F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")))
    return reduce(DataFrame.unionByName, results)
