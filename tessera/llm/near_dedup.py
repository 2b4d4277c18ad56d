"""Near duplicates by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its
maximum, so a signature of ``bands * rows`` values costs half as many hash evaluations;
the share of equal values is an unbiased estimate of the Jaccard similarity with a lower
variance than the same number of separate minima.

Steps, all over whole texts and all documents:

1. One pass makes per document the set size, a 128-bit fingerprint of the set, and the
   hashes of the signature's bands. Documents with the same set become one node.
2. Documents that agree on a band form a bucket. In each bucket the member met most often
   in all buckets is the pivot; every other member is compared with it on full sets. That
   is linear in the bucket, and links most copies.
3. Buckets whose other members are still in several components get the exact way: a
   prefix-filtered set join (tokens rare first, length and positional bounds) among their
   members, between components only, confirmed on full sets. No pair within a group
   that is already connected is ever made.
4. Components of the links; the smallest id names the component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, components, maybe_in, small_batches, without
from tessera.llm.tokens import Slice, mix, windows, word_slices


def shingle_sets(s: Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of each row, end to end, and their row offsets.

    A row with 1..k-1 words has one shingle, its whole sequence; without words it has none.
    """
    grams = windows(s.hashes, k)
    sets, sizes = [], np.zeros(s.last - s.first, dtype=np.int64)
    for i in range(s.last - s.first):
        begin, end = s.starts[i], s.starts[i + 1]
        if end - begin >= k:
            one = np.unique(grams[begin:end - k + 1])
        elif end > begin:
            one = windows(s.hashes[begin:end], int(end - begin))
        else:
            continue
        sets.append(one)
        sizes[i] = len(one)
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def band_hashes(flat: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One row of ``bands`` hashes per non-empty set; ``first`` holds the sets' begins in ``flat``."""
    perms = (bands * rows + 1) // 2
    factors = mix(np.arange(1, perms + 1, dtype=np.uint64), 11) | np.uint64(1)
    shifts = mix(np.arange(1, perms + 1, dtype=np.uint64), 12)
    signature = np.empty((2 * perms, len(first)), dtype=np.uint64)
    for p in range(perms):
        values = flat * factors[p] + shifts[p]
        signature[p] = np.minimum.reduceat(values, first)
        signature[perms + p] = np.maximum.reduceat(values, first)
    out = np.empty((len(first), bands), dtype=np.uint64)
    for band in range(bands):
        h = np.full(len(first), band + 1, dtype=np.uint64)
        for value in signature[band * rows:(band + 1) * rows]:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + value, 13)
        out[:, band] = h
    return out


def _signatures(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in word_slices(batch.column(1), lower=True):
                flat, offsets = shingle_sets(s, k)
                sizes = np.diff(offsets)
                full = np.flatnonzero(sizes)
                prints = np.zeros((2, len(sizes)), dtype=np.uint64)
                hashed = np.zeros((0, bands), dtype=np.uint64)
                if len(full):
                    begins = offsets[full]
                    for i in (0, 1):
                        prints[i, full] = np.add.reduceat(mix(flat, 21 + i), begins)
                    hashed = band_hashes(flat, begins, bands, rows)
                ends = np.concatenate([[0], np.cumsum((sizes > 0) * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashed.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.last - s.first), pa.array(sizes),
                     pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)), lists],
                    names=["id", "n", "f1", "f2", "bands"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in word_slices(batch.column(1), lower=True):
                flat, offsets = shingle_sets(s, k)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.last - s.first), lists], names=["id", "tokens"])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = 24, rows: int = 4) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` and ``kept`` (it names its component).

    Documents are linked when ``100 * intersection >= percent * union`` of their sets of
    ``shingle``-word shingles of the text with A-Z lower-cased. With 24 bands of 4 rows a pair at
    similarity 0.8 shares no band with a probability of 4e-6, at 0.85 of 2e-8.

    Defined cases: null or wordless text has an empty set, no links, and its own component. A
    null id has a null component and is kept; it never links. Rows that share an id are one
    document: links of any of them count, and all get the same component. Other columns
    are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    small_batches(spark)
    ids = docs.schema[id_col].dataType
    kind = ids.simpleString()
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows_of = scratch.write(slim.mapInArrow(_signatures(shingle, bands, rows),
                                            f"id {kind}, n bigint, f1 bigint, f2 bigint, bands array<bigint>"), "sig")
    same = scratch.write(rows_of.where("n > 0 and id is not null").groupBy("f1", "f2", "n")
                         .agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands")), "sets")
    links = _links(scratch, same, slim, kind, shingle, percent)
    # Documents with the same set, and repeated ids, are links to the set's representative.
    known = (rows_of.where("n > 0 and id is not null").join(same.select("f1", "f2", "n", "rep"), ["f1", "f2", "n"])
             .select("id", "rep").distinct())
    found = components(links.unionByName(_repeated(known)), scratch, "components")
    reps = (same.select("f1", "f2", "n", "rep")
            .join(found.withColumnRenamed("node", "rep"), "rep", "left")
            .select("f1", "f2", "n", "rep", F.coalesce("component", "rep").alias("component_id")))
    reps = scratch.write(reps, "labels")
    rows = rows_of.select("id", "n", "f1", "f2")
    full = rows.where("n > 0").join(reps.drop("rep"), ["f1", "f2", "n"], "left").select("id", "n", "component_id")
    # A wordless row of an id that has other rows belongs to their component.
    empty = rows.where("n = 0").select("id", "n")
    others = (known.join(empty.select("id").distinct(), "id", "left_semi").join(reps.select("rep", "component_id"), "rep")
              .groupBy("id").agg(F.min("component_id").alias("component_id")))
    out = full.unionByName(empty.join(others, "id", "left"))
    own = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id")).cast(ids)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.col("id").eqNullSafe(own).alias("kept"))


def _repeated(known: DataFrame) -> DataFrame:
    """Ids that occur with several different sets tie those sets together (their own set's among them)."""
    many = known.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b")
    return (known.join(many.select("id"), "id").select(F.col("id").alias("a"), F.col("rep").alias("b")))


def _links(scratch: Scratch, same: DataFrame, slim: DataFrame, kind: str, shingle: int, percent: int) -> DataFrame:
    in_band = same.select("rep", "n", F.explode("bands").alias("bucket"))
    buckets = scratch.write(in_band.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    members = scratch.write(in_band.join(buckets, "bucket"), "members")
    rank = members.groupBy("rep").agg(F.sum("size").alias("met"))
    ranked = members.join(rank, "rep")
    pivots = scratch.write(ranked.groupBy("bucket").agg(
        F.max(F.struct("met", (-F.col("rep")).alias("low") if kind != "string" else F.col("rep").alias("low"), "rep", "n")).alias("p"))
        .select("bucket", F.col("p.rep").alias("pivot"), F.col("p.n").alias("pivot_n")), "pivots")
    scratch.drop("buckets")
    fits = F.expr(f"100 * least(n, pivot_n) >= {percent} * greatest(n, pivot_n) and rep != pivot")
    star = (members.join(pivots, "bucket").where(fits)
            .select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct())
    star = scratch.write(star, "star")
    active = members.select("rep").distinct()
    sets = scratch.write(maybe_in(slim, "id", active, "rep").join(active, F.col("id") == F.col("rep"), "left_semi")
                         .mapInArrow(_sets(shingle), f"id {kind}, tokens array<bigint>"), "tokens")
    first = scratch.write(_confirm(star, sets, percent), "star-links")

    # Buckets that hold several components beside their pivot go the exact way.
    found = components(first, scratch, "star-components")
    label = scratch.write(members.select("rep").distinct().join(found.withColumnRenamed("node", "rep"), "rep", "left")
                          .select("rep", F.coalesce("component", "rep").alias("component")), "star-labels")
    rest = members.join(pivots, "bucket").where("rep != pivot").select("bucket", "rep").join(label, "rep")
    split = (rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo != hi").select("bucket"))
    left = scratch.write(rest.join(split, "bucket").select("rep", "component").distinct(), "rest")
    pairs = scratch.write(_prefix_pairs(scratch, sets, left, percent), "rest-pairs")
    return first.unionByName(_confirm(pairs, sets, percent))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
    shared = two.select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"),
                        F.size(F.array_intersect("x", "y")).alias("both"))
    return shared.where(f"100 * both >= {percent} * (nx + ny - both)").select("a", "b").distinct()


def _prefix_pairs(scratch: Scratch, sets: DataFrame, left: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs between components: exact prefix filter, rare tokens first.

    A set of n tokens can miss at most ``n - ceil(percent * n / 100)`` of them in a partner, so
    partners share one of the first ``missable + 1`` tokens in any common order. Tokens that
    no other set here holds come first and need no row: they only move the others back.
    """
    tokens = (sets.join(left, F.col("id") == F.col("rep"))
              .select("rep", "component", F.size("tokens").alias("n"), F.explode("tokens").alias("token")))
    tokens = scratch.write(tokens, "rest-tokens")
    often = scratch.write(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "rest-often")
    shared = tokens.join(often, "token")
    order = Window.partitionBy("rep", "n").orderBy("df", "token")
    missable = F.expr(f"n - ceil({percent} * n / 100)")
    placed = (shared.withColumn("k", F.row_number().over(order))
              .withColumn("common", F.count("*").over(Window.partitionBy("rep", "n")))
              .withColumn("place", F.expr("n - common + k")).where(F.col("place") <= missable + 1)
              .select("rep", "component", "n", "token", "place"))
    placed = scratch.write(placed, "rest-prefix")
    x = placed.select(*[F.col(c).alias(f"x_{c}") for c in placed.columns])
    y = placed.select(*[F.col(c).alias(f"y_{c}") for c in placed.columns])
    bound = F.expr("1 + least(x_n - x_place, y_n - y_place)")
    pairs = x.join(y, (F.col("x_token") == F.col("y_token")) & (F.col("x_rep") < F.col("y_rep"))
                   & (F.col("x_component") != F.col("y_component"))
                   & F.expr(f"100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)")
                   & (bound * (100 + percent) >= F.expr(f"{percent} * (x_n + y_n)")))
    return pairs.select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b")).distinct()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id; all columns stay.

    Rows that share an id are one document and stay or go together.
    """
    scratch = Scratch(docs.sparkSession, "neardup-drop")
    gone = near_duplicates(docs, id_col, text_col, **options).where("not kept").select(F.col(f"`{id_col}`").alias("gone"))
    return without(docs, F.col(f"`{id_col}`"), scratch.write(gone, "gone"), "gone")
