"""Prediction by partial matching over bytes, pretrained on part of a corpus.

Counts of all ``order + 1`` byte sequences are gathered by Spark. Shorter contexts follow by
summing. The model is a written table and nothing is pruned from it: a symbol's probability depends
on the last ``order`` bytes only, so every distinct sequence of the corpus gets its price once, in
joins. The most frequent sequences (at most ``max_nodes``) go to the workers with their
prices; a text's others meet theirs in a join, like rare words. The result doesn't depend on that bound.

A symbol's probability is taken at the longest context seen in training; where it hasn't been seen
there, the escape is paid and the next shorter context is asked, without the symbols that
the longer one would have given (symbol exclusion). Escapes count the distinct symbols of a
context. Below order 0 the remaining symbols are equally likely. A text is its bytes with
A-Z lower-cased and one end symbol (byte 0), in a context of zero bytes.

Beside the trie, word counts of the training documents give the add-0.1 unigram score of
the contract. The most frequent words go to the workers (a bounded number); others meet
their counts in a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, maybe_in
from tessera.llm.tokens import _layout, row_slices, word_slices

SLICE = 1 << 19
_FLUSH = 1 << 22  # keys a task holds of one kind before they are summed (32 MB)


class Prices(NamedTuple):
    """A hash table with open addressing: slot, then the slots after it, until the key or an empty slot (-1)."""
    keys: np.ndarray
    values: np.ndarray


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    """Multiplicative hashing to a power of two of slots."""
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def price_table(keys: np.ndarray, values: np.ndarray) -> Prices:
    """The table of distinct, non-negative keys; at most half full."""
    size = 1 << max(4, (2 * len(keys) - 1).bit_length())
    table, out = np.full(size, -1, dtype=np.int64), np.zeros(size)
    open_, at = np.arange(len(keys)), _slot(keys, size)
    while len(open_):
        free = table[at] == -1
        table[at[free]] = keys[open_[free]]  # of several keys for one slot the last one stays
        placed = table[at] == keys[open_]
        out[at[placed]] = values[open_[placed]]
        open_, at = open_[~placed], (at[~placed] + 1) & (size - 1)
    return Prices(table, out)


def look_up(table: Prices, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value or 0, found) of each key; all keys are probed side by side, nothing is sorted."""
    size = len(table.keys)
    at = _slot(keys, size)
    there = table.keys[at]
    found = there == keys
    out = np.where(found, table.values[at], 0.0)
    open_ = np.flatnonzero(~found & (there != -1))
    at = at[open_]
    while len(open_):
        at = (at + 1) & (size - 1)
        there = table.keys[at]
        hit = there == keys[open_]
        out[open_[hit]] = table.values[at[hit]]
        found[open_[hit]] = True
        more = ~hit & (there != -1)
        open_, at = open_[more], at[more]
    return out, found


def byte_grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (context, symbol) key at every byte and end of each text, and the texts' begins among them."""
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(rows), sizes)
    low = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    stream = np.zeros(len(data) + rows * (order + 1), dtype=np.uint64)
    stream[np.arange(len(data)) + row * (order + 1) + order] = low
    keys = stream[order:].copy()
    for back in range(1, order + 1):
        keys |= stream[order - back:len(stream) - back] << np.uint64(8 * back)
    begins = offsets[:-1] + np.arange(rows) * (order + 1)
    wanted = np.ones(len(keys), dtype=bool)  # all but the padding in front of the second and later texts
    for back in range(order):
        wanted[begins[1:] - 1 - back] = False
    return keys[wanted], offsets[:-1] + np.arange(rows)


def _counts(order: int):
    """(kind, key, n): byte sequences of training texts (0) and others (2), training words (1), summed within a task up to a bound."""
    def summed(parts):
        keys = np.sort(np.concatenate(parts))
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        begins = np.flatnonzero(new)
        return keys[begins], np.diff(np.append(begins, len(keys)))

    def emit(kind, keys, counts):
        for i in range(0, len(keys), 1 << 18):
            part = keys[i:i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part.view(np.int64)),
                                              pa.array(counts[i:i + (1 << 18)])], names=["kind", "key", "n"])

    def grams(texts, kind):
        data, offsets = _layout(texts)
        for a, b in row_slices(offsets, SLICE):
            yield kind, byte_grams(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], order)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {0: [], 1: [], 2: []}
        for batch in batches:
            train, other = (batch.column(0).filter(mask) for mask in (batch.column(1), pc.invert(batch.column(1))))
            for kind, keys in chain(grams(train, 0), grams(other, 2), ((1, s.hashes) for s in word_slices(train, lower=True))):
                held[kind].append(keys)
                if sum(map(len, held[kind])) > _FLUSH:
                    yield from emit(kind, *summed(held[kind]))
                    held[kind] = []
        for kind, parts in held.items():
            if parts:
                yield from emit(kind, *summed(parts))
    return run


def price_grams(grams: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """(key, seen, price) of a table (key, n, seen): log10 probability of each key's symbol in its context.

    ``n`` counts the training texts, ``seen`` all texts. A key with ``n`` is priced in its own context. The
    others go down one context length at a time, and meet there the symbols seen after
    their context, at most 256 in an array.
    """
    mask = lambda k: F.lit((1 << (8 * (k + 1))) - 1)
    own = Window.partitionBy(F.shiftrightunsigned("key", 8))
    known = grams.where("n > 0")
    prices = [known.select("key", "seen", F.log10(F.col("n") / (F.sum("n").over(own) + F.count("*").over(own))).alias("price"))]
    open_ = grams.where("n = 0").select("key", "seen", F.lit(0.0).alias("price"), F.expr("cast(array() as array<int>)").alias("barred"))
    for k in range(order, -1, -1):
        at = F.shiftrightunsigned(F.col("key").bitwiseAND(mask(k)), 8)
        open_ = open_.withColumn("context", at)
        # Only contexts that are asked for; the filter lets some others through, which the join leaves out.
        wanted = maybe_in(known.select("key", "n", at.alias("context")), "context", open_.select("context").distinct(), "context") if k > 1 else (
            known.select("key", "n", at.alias("context")))
        symbols = wanted.groupBy("context", F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("s")).agg(F.sum("n").alias("n"))
        after = symbols.groupBy("context").agg(F.collect_list(F.struct("s", "n")).alias("after"))
        met = open_.join(F.broadcast(after) if k <= 1 else after, "context", "left")
        met = met.withColumn("mine", F.expr("cast(key & 255 as int)"))
        met = (met.withColumn("hit", F.expr("get(filter(after, x -> x.s = mine), 0).n"))
               .withColumn("room", F.expr("aggregate(after, 0L, (t, x) -> t + if(array_contains(barred, x.s), 0L, x.n)) + size(after)")))
        step = met.select("key", "seen", F.expr("price + if(after is null, 0, log10(coalesce(hit, size(after)) / room))").alias("price"),
                          F.expr("coalesce(after.s, barred)").alias("barred"), F.col("hit").isNotNull().alias("done"))
        step = scratch.write(step, f"order-{k}")
        prices.append(step.where("done").select("key", "seen", "price"))
        open_ = step.where("not done").drop("done")
    # Below order 0 the symbols never seen are equally likely.
    prices.append(open_.select("key", "seen", F.expr("price - log10(greatest(256 - size(barred), 1))").alias("price")))
    out = prices[0]
    for more in prices[1:]:
        out = out.unionByName(more)
    out = scratch.write(out, "prices")
    scratch.drop(*(f"order-{k}" for k in range(order + 1)))
    return out


def head_bar(counts: DataFrame, col: str, most: int) -> int:
    """The smallest power of 2**(1/4), rounded up, that at most ``most`` values of the column reach."""
    step = F.floor(F.log2(col) * 4).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()
    bar, room = None, most
    for r in steps:
        room -= r["rows"]
        if room < 0:
            break
        bar = r["step"]
    if bar is None:
        bar = steps[0]["step"] + 1 if steps else 0
    return math.ceil(2 ** (bar / 4) - 1e-9)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _scores(order: int, model):
    """Per text: what the frequent sequences give to the log10 probability, the other sequences and how often
    each occurs, words, and what the frequent words give to the unigram score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, (often, often_n) = model.value
        for batch in batches:
            data, offsets = _layout(batch.column(1))
            score, sizes, tail, times = np.zeros(batch.num_rows), np.zeros(batch.num_rows + 1, np.int64), [], []
            for a, b in row_slices(offsets, SLICE):
                keys, begins = byte_grams(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], order)
                keys = keys.view(np.int64)
                price, hit = look_up(head, keys)
                score[a:b] = np.add.reduceat(price, begins)
                # Only what the head lacks is sorted: each row's other sequences and how often it holds them.
                missing = np.flatnonzero(~hit)
                owner = np.searchsorted(begins, missing, side="right") - 1
                order_ = np.lexsort((keys[missing], owner))
                owner, rare = owner[order_], keys[missing][order_]
                new = np.ones(len(rare), dtype=bool)
                new[1:] = (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])
                at = np.flatnonzero(new)
                sizes[a + 1:b + 1] = np.bincount(owner[at], minlength=b - a)
                tail.append(rare[at])
                times.append(np.diff(np.append(at, len(rare))))
            ends = pa.array(np.cumsum(sizes).astype(np.int32))
            tail, times = (pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *x]))) for x in (tail, times))
            for s in word_slices(batch.column(1), lower=True):
                rows = s.last - s.first
                h = s.hashes.view(np.int64)
                at, hit = _find(often, h)
                owner = np.repeat(np.arange(rows), np.diff(s.starts))
                logs = np.where(hit, np.log10(often_n[at] + 0.1), 0.0) if len(often) else np.zeros(len(h))
                rare = np.flatnonzero(~hit)
                ends = np.searchsorted(owner[rare], np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, rows), batch.column(2).slice(s.first, rows), pa.array(score[s.first:s.last]), pa.array(np.diff(s.starts)),
                     pa.array(np.bincount(owner[hit], minlength=rows)), pa.array(np.bincount(owner, weights=logs, minlength=rows)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(h[rare])),
                     tail.slice(s.first, rows), times.slice(s.first, rows)],
                    names=["id", "train", "score", "n_words", "n_often", "often_logs", "rare", "tail", "times"])
    return run


def ppm_scores(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 5,
               max_nodes: int = 1 << 21, often: int = 1 << 17) -> DataFrame:
    """Per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``training`` is a condition on the rows of ``docs``; ``held_out`` is its negation. ``score`` is the
    model's log10 probability of the text, ``base_score`` the unigram one. ``often`` words and up to
    ``max_nodes`` byte sequences are scored from a broadcast table, all others by a join; neither bound changes the result.

    Defined cases: null text is empty and still has its end token; a null id gives its row
    like any other; repeated rows are scored and counted as often as they occur. Without
    training rows every symbol has probability 1/256 and ``train_tokens`` is 0. An empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ppm")
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(training, F.lit(False)).alias("train"))
    counts = (slim.select("text", "train").mapInArrow(_counts(order), "kind int, key bigint, n bigint")
              .groupBy((F.col("kind") == 1).alias("word"), "key")
              .agg(F.sum(F.when(F.col("kind") < 2, F.col("n")).otherwise(0)).alias("n"), F.sum("n").alias("seen")))
    counts = scratch.write(counts, "counts")
    words = counts.where("word").select("key", "n")
    facts = words.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    ends = slim.where("train").count()  # the end token's count
    total, distinct = (facts["n"] or 0) + ends, facts["v"] + (1 if ends else 0)
    prices = price_grams(counts.where("not word").select("key", "n", "seen"), order, scratch)
    bar = head_bar(prices, "seen", max_nodes)
    head = prices.where(F.col("seen") >= bar).select("key", "price").toArrow().sort_by("key")
    top = words.orderBy(F.desc("n"), "key").limit(often).toArrow().sort_by("key")
    known = tuple((np.asarray(t["key"], dtype=np.int64), np.asarray(t[v], dtype=np.float64)) for t, v in ((head, "price"), (top, "n")))
    model = spark.sparkContext.broadcast((price_table(*known[0]), known[1]))
    floor = int(np.min(np.asarray(top["n"]))) if top.num_rows else 0
    first = (slim.select("id", "text", "train").mapInArrow(
        _scores(order, model), f"id {kind}, train boolean, score double, n_words bigint, n_often bigint, often_logs double, rare array<bigint>, "
        "tail array<bigint>, times array<bigint>"))
    first = scratch.write(first.withColumn("uid", F.monotonically_increasing_id()), "first")
    seldom = first.select("uid", F.explode("rare").alias("key"))
    # A rare word can be no more frequent than the last of the frequent ones: no hot keys here.
    rare = (seldom.join(words.where(F.col("n") <= floor), "key")
            .select("uid", F.lit(1).alias("n_rare"), F.log10(F.col("n") + 0.1).alias("rare_logs"), F.lit(0.0).alias("tail_score")))
    # Nor here: sequences under the bar occur fewer than ``bar`` times in all texts.
    tail = (first.select("uid", F.explode(F.arrays_zip("tail", "times")).alias("p")).select("uid", F.col("p.tail").alias("key"), F.col("p.times").alias("times"))
            .join(prices.where(F.col("seen") < bar), "key")
            .select("uid", F.lit(0).alias("n_rare"), F.lit(0.0).alias("rare_logs"), (F.col("times") * F.col("price")).alias("tail_score")))
    rare = (rare.unionByName(tail).groupBy("uid")
            .agg(F.sum("n_rare").alias("n_rare"), F.sum("rare_logs").alias("rare_logs"), F.sum("tail_score").alias("tail_score")))
    known_end = 1 if ends else 0
    joined = first.drop("rare", "tail", "times").join(rare, "uid", "left")
    n_known = F.col("n_often") + F.coalesce("n_rare", F.lit(0)) + known_end
    n_tokens = F.col("n_words") + 1
    logs = (F.col("often_logs") + F.coalesce("rare_logs", F.lit(0.0)) + F.lit(float(np.log10(ends + 0.1)) if ends else 0.0)
            + (n_tokens - n_known) * F.lit(-1.0) - n_tokens * F.log10(F.lit(total + 0.1 * (distinct + 1))))
    return joined.select(F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), n_tokens.cast("long").alias("n_tokens"),
                         n_known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                         logs.alias("base_score"), (F.col("score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"))
