"""Quality by compression: which of two zstandard dictionaries suits a text better.

One dictionary is built from good labelled texts, one from bad ones. A text is cut into
chunks short enough that the dictionary matters, all of it is compressed with both, and the
difference of the sizes per byte of text is calibrated by a logistic curve on labelled rows
that took no part in the dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, ship_package

CHUNK = 2048
LEVEL = 3


def _chunks(text: bytes) -> list[bytes]:
    return [text[i:i + CHUNK] for i in range(0, len(text), CHUNK)]


def make_dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train on."""
    samples = [c for t in texts for c in _chunks(t) if len(c) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def sizes(text: bytes, compressors) -> np.ndarray:
    """Compressed bytes of the whole text under each dictionary."""
    return np.array([sum(len(c.compress(x)) for x in _chunks(text)) for c in compressors], dtype=np.float64)


def compressors(dictionaries: tuple[bytes, bytes]):
    out = []
    for raw in dictionaries:
        data = zstandard.ZstdCompressionDict(raw)
        data.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False))
    return out


def difference(text: bytes, pair) -> float:
    """(size with the bad dictionary - size with the good one) per byte; 0 for an empty text."""
    if not text:
        return 0.0
    good, bad = sizes(text, pair)
    return float((bad - good) / len(text))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50,
                 weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, scale, weights with the intercept last) by Newton steps; ``weights`` of the rows, 1 on average."""
    weights = np.ones(len(x)) if weights is None else weights
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * len(x))
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weights * (p - y)) + penalty * w
        hess = (z * (weights * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def sample_table(docs: DataFrame, labels: DataFrame, training: Column, label: str, id_col: str, text_col: str, label_id: str,
                 rows: int, max_bytes: int, seed: int, scratch: Scratch) -> tuple[DataFrame, dict[int, int]]:
    """Up to ``rows`` labelled training texts per class in a seeded order, together at most ``max_bytes`` per class.

    Returns a table (y, place, text, fold) with fold 0 or 1, one row per id, ``place`` being its place in the order, and how
    many labelled training ids each class has in all. Repeated rows of an id count once. A text longer than ``max_bytes / 16`` is left out, so a class whose
    sample ends before ``rows`` and before its last id has at least 15/16 of ``max_bytes``. The table reads ``scratch``'s table ``label``.
    """
    known = (labels.select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
             .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.where(training).select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    size = F.octet_length("text")
    short = F.when(size <= max_bytes // 16, F.struct(F.xxhash64("text").alias("tid"), size.alias("size")))
    rated = texts.select("id", short.alias("short")).join(known, "id").groupBy("id", "y").agg(F.min("short").alias("short"))
    rated = scratch.write(rated.select("id", "y", "short.tid", "short.size", F.xxhash64("id", F.lit(seed)).alias("place")), label)
    totals = {0: 0, 1: 0} | {r["y"]: r["count"] for r in rated.groupBy("y").count().collect()}
    upto = F.sum("size").over(Window.orderBy("place", "id").rowsBetween(Window.unboundedPreceding, 0))
    zero, one = (rated.where((F.col("y") == y) & F.col("tid").isNotNull()).orderBy("place", "id").limit(rows)
                 .withColumn("bytes", upto).where(F.col("bytes") <= max_bytes).drop("bytes", "size") for y in (0, 1))
    chosen = F.broadcast(zero.unionByName(one))  # narrow, at most 2 * rows
    found = (texts.join(chosen.withColumnRenamed("id", "cid"), (F.col("id") == F.col("cid")) & (F.xxhash64("text") == F.col("tid")))
             .dropDuplicates(["id"]).select("y", "place", "text", F.pmod(F.shiftright("place", 8), F.lit(2)).alias("fold")))
    return found, totals


def sample_rows(docs: DataFrame, labels: DataFrame, training: Column, label: str, id_col: str, text_col: str, label_id: str,
                rows: int, max_bytes: int, seed: int) -> tuple[list[tuple[str, int, int]], dict[int, int]]:
    """The rows of :func:`sample_table` as (text, label, fold), by label and place, and the class counts."""
    scratch = Scratch(docs.sparkSession, "sample")
    found, totals = sample_table(docs, labels, training, label, id_col, text_col, label_id, rows, max_bytes, seed, scratch)
    found = found.collect()
    scratch.drop(label)
    return [(r["text"], r["y"], r["fold"]) for r in sorted(found)], totals


def class_weights(y: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """Weights, 1 on average, by which sampled rows of both classes stand for as many as there are."""
    sampled = np.bincount(y, minlength=2)
    weights = np.array([totals[0], totals[1]], dtype=np.float64)[y] / sampled[y]
    return weights / weights.mean()


def class_share(totals: dict[int, int]) -> float:
    """Share of label 1 among all labelled training ids, away from 0 and 1."""
    return min(max(totals[1] / (totals[0] + totals[1]), 1e-6), 1 - 1e-6)


def _score(dictionaries, curve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = compressors(dictionaries) if dictionaries else None
        centre, scale, w = curve
        for batch in batches:
            x = np.array([[difference((t.as_py() or "").encode(), pair) if pair else 0.0] for t in batch.column(2)]).reshape(-1, 1)
            z = (x - centre) / scale @ w[:-1] + w[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                                             names=["id", "held_out", "score"])
    return run


def zstd_quality(docs: DataFrame, labels: DataFrame, training: Column, label: str = "quality", id_col: str = "doc_id",
                 text_col: str = "text", label_id: str = "doc_id", rows: int = 3000, max_bytes: int = 16 << 20,
                 dictionary_bytes: int = 112_640, threshold: float = 0.5, seed: int = 7) -> DataFrame:
    """Per document: id, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier), ``predicted``.

    ``training`` is a condition on the rows of ``docs``. Fitted on a bounded sample: at most ``rows``
    labelled training texts of each class and ``max_bytes`` of text per class, in a seeded order of ids;
    one half makes the dictionaries, the other the curve, where rows weigh by the class counts of all labelled training ids. Every document is scored whole.

    Defined cases: null and empty text have difference 0 and get the curve's value there; null
    and repeated ids are scored row by row; without rows of both classes the score is the
    share of label 1 among the labelled training ids (0.5 without any). An empty table gives an
    empty result; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    training = F.coalesce(training, F.lit(False))
    found, totals = sample_rows(docs, labels, training, label, id_col, text_col, label_id, rows, max_bytes, seed)
    parts = [[(t.encode(), y) for t, y, f in found if f == fold] for fold in (0, 1)]
    dictionaries, curve = None, (np.zeros(1), np.ones(1), np.zeros(2))
    if all({y for _, y in part} == {0, 1} for part in parts):
        dictionaries = tuple(make_dictionary([t for t, y in parts[0] if y == want], dictionary_bytes) for want in (1, 0))
        pair = compressors(dictionaries)
        x = np.array([[difference(t, pair)] for t, _ in parts[1]])
        y = np.array([y for _, y in parts[1]])
        curve = fit_logistic(x, y.astype(np.float64), weights=class_weights(y, totals))
    elif found:
        share = class_share(totals)
        curve = (np.zeros(1), np.ones(1), np.array([0.0, np.log(share / (1 - share))]))
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), (~training).alias("held_out"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    scored = slim.mapInArrow(_score(dictionaries, curve), f"id {kind}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
