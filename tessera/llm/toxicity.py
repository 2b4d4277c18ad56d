"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Folding maps homoglyphs (accented, full-width, Greek and Cyrillic look-alikes) and digit
substitutions to plain letters, one character for one. The lexicon is learnt from labelled
rows: words whose share among toxic texts is far above their share among others, weighted by
the log ratio. Matches are whole words; those inside an exception phrase don't count. Exceptions
are given, and learnt: a lexicon word with its neighbour, where the two together stand among clean texts
far more often than among toxic ones. The weighted hits and their density per word are calibrated by a logistic curve.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.llm.common import Scratch, ship_package, small_batches
from tessera.llm.zstd_quality import class_share, class_weights, fit_logistic, sample_table

#: Phrases in which lexicon words are harmless.
EXCEPTIONS = ("clown fish", "pond scum", "trash can", "trash bin", "birthday clown", "sore loser")

#: Look-alikes that Unicode does not decompose, with the letter they stand for.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ո": "n", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "ν": "v", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}


def fold_table(digits: bool = True) -> dict[int, str]:
    """One character to one: lower case, look-alikes, compatibility forms, digits."""
    table = {}
    for code in [*range(0x41, 0x5B), *range(0xAA, 0x250), *range(0x370, 0x530), *range(0x1D400, 0x1D6A4), *range(0x1E00, 0x1F00),
                 *range(0x2460, 0x24EA), *range(0xFF21, 0xFF5B)]:
        plain = unicodedata.normalize("NFKD", chr(code))[:1].lower()
        plain = LOOK_ALIKES.get(plain, plain)
        if len(plain) == 1 and plain.isascii() and plain.isalpha():
            table[code] = plain
    table |= {ord(k): v for k, v in DIGITS.items()} if digits else {}
    return table


_TABLES = {True: fold_table(True), False: fold_table(False)}
_WORD = re.compile(r"[^\W\d_]+")
_DIGITS_IN_WORD = re.compile(r"(?<=[^\W\d_])[0-9]|[0-9](?=[^\W\d_])")


def fold(text: str) -> str:
    """Fold a whole text; digits count as letters only where a letter stands next to them or to their run."""
    plain = text.translate(_TABLES[False])
    if _DIGITS_IN_WORD.search(plain):
        plain = plain.translate(_TABLES[True])
    return plain


def automaton(lexicon: dict[str, float], exceptions: Sequence[str]):
    found = ahocorasick.Automaton()
    for word, weight in lexicon.items():
        found.add_word(word, (len(word), weight))
    for phrase in exceptions:
        folded = fold(phrase)
        if folded not in lexicon:
            found.add_word(folded, (len(folded), None))
    found.make_automaton()
    return found


def measure(text: str, found) -> tuple[float, float]:
    """(weighted hits, weighted hits per 100 words) of the whole text."""
    plain = fold(text)
    hits, spared = [], []
    if len(found):
        for end, (size, weight) in found.iter(plain):
            begin = end - size + 1
            if (begin and plain[begin - 1].isalpha()) or (end + 1 < len(plain) and plain[end + 1].isalpha()):
                continue
            (hits if weight is not None else spared).append((begin, end, weight))
    # Exceptions by begin, each with the furthest end so far: one look-up tells whether a hit lies in any.
    spared.sort(key=lambda s: s[0])
    begins, reach = [s[0] for s in spared], []
    for _, end, _ in spared:
        reach.append(max(end, reach[-1]) if reach else end)
    total = 0.0
    for begin, end, weight in hits:
        at = bisect_right(begins, begin)
        if not at or reach[at - 1] < end:
            total += weight
    return total, 100 * total / max(len(text.split()), 1)


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            words = sorted(set(_WORD.findall(fold(batch.column(0)[i].as_py()))))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([batch.column(1)[i].as_py()] * len(words), pa.int32())],
                                             names=["word", "y"])


def _phrases_of(lexicon: frozenset):
    """Once per text, its pairs of neighbouring words, one blank between, of which at least one is in the lexicon."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                plain = fold(batch.column(0)[i].as_py())
                spans = [m.span() for m in _WORD.finditer(plain)]
                phrases = sorted({plain[a:d] for (a, b), (c, d) in zip(spans, spans[1:])
                                  if plain[b:c] == " " and (plain[a:b] in lexicon or plain[c:d] in lexicon)})
                yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array([batch.column(1)[i].as_py()] * len(phrases), pa.int32())],
                                                 names=["word", "y"])
    return run


def _table_of(spark, rows: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Local rows as a table (text, y) without copies."""
    rows = sorted({(t, y) for t, y, _ in rows})
    # From Arrow: a list of rows would start a second set of Python workers, beside those of mapInArrow, to unpickle it.
    return spark.createDataFrame(pa.table({"text": pa.array([t for t, _ in rows], pa.string()), "y": pa.array([y for _, y in rows], pa.int32())}))


def _tell(rows: DataFrame | Sequence[tuple[str, int, int]], spark, terms, sign: int, lift: float, false_words: float, least: int) -> dict[str, float]:
    """Terms that stand ``lift`` times as often in one class of texts (``sign`` 1: toxic, -1: clean), with their log ratio.

    Their log-likelihood ratio must pass Benjamini and Hochberg's bound: at most ``false_words`` of the terms found
    are expected to be there by chance, whatever the number of terms tested. Equal texts count once, so that copies
    of one document are no evidence; a table (text, y) holds each once already. Only terms on the right side of the
    ratio reach the driver; their number is bounded by the sample.
    """
    table = rows if isinstance(rows, DataFrame) else _table_of(spark, rows)
    of = {r["y"]: r["count"] for r in table.groupBy("y").count().collect()}
    toxic, clean = of.get(1, 0), of.get(0, 0)
    if not toxic or not clean:
        return {}
    table = table.select("text", "y").repartition(spark.sparkContext.defaultParallelism)
    a, b = F.col("a"), F.col("b")
    counts = (table.mapInArrow(terms, "word string, y int").groupBy("word").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
              .where((a + b >= least) & (F.length("word") >= 3)))
    ratio = ((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (clean + 1))
    part = lambda c, of: c * F.log((c + 1e-9) * (toxic + clean) / ((a + b) * of))
    support = 2 * (part(a, toxic) + part(b, clean))
    scored = counts.select("word", (a if sign > 0 else b).alias("own"), (sign * F.log(ratio)).alias("ratio"), support.alias("support"))
    found = scored.agg(F.count("*").alias("n"), F.collect_list(F.when((F.col("ratio") > 0) & (F.col("support") > 0), F.struct("*"))).alias("words")).first()
    words = sorted(found["words"], key=lambda r: (-r["support"], r["word"]))
    chance = [math.erfc(math.sqrt(r["support"] / 2)) / 2 for r in words]  # one-sided
    passed = max((i for i, p in enumerate(chance, 1) if p <= false_words * i / found["n"]), default=0)
    return {r["word"]: r["ratio"] for r in words[:passed] if r["own"] >= least and r["ratio"] >= math.log(lift) - 1e-12}


def learn_lexicon(spark, rows: DataFrame | Sequence[tuple[str, int, int]], lift: float, false_words: float, least: int) -> dict[str, float]:
    """Words in at least ``least`` toxic texts that stand ``lift`` times as often there as in others, with weights."""
    return _tell(rows, spark, _words_of, 1, lift, false_words, least)


def learn_exceptions(spark, rows: DataFrame | Sequence[tuple[str, int, int]], lexicon: dict[str, float], lift: float, false_words: float,
                     least: int) -> tuple[str, ...]:
    """Phrases of two words, one of them in the lexicon, that stand ``lift`` times as often in clean texts as in toxic ones."""
    return tuple(sorted(_tell(rows, spark, _phrases_of(frozenset(lexicon)), -1, lift, false_words, least))) if lexicon else ()


class Fitted(NamedTuple):
    """A lexicon with weights, the exception phrases, and the curve over (hits, density)."""
    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[np.ndarray, np.ndarray, np.ndarray]


def _score(fitted: Fitted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(fitted.lexicon, fitted.exceptions)
        centre, scale, w = fitted.curve
        for batch in batches:
            x = np.array([_features(*measure(t.as_py() or "", found)) for t in batch.column(1)]).reshape(-1, 2)
            z = (x - centre) / scale @ w[:-1] + w[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["row", "score"])
    return run


def _measured(lexicon: dict[str, float], exceptions: Sequence[str]):
    """Per text of the sample its label, the places of its ids and the two features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(lexicon, exceptions)
        for batch in batches:
            x = np.array([_features(*measure(t.as_py(), found)) for t in batch.column(0)]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(x[:, 0]), pa.array(x[:, 1])],
                                             names=["y", "places", "hits", "density"])
    return run


def score_rows(docs: DataFrame, fitted: Fitted, text_col: str = "text") -> DataFrame:
    """(row, score): every row of ``docs`` as a struct of all its columns, and its score."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_score(fitted), StructType([rows.schema["row"], StructField("score", DoubleType())]))


def _features(total: float, density: float) -> tuple[float, float]:
    return np.log1p(total), np.log1p(density)


def fit_toxicity(docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic", id_col: str = "doc_id",
                 text_col: str = "text", label_id: str = "doc_id", rows: int = 3000, max_bytes: int = 16 << 20,
                 lift: float = 8.0, false_words: float = 0.01, least: int = 3,
                 exceptions: Sequence[str] = EXCEPTIONS, seed: int = 5) -> Fitted:
    """Lexicon and curve from a bounded sample.

    At most ``rows`` labelled training texts of each class and ``max_bytes`` of text per class, in a
    seeded order of ids; the curve's rows weigh by the class counts of all labelled training ids. The sample is a
    table: its texts never reach the driver, only terms with their counts and two numbers per row of the sample do. Without
    rows of both classes, or without telling words (an id with conflicting labels counts as label 1), the lexicon is empty and every score is the
    share of label 1 among the labelled training ids (0 without any); nothing is toxic then.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    scratch = Scratch(spark, "toxicity")
    found, totals = sample_table(docs, labels, F.coalesce(training, F.lit(False)), label, id_col, text_col, label_id, rows, max_bytes, seed, scratch)
    found = scratch.write(found.groupBy("text", "y").agg(F.collect_list("place").alias("places")), "texts")
    scratch.drop(label)
    lexicon = learn_lexicon(spark, found, lift, false_words, least)
    exceptions = (*exceptions, *learn_exceptions(spark, found, lexicon, lift, false_words, least))
    if lexicon:
        measured = (found.select("text", "y", "places").repartition(spark.sparkContext.defaultParallelism)
                    .mapInArrow(_measured(lexicon, exceptions), "y int, places array<bigint>, hits double, density double"))
        measured = sorted(measured.select("y", F.explode("places").alias("place"), "hits", "density").collect())
        x = np.array([(r["hits"], r["density"]) for r in measured])
        y = np.array([r["y"] for r in measured])
        curve = fit_logistic(x, y.astype(np.float64), weights=class_weights(y, totals))
    else:
        curve = (np.zeros(2), np.ones(2), np.array([0.0, 0.0, -30.0 if found.isEmpty() else _logit(class_share(totals))]))
    scratch.drop("texts")
    return Fitted(lexicon, tuple(exceptions), curve)


def toxicity(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.3, **fit) -> DataFrame:
    """Per document: id, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier), ``predicted``.

    ``training`` is a condition on the rows of ``docs``; further arguments go to :func:`fit_toxicity`. Every
    document is scored whole.

    Defined cases: null and empty text have no hits and get the curve's value there; null and
    repeated ids are scored row by row; with an empty lexicon nothing is predicted toxic; an empty table gives an empty result; other columns are ignored.
    """
    fitted = fit_toxicity(docs, labels, training, id_col=id_col, text_col=text_col, **fit)
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), (~F.coalesce(training, F.lit(False))).alias("held_out"),
                       F.col(f"`{text_col}`").alias("text"))
    scored = score_rows(slim.select("id", "held_out", "text"), fitted, "text")
    return scored.select(F.col("row.id").alias(id_col), "row.held_out", "score",
                         (F.lit(bool(fitted.lexicon)) & (F.col("score") >= threshold)).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, fitted: Fitted, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay. An empty lexicon drops nothing."""
    if not fitted.lexicon:
        return docs
    return score_rows(docs, fitted, text_col).where(F.col("score") < threshold).select("row.*")


def _logit(p: float) -> float:
    p = min(max(float(p), 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))
