"""Substring dedup by level-wise doubling.

Target windows of ``window`` words are found through windows of a quarter and half that
length (13, 25, 50). Only windows that repeat at one length are extended to twice it, until
none survives or the target length is reached:

* Below the target length a level looks at one short window per target window, the one with
  the smallest hash among those inside it. Equal target windows pick the same one, so a
  target window can only repeat if its pick does, and a few percent of positions stand
  for all.
* At the target length every start that survived is compared, by 128 bits of its words: two
  64-bit window hashes over word hashes from two different byte tables.

Documents with the same words as one with a smaller id are known from a digest in the first
pass and take no part: whatever they hold starts in that document too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, mark_maybe, maybe_in, small_batches, text_key
from tessera.llm.tokens import Slice, window_owner, windows, word_slices

_PLACE_BITS = 40  # a location is (23 bits of the text's hash, word position)
_INDEX = np.uint64((1 << 28) - 1)


def lengths(window: int) -> list[int]:
    """Window lengths of the levels, each at most twice the one before."""
    out = [window]
    while out[0] > 16:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _smallest(values: np.ndarray, run: int) -> np.ndarray:
    """Minimum of ``run`` consecutive values from each position on."""
    span = 1
    while span * 2 <= run:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = run - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def picks(s: Slice, window: int, length: int, begins: np.ndarray) -> np.ndarray:
    """For each target window (by its begin) the place of its picked ``length``-word window."""
    if not len(begins):
        return begins
    h = windows(s.hashes, length)
    keys = (h & ~_INDEX) | np.arange(len(h), dtype=np.uint64)
    return (_smallest(keys, window - length + 1)[begins] & _INDEX).astype(np.int64)


def both_slices(texts: pa.Array) -> Iterator[tuple[Slice, Slice]]:
    """The slices of a column with word hashes from two byte tables, so that neither follows from the other."""
    return zip(word_slices(texts), word_slices(texts, salt=1))


def _rows_of(s: Slice, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(s.starts, places, side="right") - 1


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _bytes(value) -> bytes:
    return (value.as_py() or "").encode()


def _first_pass(window: int, length: int):
    """Per text its words and digest, and the picks of all its target windows; second hashes if they are the targets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for s, other in both_slices(texts) if length == window else ((s, None) for s in word_slices(texts)):
                at = np.unique(picks(s, window, length, window_owner(s.starts, window)))
                owner = _rows_of(s, at)
                ends = np.searchsorted(owner, np.arange(s.last - s.first + 1)).astype(np.int32)
                h = windows(s.hashes, length)[at] if len(at) else np.zeros(0, np.uint64)
                g = windows(other.hashes, length)[at] if other and len(at) else np.zeros(len(at), np.uint64)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x))
                         for x in (h.view(np.int64), g.view(np.int64), at - s.starts[owner] if len(at) else at)][::1 if other else 2]
                digests = [_digest(_bytes(texts[i]).split()) for i in range(s.first, s.last)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.last - s.first), batch.column(1).slice(s.first, s.last - s.first),
                     pa.array(np.diff(s.starts)), pa.array(digests), *lists],
                    names=["id", "tag", "n_words", "sha", "h", *(["g"] if other else []), "at"])
    return run


def _own_places(tags: pa.Array, spots: pa.Array, i: int) -> np.ndarray:
    """Positions of the row's text among the locations kept for its id."""
    values = np.asarray(spots[i].values) if spots[i].is_valid else np.zeros(0, np.int64)
    return values[(values >> _PLACE_BITS) == tags[i].as_py()] & ((1 << _PLACE_BITS) - 1)


def _next_pass(window: int, before: int, length: int):
    """Target windows whose pick at the level before survived; their picks, or all of them at the last level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, spots = batch.column(1), batch.column(3)
            for s, other in both_slices(batch.column(2)) if length == window else ((s, None) for s in word_slices(batch.column(2))):
                alive = np.zeros(len(s.hashes) + 1, dtype=bool)
                for i in range(s.first, s.last):
                    alive[_own_places(tags, spots, i) + s.starts[i - s.first]] = True
                begins = window_owner(s.starts, window)
                begins = begins[alive[picks(s, window, before, begins)]] if len(begins) else begins
                at = begins if length == window else np.unique(picks(s, window, length, begins))
                if not len(at):
                    continue
                owner = _rows_of(s, at)
                ids = batch.column(0).take(pa.array(owner + s.first))
                place = (np.asarray(tags.take(pa.array(owner + s.first))) << _PLACE_BITS) | (at - s.starts[owner])
                second = windows(other.hashes, length)[at] if other else np.zeros(len(at), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(windows(s.hashes, length)[at].view(np.int64)), pa.array(second.view(np.int64)), ids, pa.array(place)],
                    names=["h", "g", "id", "place"])
    return run


def _keep(text: bytes, begins: np.ndarray, window: int) -> tuple[int, list[bytes]]:
    words = text.split()
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, begins, 1)
    np.add.at(depth, np.minimum(begins + window, len(words)), -1)
    gone = np.cumsum(depth[:-1]) > 0
    return int(gone.sum()), [w for w, g in zip(words, gone) if not g]


def _cut(window: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, out = [], []
            for i in range(batch.num_rows):
                begins = _own_places(batch.column("tag"), batch.column("spots"), i)
                text = batch.column("text")[i]
                n, kept = _keep(_bytes(text), begins, window)
                removed.append(n)
                out.append(_digest(kept) if digest else b" ".join(kept).decode() if n else text.as_py())
            names = [n for n in batch.schema.names if n not in ("text", "spots")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(removed, pa.int64()), pa.array(out, pa.string())],
                                             names=[*names, "n_removed", "out"])
    return run


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    tag = F.pmod(text_key(text), F.lit(1 << 23))
    return docs.select(F.col(f"`{id_col}`").alias("id"), tag.alias("tag"), text.alias("text"))


def _firsts(scratch: Scratch, rows: DataFrame, name: str) -> DataFrame:
    """(h, g, first): windows found in several documents, with the smallest id."""
    found = (rows.groupBy("h", "g").agg(F.min("id").alias("first"), F.max("id").alias("last"))
             .where("first < last").select("h", "g", "first"))
    return scratch.write(found, name)


def _by_id(places: DataFrame) -> DataFrame:
    return places.groupBy("id").agg(F.collect_set("place").alias("spots"))


def find_repeats(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(texts, spots): per row id, tag, n_words, sha and ``copy`` (same words in a smaller id);
    per id the locations of its windows that start in a document with a smaller id."""
    small_batches(docs.sparkSession)
    slim = _tagged(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    steps = lengths(window)
    single = len(steps) == 1
    seen = scratch.write(slim.mapInArrow(_first_pass(window, steps[0]), f"id {kind}, tag bigint, n_words bigint, sha string, h array<bigint>, "
                                         + ("g array<bigint>, " if single else "") + "at array<bigint>"), "texts")
    copies = (seen.where(f"id is not null and n_words >= {window}").groupBy("sha")
              .agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("sha", "first"))
    copies = scratch.write(copies, "copies")
    known = seen.join(copies, "sha", "left").withColumn("copy", F.coalesce(F.col("id") > F.col("first"), F.lit(False)))
    rows = (known.where("not copy and id is not null").select("id", "tag", F.explode(F.arrays_zip("h", *(["g"] if single else []), "at")).alias("p"))
            .select(F.col("p.h").alias("h"), (F.col("p.g") if single else F.lit(0).cast("long")).alias("g"), "id",
                    F.expr(f"shiftleft(tag, {_PLACE_BITS}) | p.at").alias("place")))
    if single:  # the only level: all its windows are targets, and picks hold each of them
        return known.drop("h", "g", "at", "first"), _by_id(rows.join(_firsts(scratch, rows, "firsts"), ["h", "g"]).where("first < id"))
    for before, length in zip(steps, steps[1:]):
        firsts = _firsts(scratch, rows, f"firsts-{before}")
        spots = scratch.write(_by_id(rows.join(firsts, ["h", "g"])), f"spots-{before}")
        near = maybe_in(slim, "id", spots, "id").join(spots, "id").select("id", "tag", "text", "spots")
        rows = scratch.write(near.mapInArrow(_next_pass(window, before, length), f"h bigint, g bigint, id {kind}, place bigint"), f"rows-{length}")
        scratch.drop(f"firsts-{before}", f"spots-{before}", *([f"rows-{before}"] if before != steps[0] else []))
    firsts = _firsts(scratch, rows, "firsts")
    spots = scratch.write(_by_id(rows.join(firsts, ["h", "g"]).where("first < id")), "spots")
    scratch.drop("firsts", f"rows-{window}")
    return known.select("id", "tag", "n_words", "sha", "copy"), spots


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """Per document: ``n_words``, ``n_removed`` and ``kept_sha256`` (SHA-256 of the kept words, one space between).

    A word is removed if it lies in a ``window``-word sequence that also starts in a document
    with a smaller id. Windows are judged on the input, not on what is left.

    Defined cases: null text has no words. A null id is neither smaller nor larger than any:
    its document stays whole and removes nothing. Rows with the same id never remove each
    other's words; they are told apart by their text. An empty table gives an empty result. Other
    columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    texts, spots = find_repeats(docs, scratch, id_col, text_col, window)
    kind = docs.schema[id_col].dataType.simpleString()
    slim = _tagged(docs, id_col, text_col)
    near = maybe_in(slim, "id", spots, "id").join(spots, "id").select("id", "tag", "text", "spots")
    cut = near.mapInArrow(_cut(window, True), f"id {kind}, tag bigint, n_removed bigint, out string").distinct()
    cut = scratch.write(cut.withColumnRenamed("id", "cid").withColumnRenamed("tag", "ctag"), "cut")
    out = texts.join(cut, F.col("id").eqNullSafe(F.col("cid")) & (F.col("tag") == F.col("ctag")), "left")
    return out.select(
        F.col("id").alias(id_col), "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("out", "sha")).alias("kept_sha256"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """``docs`` with repeated windows cut out of the texts (see :func:`repeat_report`); all rows and columns stay.

    A text that loses words becomes its kept words with one space between them; others don't change.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    texts, spots = find_repeats(docs, scratch, id_col, text_col, window)
    whole = scratch.write(texts.where("copy").select("id", "tag").distinct(), "whole")
    touched = spots.select("id").unionByName(whole.select("id"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"),
                      F.pmod(text_key(text), F.lit(1 << 23)).alias("tag"), text.alias("text"))
    marked = mark_maybe(row, "id", touched, "id")
    same = marked.where("not _maybe").select("row.*")
    near = (marked.where("_maybe").join(spots, "id", "left")
            .join(whole.withColumn("copy", F.lit(True)), ["id", "tag"], "left"))
    fields = [f for f in docs.schema.fields if f.name != text_col]
    near = near.select(*[F.col(f"row.`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)],
                       F.when(F.col(f"row.`{text_col}`").isNotNull(), F.when(F.col("copy"), "").otherwise(F.col("text"))).alias("text"),
                       "tag", F.when(F.col("copy"), F.lit(None)).otherwise(F.col("spots")).alias("spots"))
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)], "tag bigint, n_removed bigint, out string"])
    cut = near.mapInArrow(_cut(window, False), schema)
    cut = cut.select(*[F.col("out").alias(c) if c == text_col else F.col(f"c{[f.name for f in fields].index(c)}").alias(c) for c in docs.columns])
    return same.unionByName(cut)
