"""Byte-level dedup by distributed prefix doubling.

Positions get ranks by their next bytes; ranks of twice the length come from the pair
(rank here, rank one length further on). Spark groups the pairs, positions whose pair is unique
leave, and the rest go on until the rank covers ``length`` bytes. A rank is the fingerprint
of the bytes it stands for, so every task names equal strings alike without asking the others,
and the pair at offset ``h`` is read from the text itself. For 100 bytes:

1. *25 + 25.* Of all windows of 100 bytes, neighbours share one sampled position: the
   50-byte string with the smallest rank inside them. Equal windows sample the same place. Only
   sampled positions (some 4 %) are ranked; those whose rank no other document holds leave.
2. *Runs.* The consecutive windows that share a sampled position are one run, ranked as a whole
   by the pair of its two halves. A run that an earlier document holds as a whole is repeated,
   all its windows at once. Where all runs around a sampled string are equal, nothing
   is left to ask.
3. *50 + 50.* The windows of the remaining runs (the edges of repeated passages) are ranked one
   by one by the pair (rank at s, rank at s + 50).

Repeats inside one document need no exchange: the task that cuts the text finds them by the
same steps. Documents whose whole text an earlier one holds are known by a digest and take no
part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, mark_maybe, maybe_in, text_key
from tessera.llm.tokens import _byte_table, _layout, _powers, mix, row_slices, window_owner

PIECE_BYTES = 1 << 20
_INDEX = np.uint64((1 << 24) - 1)  # a piece is shorter than 16 MB


class Piece(NamedTuple):
    """Bytes of rows ``first..last``, or of one part of a long row that begins at ``base``."""
    first: int
    last: int
    base: int
    data: np.ndarray
    offsets: np.ndarray


class Runs(NamedTuple):
    """Windows that share a sampled position: its rank, row, and first and last window start (in the piece)."""
    rank: np.ndarray
    row: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    at: np.ndarray


def piece_groups(column: pa.Array, length: int) -> Iterator[list[Piece]]:
    """Pieces of at most ``PIECE_BYTES``; a longer row is a group of overlapping pieces of its own."""
    data, offsets = _layout(column)
    for first, last in row_slices(offsets, PIECE_BYTES):
        lo, hi = int(offsets[first]), int(offsets[last])
        if hi - lo <= PIECE_BYTES:
            yield [Piece(first, last, 0, data[lo:hi], offsets[first:last + 1] - lo)]
        else:
            ends = [(a, min(hi - lo, a + PIECE_BYTES + length - 1)) for a in range(0, hi - lo - length + 1, PIECE_BYTES)]
            yield [Piece(first, last, a, data[lo + a:lo + e], np.array([0, e - a])) for a, e in ends]


class Ranks:
    """Fingerprints of any substring of a piece from one prefix sum."""

    def __init__(self, piece: Piece):
        powers, self.inverse = _powers(max(len(piece.data), 1))
        self.sums = np.zeros(len(piece.data) + 1, dtype=np.uint64)
        np.cumsum(_byte_table(False, 3)[piece.data] * powers[:len(piece.data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.inverse[begin])

    def everywhere(self, length: int) -> np.ndarray:
        n = max(len(self.sums) - length, 0)
        return mix((self.sums[length:length + n] - self.sums[:n]) * self.inverse[:n])

    def pair(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the two halves."""
        middle = begin + (end - begin) // 2
        return self.of(begin, middle), self.of(middle, end)


def _smallest(values: np.ndarray, run: int) -> np.ndarray:
    """Minimum of ``run`` consecutive values from each position on, by doubling."""
    span = 1
    while span * 2 <= run:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = run - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def runs_of(piece: Piece, ranks: Ranks, length: int) -> Runs:
    half = length // 2
    starts = window_owner(piece.offsets, length)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return Runs(np.zeros(0, np.uint64), empty, empty, empty, empty)
    grams = ranks.everywhere(half)
    keys = (grams & ~_INDEX) | np.arange(len(grams), dtype=np.uint64)
    at = (_smallest(keys, length - half + 1)[starts] & _INDEX).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(starts)) - 1
    lo, at = starts[begin], at[begin]
    row = np.searchsorted(piece.offsets, lo, side="right") - 1 + piece.first
    return Runs(grams[at], row, lo, starts[end], at)


def _batches(arrays: list, names: list[str], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_arrays(arrays, names=names)
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values)


def _sampled(length: int):
    """Ranks of the sampled positions, once per text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in piece_groups(batch.column("text"), length):
                for piece in group:
                    runs = runs_of(piece, Ranks(piece), length)
                    order = np.lexsort((runs.row, runs.rank))
                    rank, row = runs.rank[order], runs.row[order]
                    new = np.ones(len(rank), dtype=bool)
                    new[1:] = (rank[1:] != rank[:-1]) | (row[1:] != row[:-1])
                    yield from _batches([_long(rank[new])], ["h"])
    return run


def _run_rows(length: int):
    """Every run: document, rank of its sampled string, rank pair of the whole run, first and last window start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in piece_groups(batch.column("text"), length):
                for piece in group:
                    ranks = Ranks(piece)
                    r = runs_of(piece, ranks, length)
                    one, two = ranks.pair(r.lo, r.hi + length)
                    one = mix(one ^ (r.at - r.lo).astype(np.uint64), 5)
                    two = mix(two ^ (r.hi - r.lo).astype(np.uint64), 6)
                    where = pa.array(r.row)
                    shift = piece.base - piece.offsets[r.row - piece.first]
                    yield from _batches([batch.column("id").take(where), batch.column("tag").take(where), _long(r.rank), _long(one),
                                         _long(two), pa.array(r.lo + shift), pa.array(r.hi + shift)],
                                        ["id", "tag", "h", "c1", "c2", "lo", "hi"])
    return run


def _listed(spots: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs (first start, last start) kept for a row, in order."""
    if not spots[i].is_valid:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values = spots[i].values
    lo, hi = np.asarray(values.field("lo")), np.asarray(values.field("hi"))
    order = np.argsort(lo, kind="stable")
    return lo[order], hi[order]


def _expand(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All integers of the closed ranges, range by range."""
    n = hi - lo + 1
    return np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)


def _window_rows(length: int):
    """The windows of the runs still open, each with the rank pair of its two halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in piece_groups(batch.column("text"), length):
                for piece in group:
                    ranks, starts, rows = Ranks(piece), [], []
                    for i in range(piece.first, piece.last):
                        lo, hi = _listed(batch.column("spots"), i)
                        # A run belongs to the piece in which it begins; pieces cut runs at their ends.
                        mine = (lo >= piece.base) & (lo < piece.base + PIECE_BYTES)
                        s = _expand(lo[mine], hi[mine]) - piece.base + piece.offsets[i - piece.first]
                        starts.append(s)
                        rows.append(np.full(len(s), i))
                    s, where = np.concatenate(starts).astype(np.int64), pa.array(np.concatenate(rows).astype(np.int64))
                    one, two = ranks.pair(s, s + length)
                    place = s - piece.offsets[np.asarray(where) - piece.first] + piece.base
                    yield from _batches([batch.column("id").take(where), batch.column("tag").take(where), _long(one), _long(two),
                                         pa.array(place)], ["id", "tag", "k1", "k2", "s"])
    return run


def _own_repeats(group: list[Piece], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of the windows that also start earlier in their own row.

    Only runs whose sampled string stands twice in the row are looked at window by window.
    """
    found = [(runs_of(p, Ranks(p), length), p) for p in group]
    rank = np.concatenate([r.rank for r, _ in found])
    row = np.concatenate([r.row for r, _ in found])
    order = np.lexsort((rank, row))
    same = (rank[order][1:] == rank[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(rank), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    if not twice.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts, seen = [], 0
    for r, p in found:
        mine = twice[seen:seen + len(r.rank)]
        seen += len(r.rank)
        if not mine.any():
            continue
        s = _expand(r.lo[mine], r.hi[mine])
        owner = np.repeat(r.row[mine], (r.hi - r.lo + 1)[mine])
        one, two = Ranks(p).pair(s, s + length)
        parts.append((owner, one, two, s - p.offsets[owner - p.first] + p.base))
    owner, one, two, s = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((s, two, one, owner))
    owner, one, two, s = owner[order], one[order], two[order], s[order]
    again = np.zeros(len(s), dtype=bool)
    again[1:] = (owner[1:] == owner[:-1]) & (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & (s[1:] != s[:-1])
    return owner[again], s[again]


def _gone(n: int, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    """Bytes covered by windows that start in the closed ranges."""
    depth = np.zeros(n + 1, dtype=np.int32)
    np.add.at(depth, lo, 1)
    np.add.at(depth, hi + length, -1)
    return np.cumsum(depth[:-1]) > 0


def _cut(length: int, digest: bool):
    """Per row n_bytes, n_removed, n_spans and what is left: its SHA-256, or the bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spots, copy = batch.column("text"), batch.column("spots"), batch.column("copy")
            sizes, removed, spans, out = [], [], [], []
            for group in piece_groups(texts, length):
                owner, starts = _own_repeats(group, length)
                order = np.argsort(owner, kind="stable")
                owner, starts = owner[order], starts[order]
                for i in range(group[0].first, group[0].last):
                    text = texts[i].as_py()
                    lo, hi = _listed(spots, i)
                    a, b = np.searchsorted(owner, [i, i + 1])
                    n = len(text)
                    if copy[i].as_py() and n >= length:
                        gone, n_spans, kept = n, 1, b""
                    elif len(lo) or b > a:
                        mask = _gone(n, np.concatenate([lo, starts[a:b]]), np.concatenate([hi, starts[a:b]]), length)
                        gone, n_spans = int(mask.sum()), int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                        kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
                    else:
                        gone, n_spans, kept = 0, 0, text
                    sizes.append(n)
                    removed.append(gone)
                    spans.append(n_spans)
                    out.append(hashlib.sha256(kept).hexdigest() if digest else kept)
            names = [n for n in batch.schema.names if n not in ("text", "spots", "copy")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(out, pa.string() if digest else pa.binary())], names=[*names, "n_bytes", "n_removed", "n_spans", "out"])
    return run


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), text_key(text).alias("tag"), text.cast("binary").alias("text"))


def _by_row(runs: DataFrame) -> DataFrame:
    """The runs of each text as one list; at most as long as the text."""
    return runs.groupBy("id", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("spots"))


def _with_spots(slim: DataFrame, spots: DataFrame) -> DataFrame:
    return maybe_in(slim, "id", spots, "id").join(spots, ["id", "tag"])


def find_repeats(slim: DataFrame, scratch: Scratch, length: int) -> tuple[DataFrame, DataFrame]:
    """(copies, spots): texts (id, tag) that a smaller id holds as a whole; per other text the
    runs of windows that also start in a document with a smaller id."""
    kind = slim.schema["id"].dataType.simpleString()
    rows = slim.where("id is not null").where(F.length("text") >= length)
    digests = rows.select("id", "tag", F.sha2("text", 256).alias("sha"))
    first = digests.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("sha", "first")
    first = scratch.write(first, "firsts")
    copies = scratch.write(maybe_in(digests, "sha", first, "sha").join(first, "sha").where("first < id").select("id", "tag").distinct(), "copies")
    marked = mark_maybe(rows, "id", copies, "id")
    live = (marked.where("not _maybe").drop("_maybe")
            .unionByName(marked.where("_maybe").drop("_maybe").join(copies, ["id", "tag"], "left_anti")))

    often = scratch.write(live.mapInArrow(_sampled(length), "h bigint").groupBy("h").count().where("count > 1").select("h"), "often")
    runs = live.mapInArrow(_run_rows(length), f"id {kind}, tag bigint, h bigint, c1 bigint, c2 bigint, lo bigint, hi bigint")
    runs = scratch.write(maybe_in(runs, "h", often, "h").join(often, "h", "left_semi"), "runs")
    scratch.drop("often")

    equal = runs.groupBy("h", "c1", "c2").agg(F.min("id").alias("first"))
    equal = scratch.write(equal, "equal")
    mixed = equal.groupBy("h").agg(F.count("*").alias("kinds"))
    judged = (runs.join(equal.join(mixed, "h"), ["h", "c1", "c2"]).where("first < id or kinds > 1")
              .select("id", "tag", "lo", "hi", (F.col("first") < F.col("id")).alias("repeated")))
    judged = scratch.write(judged, "judged")
    scratch.drop("runs", "equal")

    near = _with_spots(slim, scratch.write(_by_row(judged.where("not repeated")), "open"))
    windows = scratch.write(near.mapInArrow(_window_rows(length), f"id {kind}, tag bigint, k1 bigint, k2 bigint, s bigint"), "windows")
    again = windows.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("k1", "k2", "first")
    again = scratch.write(again, "again")
    edges = maybe_in(windows, "k1", again, "k1").join(again, ["k1", "k2"]).where("first < id").select("id", "tag", F.col("s").alias("lo"), F.col("s").alias("hi"))
    spots = scratch.write(_by_row(judged.where("repeated").select("id", "tag", "lo", "hi").unionByName(edges)), "spots")
    scratch.drop("judged", "open", "windows", "again", "firsts")
    return copies, spots


def _found(rows: DataFrame, copies: DataFrame, spots: DataFrame) -> DataFrame:
    """``rows`` (with id and tag) and their ``copy`` and ``spots``; only rows that may have some are shuffled."""
    touched = copies.select("id").unionByName(spots.select("id"))
    marked = mark_maybe(rows, "id", touched, "id")
    calm = marked.where("not _maybe").withColumn("copy", F.lit(False)).withColumn("spots", F.lit(None).cast(spots.schema["spots"].dataType))
    near = (marked.where("_maybe").join(copies.withColumn("copy", F.lit(True)), ["id", "tag"], "left").join(spots, ["id", "tag"], "left")
            .withColumn("copy", F.coalesce("copy", F.lit(False))))
    return calm.unionByName(near).drop("_maybe")


def byte_repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Per document: ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept_sha256``.

    A byte is removed if it lies in a ``length``-byte string that also starts earlier: in a
    document with a smaller id, or earlier in the same text; overlaps count. Strings are judged
    on the input, not on what is left. ``length`` is at least 2.

    Defined cases: null text is empty. A null id is neither smaller nor larger than any: its
    text loses only what it repeats itself. Rows with the same id never remove each other's
    bytes; they are told apart by their text, and equal rows get equal results. An empty table
    gives an empty result. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    slim = _slim(docs, id_col, text_col)
    copies, spots = find_repeats(slim, scratch, length)
    kind = docs.schema[id_col].dataType.simpleString()
    out = _found(slim, copies, spots).mapInArrow(
        _cut(length, True), f"id {kind}, tag bigint, n_bytes bigint, n_removed bigint, n_spans bigint, out string")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", F.col("out").alias("kept_sha256"))


def cut_byte_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """``docs`` and ``kept_bytes`` (binary), ``n_bytes``, ``n_removed``, ``n_spans`` (see :func:`byte_repeat_report`).

    What is left of a text stays binary: a cut may fall inside a character. All rows and columns stay;
    columns with the names of the four added ones are not allowed.
    """
    added = {"kept_bytes", "n_bytes", "n_removed", "n_spans"} & set(docs.columns)
    if added:
        raise ValueError(f"columns exist already: {sorted(added)}")
    scratch = Scratch(docs.sparkSession, "suffix")
    slim = _slim(docs, id_col, text_col)
    copies, spots = find_repeats(slim, scratch, length)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col(f"`{id_col}`").alias("id"),
                       text_key(text).alias("tag"), text.cast("binary").alias("text"))
    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)]
    found = _found(rows, copies, spots).select(*[f"c{i}" for i in range(len(fields))], "id", "tag", "text", "spots", "copy")
    out = found.mapInArrow(_cut(length, False), ", ".join([*fields, f"id {kind}", "tag bigint", "n_bytes bigint", "n_removed bigint",
                                                           "n_spans bigint", "out binary"]))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("out").alias("kept_bytes"),
                      "n_bytes", "n_removed", "n_spans")
