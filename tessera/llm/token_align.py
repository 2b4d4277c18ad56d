"""Alignment of two tokenizers by galloping intersection of their byte ends.

Both tokenizers cut the same bytes. Per document the shorter list of token ends drives: from the
place of the last end every next one is looked up in the longer list by steps that double, then
by halving inside the last step. Ends found in both lists cut the tokens into groups; the
difference of the ranks of a token's two ends is the range of tokens of the other side that it
overlaps (its links).

How many documents hold a pair of ids linked is counted by Spark over all documents. The most
frequent pairs (at most ``head`` of them, some 20 MB) go to the tasks as a sorted array; all
other pairs are joined by shuffle. The two ways give the same numbers.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch

SLICE_BYTES = 1 << 20
TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
#: The published split pattern of this byte-level BPE family (fixed value).
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of blanks from this length on go to the slower library: the faster one's pattern matcher recurses per blank.
LONG_BLANKS = re.compile(r"\s{20000}")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest for 256 and on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Encodes with a byte-level BPE file; ``table`` has the bytes of every id."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer
        spec = json.loads(file)
        letters = byte_alphabet()
        vocab = {t["content"]: t["id"] for t in spec["added_tokens"]} | spec["model"]["vocab"]
        self.table = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.table[i] = bytes(letters[c] for c in token)
        self.slow = Tokenizer.from_buffer(file)
        self.slow.encode_special_tokens = True
        self.fast = self._ranked(spec)

    def _ranked(self, spec: dict):
        """The same merges as a rank table, if ids are in merge order and the file adds no steps of its own."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        in_order = all(spec["model"]["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        split = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        plain = not spec["normalizer"] and split.items() <= (spec["pre_tokenizer"] or {}).items()
        if not in_order or not plain or spec["model"].get("ignore_merges"):
            return None
        import tiktoken
        ranks = {self.table[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast and not LONG_BLANKS.search(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


class Pieces:
    """Encodes with a piece model; it adds the space before the text itself."""

    def __init__(self, file: bytes):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_proto=file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.table = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-Fa-f]{2}>", p) else p.replace("▁", " ").encode()
                      for p in pieces]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


_LOADED: dict = {}


def load(kind: type, file: bytes):
    """One tokenizer per worker process and file."""
    key = (kind, hashlib.md5(file).digest())
    if key not in _LOADED:
        _LOADED[key] = kind(file)
    return _LOADED[key]


def gallop(short: np.ndarray, long: np.ndarray, stride: int = 64) -> np.ndarray:
    """For each end in ``short`` the place of the first end of ``long`` that is not smaller.

    Both ascend, and the last ends are equal. Every ``stride``-th end is placed first; those
    after it start from there, in steps that double until they pass their end, then halve the last step.
    All ends take their steps side by side.
    """
    if not len(short):
        return np.zeros(0, np.int64)
    lo = np.repeat(np.searchsorted(long, short[::stride]), stride)[:len(short)] - 1  # long[lo] is smaller, or lo is -1
    hi = lo + 1
    step = 1
    moving = np.flatnonzero(long[hi] < short)
    while len(moving):
        lo[moving] = hi[moving]
        step *= 2
        hi[moving] = np.minimum(hi[moving] + step, len(long) - 1)
        moving = moving[long[hi[moving]] < short[moving]]
    open_ = np.flatnonzero(hi - lo > 1)
    while len(open_):
        middle = (lo[open_] + hi[open_]) // 2
        below = long[middle] < short[open_]
        lo[open_] = np.where(below, middle, lo[open_])
        hi[open_] = np.where(below, hi[open_], middle)
        open_ = open_[hi[open_] - lo[open_] > 1]
    return hi


class Side(NamedTuple):
    """Tokens of some documents, end to end: ids, byte ends (ascending over all), first token of each document."""
    ids: np.ndarray
    ends: np.ndarray
    begin: np.ndarray


def side(tokens: list[list[int]], lengths: np.ndarray) -> Side:
    ids = np.fromiter((i for t in tokens for i in t), np.int64, sum(map(len, tokens)))
    return Side(ids, np.cumsum(lengths[ids]), np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64))


class Aligned(NamedTuple):
    """``closes``: the tokens that end a group; links as (document, short token's id, long token's id)."""
    short_closes: np.ndarray
    long_closes: np.ndarray
    doc: np.ndarray
    short_id: np.ndarray
    long_id: np.ndarray


def align(short: Side, long: Side) -> Aligned:
    place = gallop(short.ends, long.ends)
    common = long.ends[place] == short.ends if len(place) else np.zeros(0, bool)
    closes = np.zeros(len(long.ids), dtype=bool)
    closes[place[common]] = True
    # A token overlaps from the long token that holds its first byte to the one that holds its last.
    first = np.zeros(len(place), dtype=np.int64)
    first[1:] = place[:-1] + common[:-1]
    n = place - first + 1
    at = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
    doc = np.repeat(np.repeat(np.arange(len(short.begin) - 1), np.diff(short.begin)), n)
    return Aligned(common, closes, doc, np.repeat(short.ids, n), long.ids[at])


def group_texts(a: Side, b: Side, a_closes: np.ndarray, b_closes: np.ndarray, names: tuple) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document."""
    a_more, a_last, b_more, b_last = names
    a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
    a_end = np.flatnonzero(a_closes) + 1
    b_begin = np.concatenate([[0], np.flatnonzero(b_closes) + 1])
    out = np.empty(len(a.ids) + len(b.ids), dtype=object)
    out[np.arange(len(a.ids)) + b_begin[a_group]] = np.where(a_closes, a_last[a.ids], a_more[a.ids])
    out[np.arange(len(b.ids)) + (a_end[b_group] if len(b.ids) else 0)] = np.where(b_closes, b_last[b.ids], b_more[b.ids])
    parts, cuts = out.tolist(), (a.begin + b.begin).tolist()
    return ["".join(parts[x:y])[:-1] for x, y in zip(cuts, cuts[1:])]


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, type=kind))


def _text_slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows with at most ``SLICE_BYTES`` of text, or one longer row."""
    first, texts, size = 0, [], 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        if texts and size + len(text) > SLICE_BYTES:
            yield first, texts
            first, texts, size = i, [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def _align_rows(files, classes: tuple[type, type], small: bool, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = (load(c, f) for c, f in zip(classes, files.value))
        sizes = [np.array([len(x) for x in t.table], dtype=np.int64) for t in (one, two)]
        kind = pa.int32() if small else pa.int64()
        names = tuple(np.array([f"{i}{end}" for i in range(len(t.table))], dtype=object) for t, end in ((one, ","), (one, "|"), (two, ","), (two, ";")))
        for batch in batches:
            for first, texts in _text_slices(batch.column("text")):
                n = np.zeros((4, len(texts)), dtype=np.int64)  # n_a, n_b, n_groups, n_links
                groups = [""] * len(texts)
                tokens = []
                for text in texts:
                    raw = " " + text
                    x, y = (one.encode(raw), two.encode(text)) if text else ([], [])
                    whole = raw.encode()
                    same = x and b"".join(map(one.table.__getitem__, x)) == whole and b"".join(map(two.table.__getitem__, y)) == whole
                    tokens.append((x, y) if same else ([], []))
                keys = []
                # Documents with fewer tokens on one side are driven by it.
                for by_a in (True, False):
                    rows = [i for i, (x, y) in enumerate(tokens) if x and (len(x) <= len(y)) == by_a]
                    if not rows:
                        continue
                    a, b = (side([tokens[i][k] for i in rows], sizes[k]) for k in (0, 1))
                    found = align(a, b) if by_a else align(b, a)
                    a_closes, b_closes = found[:2] if by_a else found[1::-1]
                    for i, text in zip(rows, group_texts(a, b, a_closes, b_closes, names)):
                        groups[i] = hashlib.sha256(text.encode()).hexdigest() if digest else text
                    n[0, rows], n[1, rows] = np.diff(a.begin), np.diff(b.begin)
                    n[2, rows] = np.add.reduceat(a_closes.astype(np.int64), a.begin[:-1])
                    n[3, rows] = np.bincount(found.doc, minlength=len(rows))
                    x, y = (found.short_id, found.long_id) if by_a else (found.long_id, found.short_id)
                    keys.append((np.array(rows)[found.doc] << 40) | (x * len(two.table) + y))
                flat, times = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
                counts = np.bincount(flat >> 40, minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, len(texts)), *[pa.array(v) for v in n], pa.array(groups),
                     _lists(flat & ((1 << 40) - 1), counts, kind), _lists(times, counts, pa.int32())],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
    return run


def _score_rows(head, small: bool):
    """n_best and count_sum of the pairs in the head; the other pairs stay listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = head.value
        kind = pa.int32() if small else pa.int64()
        for batch in batches:
            lists = batch.column("pairs")
            offsets = np.asarray(lists.offsets).astype(np.int64)
            flat = np.asarray(lists.values)[offsets[0]:offsets[-1]].astype(np.int64)
            times = np.asarray(batch.column("times").flatten()).astype(np.int64)
            at = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
            known = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            sums = []
            for weight in (best, counts):
                per = np.zeros(batch.num_rows + 1, dtype=np.int64)
                if known.any():
                    np.add.at(per, row[known], times[known] * weight[at[known]].astype(np.int64))
                sums.append(pa.array(per[:-1]))
            left = np.bincount(row[~known], minlength=batch.num_rows)
            keep = [n for n in batch.schema.names if n not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in keep], *sums, _lists(flat[~known], left, kind), _lists(times[~known], left, pa.int32())],
                names=[*keep, "n_best", "count_sum", "pairs", "times"])
    return run


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def token_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_a: str = TOKENIZER_A,
                 tokenizer_b: str = TOKENIZER_B, digest: bool = False) -> tuple[DataFrame, int]:
    """Per document id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (``a1,a2|b1;a3|b2,b3``,
    or its SHA-256), and its distinct linked id pairs with how often each is linked; and the factor
    of the pair key ``a * factor + b``.

    ``tokenizer_a`` is a byte-level BPE file and encodes space + text; ``tokenizer_b`` is a piece
    model that adds the space itself. The driver reads both files (a few MB) and sends them to the tasks.
    """
    spark = docs.sparkSession
    content = read_file(tokenizer_a), read_file(tokenizer_b)
    n_a, n_b = len(ByteLevel(content[0]).table), len(Pieces(content[1]).table)
    if n_a * n_b >= 1 << 40:
        raise ValueError("vocabularies too large for one pair key")
    small = n_a * n_b < 1 << 31
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pair = "int" if small else "bigint"
    rows = slim.mapInArrow(_align_rows(spark.sparkContext.broadcast(content), (ByteLevel, Pieces), small, digest),
                           f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
                           f"pairs array<{pair}>, times array<int>")
    return rows, n_b


def pair_counts(rows: DataFrame, pair: Column, factor: int) -> DataFrame:
    """(pair, n, best): how many documents hold the pair linked, and whether no pair of its first id has more."""
    counts = rows.select(pair.alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    first = F.expr(f"pair div {factor}").alias("first")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))  # at most one row per id of the first vocabulary
    return counts.withColumn("first", first).join(F.broadcast(most), "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_a: str = TOKENIZER_A,
                     tokenizer_b: str = TOKENIZER_B, digest: bool = True, head: int = 1 << 20) -> DataFrame:
    """Per document id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups``.

    A link is a pair of token occurrences, one of each side, whose byte ranges overlap. The count
    of an id pair is the number of documents that hold it linked; ``count_sum`` adds the counts of
    the links, ``n_best`` counts links whose count is the highest of their first id (ties included).
    ``groups`` is the SHA-256 of the groups' text, or the text itself with ``digest=False``.

    Defined cases: null and empty texts, and texts that a tokenizer does not give back byte for
    byte, have no tokens: zeros and ``''``. Every row is a document of its own: rows that share an id or
    a text count once each. A null id changes nothing. An empty table gives an empty result.
    Other columns are ignored. Texts are tokenized whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    rows, factor = token_groups(docs, id_col, text_col, tokenizer_a, tokenizer_b, digest)
    small = rows.schema["pairs"].dataType.elementType.simpleString() == "int"
    rows = scratch.write(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    counts = scratch.write(pair_counts(rows.select(F.explode("pairs").alias("pair")), F.col("pair"), factor), "counts")
    # The head is all pairs from a power of two on; the lowest that leaves at most `head` of them.
    sizes = counts.agg(*[F.count_if(F.col("n") >= 1 << j).alias(f"c{j}") for j in range(63)]).first()
    least = 1 << next((j for j in range(63) if sizes[j] <= head), 62)
    top = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    arrays = tuple(top.column(c).to_numpy().astype(kind) for c, kind in (("pair", np.int64), ("n", np.int64), ("best", bool)))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("pairs", "times"))
    scored = rows.mapInArrow(_score_rows(spark.sparkContext.broadcast(arrays), small),
                             f"{fields}, n_best bigint, count_sum bigint, pairs array<{'int' if small else 'bigint'}>, times array<int>")
    names = [F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links"]
    if sizes[0] == len(arrays[0]):
        return scored.select(*names, "n_best", "count_sum", "groups")
    scored = scratch.write(scored, "scored")
    scratch.drop("rows")
    rare = (scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
            .join(counts.where(F.col("n") < least), "pair")
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                                F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    out = scored.drop("pairs", "times").join(rare, "row", "left")
    return out.select(*names, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups")
