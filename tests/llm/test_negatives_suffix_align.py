"""Hard negatives, byte-level suffix dedup and token alignment against brute-force versions."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.test_llm import SCHEMA, edge_rows, result, table


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# ---- suffix dedup ---------------------------------------------------------------------------

def expected_bytes(rows, length):
    """n_bytes, n_removed, n_spans and SHA-256 of what is left, by looking every string up."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        if i is not None:
            for s in range(len(b) - length + 1):
                key = b[s:s + length]
                first[key] = min(first.get(key, i), i)
    out = collections.Counter()
    for i, b in texts:
        gone, own = bytearray(len(b)), set()
        for s in range(len(b) - length + 1):
            key = b[s:s + length]
            if key in own or (i is not None and first[key] < i):
                gone[s:s + length] = b"\1" * length
            own.add(key)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[(i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("length", [100, 33, 8])
def test_byte_repeats_equal_brute_force(edge, docs, length):
    from tessera.llm.suffix_dedup import byte_repeat_report
    for df in (edge, docs):
        got = result(byte_repeat_report(df, length=length), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == expected_bytes(table(df), length)


def test_byte_repeats_across_pieces_of_a_long_text(spark):
    from tessera.llm.suffix_dedup import PIECE_BYTES, byte_repeat_report
    rng = random.Random(5)
    noise = "".join(rng.choices("abcdefghij klmnopqrstuvwxyz\n", k=2 * PIECE_BYTES + 5000))
    passage = noise[PIECE_BYTES - 150:PIECE_BYTES + 150]  # lies across a border of two pieces
    rows = [(1, "x" * 40 + passage + "y" * 40), (2, noise), (3, noise[:3000] + passage + noise[50:400] + passage), (4, "é" * 300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = result(byte_repeat_report(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == expected_bytes(rows, 100)


def test_byte_repeats_on_ids_that_repeat(spark):
    from tessera.llm.suffix_dedup import byte_repeat_report
    a, b = "alpha beta gamma delta " * 3, "".join(random.Random(1).choices("qwertyuiop", k=400))
    rows = [(1, b), (1, b), (1, b + a), (2, b), (None, b), (None, b + b), (3, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(byte_repeat_report(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected_bytes(rows, 100)


def test_cut_byte_repeats_keeps_rows_and_columns(edge):
    from tessera.llm.suffix_dedup import cut_byte_repeats
    out = cut_byte_repeats(edge)
    assert out.columns == [*edge.columns, "kept_bytes", "n_bytes", "n_removed", "n_spans"]
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept_bytes"]).hexdigest())
                              for r in out.collect())
    assert got == expected_bytes(table(edge), 100)
    assert collections.Counter(map(tuple, out.select(*edge.columns).collect())) == collections.Counter(map(tuple, edge.collect()))
    with pytest.raises(ValueError, match="exist already"):
        cut_byte_repeats(edge.withColumn("n_spans", F.lit(1)))


# ---- hard negatives -------------------------------------------------------------------------

def expected_negatives(rows, positives=5, negatives=3):
    """rows: (id, label, vector, is anchor); every pair is scored."""
    usable = {}
    for i, label, v, anchor in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [max(-(1 << 26), min(1 << 26, math.floor(256 * x))) if abs(x) < 1e300 else int(math.copysign(1 << 26, x)) for x in v]
        old = usable.get(i)
        usable[i] = min((label, q), old[:2]) + (anchor or old[2],) if old else (label, q, anchor)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = collections.Counter()
    for a, (label, q, anchor) in usable.items():
        if not anchor:
            continue
        scored = sorted(((-dot(q, v), i, other) for i, (other, v, _) in usable.items() if i != a))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(n, i) for n, i, other in scored if other != label and 50 * -s <= 100 * -n <= 95 * -s][:negatives]
            for rank, (n, i) in enumerate(fits, 1):
                out[(a, p, rank, i, -s, -n)] += 1
    return out


NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(spark, rows, **options):
    from tessera.llm.hard_negatives import hard_negatives
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows],
                               "vec_id bigint, label int, embedding array<float>, a boolean, score string, id double").repartition(3)
    return result(hard_negatives(df, F.col("a"), F.col("label"), **options), *NEGATIVES)


def test_hard_negatives_equal_brute_force(spark):
    rng = random.Random(9)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(1500):
        c = rng.choice(centres)
        rows.append((i, rng.randrange(5), [x + rng.gauss(0, rng.choice([.05, .8])) for x in c], i % 3 == 0))
    same = [0.25] * 8
    rows += [(2000 + i, i % 2, same, i < 30) for i in range(120)]  # ties everywhere
    rows += [(3000, 1, [0.0] * 8, True), (3001, 1, [], True), (3002, 1, [1.0, -1.0], True), (3003, None, same, True), (3004, 1, None, True),
             (3005, 2, [float("nan")] + same[1:], True), (3006, 2, [float("inf")] + same[1:], False), (3007, 2, [None] + same[1:], True),
             (None, 1, same, True), (3008, 9, same, True), (0, 3, same, True), (0, 3, same, True), (1, 0, same, None)]
    rows = [(i, y, None if v is None else [None if x is None else float(np.float32(x)) for x in v], a) for i, y, v, a in rows]
    want = expected_negatives(rows)
    assert len(want) > 3000
    assert mine(spark, rows) == want
    assert mine(spark, rows, anchors_per_block=100) == want  # anchors in several blocks


def test_hard_negatives_with_large_components(spark):
    rng = random.Random(2)
    for scale in (30.0, 3e4, 1e9):  # float32, float64 and 64-bit products
        rows = [(i, i % 3, [float(np.float32(rng.uniform(-1, 1) * scale)) for _ in range(5)], i % 5 == 0) for i in range(120)]
        assert mine(spark, rows) == expected_negatives(rows)


def test_hard_negatives_walk_ends_early_with_certainty():
    import pyarrow as pa
    from tessera.llm import hard_negatives as H
    rng = np.random.default_rng(4)
    near, far = rng.normal([300, 0, 0, 0], 5, (400, 4)).round(), rng.normal([0, 300, 0, 0], 5, (20_000, 4)).round()
    rows = np.concatenate([near, far]).astype(np.int64)
    batch = pa.RecordBatch.from_pydict({"id": np.arange(len(rows)), "label": np.zeros(len(rows), np.int64),
                                        "q": pa.array(rows.tolist(), pa.list_(pa.int32()))})
    anchors = H.make_anchors(pa.Table.from_batches([batch.slice(0, 40)]))
    best, seen = H.Best(40, 5), []

    def take(active, scores, labels, ids):
        seen.append(scores.size)
        r, c = np.nonzero(ids != anchors.ids[active][:, None])
        best.add(active[r], scores[r, c], ids[c])

    H._walk(anchors, batch, lambda active: best.least[active], take)
    assert sum(seen) < 40 * len(rows) / 10
    scores = rows[:40] @ rows.T
    for a in range(40):
        want = sorted((-s, i) for i, s in enumerate(scores[a].tolist()) if i != a)[:5]
        assert [(-s, i) for s, i in zip(best.score[best.slot == a].tolist(), best.id[best.slot == a].tolist())] == want


def test_hard_negatives_of_nothing(spark):
    assert not mine(spark, [(50, 1, [1.0], True)])
    from tessera.llm.hard_negatives import hard_negatives
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives(empty, F.col("vec_id") % 50 == 0, F.col("label")).count() == 0


def test_hard_negatives_match_their_sql(spark):
    import duckdb
    from tessera.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    assert result(QUERIES["op11_hard_negatives"](spark, SF_SMALL), *NEGATIVES) == collections.Counter(con.execute(ORACLE["op11_hard_negatives"]).fetchall())


# ---- token alignment ------------------------------------------------------------------------

def expected_alignment(rows):
    """Every pair of tokens is compared; encodings by the slower library."""
    from sentencepiece import SentencePieceProcessor
    from tessera.llm.token_align import TOKENIZER_A, TOKENIZER_B
    from tokenizers import Tokenizer
    one, two = Tokenizer.from_file(TOKENIZER_A), SentencePieceProcessor(model_file=TOKENIZER_B)
    one.encode_special_tokens = True
    letters, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            letters[chr(b)] = b
        else:
            letters[chr(256 + n)] = b
            n += 1
    piece = lambda p: bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()
    found = []
    for i, text in rows:
        a = b = []
        if text:
            a = [(t, bytes(letters[c] for c in one.id_to_token(t))) for t in one.encode(" " + text, add_special_tokens=False).ids]
            b = [(t, piece(two.id_to_piece(t))) for t in two.encode(text)]
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a = b = []
        spans = []
        for tokens in (a, b):
            at, out = 0, []
            for t, x in tokens:
                out.append((t, at, at + len(x)))
                at += len(x)
            spans.append(out)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = "" if not a else ";".join(
            ",".join(str(t) for t, s, e in spans[0] if lo <= s and e <= hi) + "|" + ",".join(str(t) for t, s, e in spans[1] if lo <= s and e <= hi)
            for lo, hi in zip([0, *ends], ends))
        links = [(t, u) for t, s, e in spans[0] for u, f, g in spans[1] if s < g and f < e]
        found.append((i, len(a), len(b), len(ends), links, groups))
    counts = collections.Counter(pair for f in found for pair in set(f[4]))
    most = {}
    for (t, _), c in counts.items():
        most[t] = max(most.get(t, 0), c)
    return collections.Counter(
        (i, a, b, n, len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(g.encode()).hexdigest() if g else "") for i, a, b, n, links, g in found)


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("head", [1 << 20, 40, 0])
def test_alignment_equals_brute_force(spark, docs, head):
    from tessera.llm.token_align import alignment_report
    rows = [(i, t) for i, t in table(docs) if t and len(t) < 1500][:60]
    rows += [(900, None), (901, ""), (902, " "), (903, "a  b\t\tc\n\n d "), (904, "<|endoftext|> <s> </s>"), (905, "naïve café ß Ж 世界 🙂 é"),
             (906, "half ▁ block"), (907, "  x"), (908, "a" * 700), (909, "\x00\x01 \x7f"), (910, "ﬁne ½ ①"), (None, "plain words"),
             (911, "plain words"), (911, "plain words"), rows[0]]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id bigint, text string, pairs string, n_a int").repartition(3)
    assert result(alignment_report(df, head=head), *ALIGNED) == expected_alignment(rows)


def test_alignment_gives_the_groups_back(spark):
    from tessera.llm.token_align import alignment_report
    df = spark.createDataFrame([(1, "unbelievable things happen"), (2, None)], "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in alignment_report(df, digest=False).collect()}
    groups = [g.split("|") for g in out[1]["groups"].split(";")]
    assert len(groups) == out[1]["n_groups"] and sum(len(a.split(",")) for a, _ in groups) == out[1]["n_a"]
    assert out[2]["groups"] == "" and out[2]["n_links"] == 0
    assert alignment_report(df.limit(0)).count() == 0


def test_long_blanks_and_words_are_encoded_alike():
    from tessera.llm.token_align import TOKENIZER_A, ByteLevel, read_file
    from tokenizers import Tokenizer
    own, other = ByteLevel(read_file(TOKENIZER_A)), Tokenizer.from_file(TOKENIZER_A)
    other.encode_special_tokens = True
    assert own.fast is not None
    for text in (" " * 400_000 + "x", "\n" * 19_000 + "y", "word" * 30_000, "it's we'll I'D 12345 -- ..\r\n\t é"):
        assert own.encode(text) == other.encode(text, add_special_tokens=False).ids


def test_galloping_finds_every_place():
    from tessera.llm.token_align import gallop
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (1, 50), (7, 9), (500, 60_000), (3000, 3100)):
        long = np.sort(rng.choice(200_000, m, replace=False))
        short = np.sort(np.append(rng.choice(long[:-1] + 0, min(n, m) - 1, replace=False) if min(n, m) > 1 else [], long[-1])).astype(np.int64)
        short = np.unique(np.append(short, rng.integers(0, long[-1], n // 2)))
        assert (gallop(short, long) == np.searchsorted(long, short)).all()
