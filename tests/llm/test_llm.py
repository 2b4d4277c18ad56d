"""The text operators against brute-force versions, on made-up edge cases and on a small table."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, id string, row string"


def low(text):
    return (text or "").translate(UPPER)


def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(6)]
    texts = [None, "", " \n\t", "one", "one two", "ONE two", *base, base[0], base[0].upper(), base[1] + " tail",
             "start " + base[2], base[3][:400] + " changed words here", "a b c " * 4000, "x\x0by\x0cz é ß Ж",
             "all rights reserved\nAll Rights Reserved", "licensed under cc by nc 4 0", " ".join(rng.choices(words, k=20000)),
             base[4] + " " + base[5], "line one\nline one\n\n\nline two"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[6], (None, base[0], None, None, None, None, None, None), (None, None, None, "s1", None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_SMALL}/labels.parquet")


def table(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def result(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


def expected_repeats(rows, window=50):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for a in range(len(w) - window + 1):
            key = tuple(w[a:a + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = collections.Counter()
    for i, w in words:
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if i is not None and first[tuple(w[a:a + window])] < i:
                gone[a:a + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[(i, len(w), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("window", [50, 12])
def test_substring_dedup_equals_brute_force(edge, docs, window):
    from tessera.llm.substring_dedup import repeat_report
    for df in (edge, docs):
        got = result(repeat_report(df, window=window), "doc_id", "n_words", "n_removed", "kept_sha256")
        assert got == expected_repeats(table(df), window)


def test_substring_levels_double():
    from tessera.llm.substring_dedup import lengths
    assert lengths(50) == [13, 25, 50] and lengths(12) == [12]
    for n in range(1, 300):
        steps = lengths(n)
        assert steps[-1] == n and all(b <= 2 * a for a, b in zip(steps, steps[1:]))


def test_second_window_hash_does_not_follow_from_the_first(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from tessera.llm import substring_dedup, tokens
    table = tokens._byte_table
    # Byte table 0 can't tell letters apart: all words of one length collide in the first hash.
    monkeypatch.setattr(tokens, "_byte_table", lambda lower, salt: table(lower, salt) if salt else np.full(256, 12345, np.uint64))
    texts = pa.array([" ".join(["abc"] * 50), " ".join(["xyz"] * 50)])
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([0, 0]), texts, pa.array([list(range(50))] * 2, pa.list_(pa.int64()))],
                                      names=["id", "tag", "text", "spots"])
    last = pa.Table.from_batches(substring_dedup._next_pass(50, 25, 50)(iter([rows]))).to_pydict()
    assert last["id"] == [1, 2] and len(set(last["h"])) == 1 and len(set(last["g"])) == 2
    first = pa.Table.from_batches(substring_dedup._first_pass(16, 16)(iter([rows]))).to_pydict()
    assert first["h"][0] == first["h"][1] and first["g"][0] != first["g"][1]


def test_cut_repeats_keeps_rows_and_columns(edge):
    from tessera.llm.substring_dedup import cut_repeats
    out = cut_repeats(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    hashes = {i: s for (i, _, n, s) in expected_repeats(table(edge)) if n}
    before = dict(table(edge))
    for i, t in table(out):
        if i in hashes:
            assert hashlib.sha256(t.encode()).hexdigest() == hashes[i]
        elif i is not None:
            assert t == before[i]


def components_of(rows, k, percent):
    sets = collections.defaultdict(list)
    for i, t in rows:
        w = low(t).encode().split()
        s = frozenset(tuple(w[a:a + k]) for a in range(len(w) - k + 1)) or (frozenset([tuple(w)]) if w else frozenset())
        sets[i].append(s)
    parent = {i: i for i in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    nodes = [(i, s) for i in parent for s in sets[i] if s]
    for n, (i, s) in enumerate(nodes):
        for j, t in nodes[:n]:
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}, sets


@pytest.mark.parametrize("k,percent,bands,rows", [(3, 85, 20, 5), (5, 80, 24, 4)])
def test_near_duplicates_equal_brute_force(edge, docs, k, percent, bands, rows):
    from tessera.llm.near_dedup import near_duplicates
    for df in (edge, docs):
        want, sets = components_of(table(df), k, percent)
        for r in near_duplicates(df, shingle=k, percent=percent, bands=bands, rows=rows).collect():
            assert r["component_id"] == want.get(r["doc_id"])
            assert r["kept"] == (r["doc_id"] is None or r["component_id"] == r["doc_id"])
            assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}


def test_near_duplicates_finds_links_beyond_the_pivot(spark):
    """A chain of variants: neighbours are linked, ends are not; one pivot can't link them all."""
    from tessera.llm.near_dedup import drop_near_duplicates, near_duplicates
    words = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(30):
        for j in range(3 * i, 3 * i + 3):
            words[j % 200] = f"n{i}x{j}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want, _ = components_of(rows, 3, 85)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df, shingle=3, percent=85, bands=20, rows=5).collect()}
    assert got == want and len(set(want.values())) == 1
    assert [r["doc_id"] for r in drop_near_duplicates(df, shingle=3, percent=85, bands=20, rows=5).collect()] == [0]


def test_min_max_signature_estimates_jaccard():
    import numpy as np
    from tessera.llm.near_dedup import band_hashes
    from tessera.llm.tokens import mix
    base = mix(np.arange(2000, dtype=np.uint64), 5)
    a, b = base[:1800], base[200:]  # 1600 / 2000 = 0.8
    h = band_hashes(np.concatenate([a, b]), np.array([0, 1800]), bands=400, rows=1)
    assert abs((h[0] == h[1]).mean() - 0.8) < 0.08


def test_word_hashes_follow_words():
    import pyarrow as pa
    from tessera.llm.tokens import window_owner, windows, word_slices
    texts = [None, "", "a b a", " A\tb\x0bc ", "é a", "a\x00b", "x" * 5000 + " a"]
    seen = {}
    for size in (1, 8, 1 << 20):
        for s in word_slices(pa.array(texts), slice_bytes=size):
            for i in range(s.first, s.last):
                words = (texts[i] or "").encode().split()
                mine = s.hashes[s.starts[i - s.first]:s.starts[i - s.first + 1]]
                assert len(mine) == len(words)
                for w, h in zip(words, mine):
                    assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    s = next(word_slices(pa.array(["a b c", "b c", "a b"])))
    grams = windows(s.hashes, 2)[window_owner(s.starts, 2)]
    assert grams[0] == grams[3] and grams[1] == grams[2]


def expected_hits(rows, items, window=10):
    found = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM_WORD.findall(low(t))
        for a in range(max(1, len(w) - window + 1) if w else 0):
            found[tuple(w[a:a + window])].add("" if i is None else str(i))
    sizes, out = {len(k) for k in found}, collections.Counter()
    for d, t in rows:
        w, hit, names = ALNUM_WORD.findall(low(t)), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in found:
                    names |= found[tuple(w[a:a + n])]
                    hit.update(range(a, a + n))
        out[(d, len(w), len(hit), len(names), tuple(sorted(names)), bool(hit))] += 1
    return out


def test_decontaminate_equals_brute_force(spark, edge, docs):
    from tessera.llm.decontaminate import decontaminate, drop_contaminated
    texts = [t for _, t in table(edge) if t]
    items = [(0, " ".join(texts[8].split()[5:30])), (1, "ONE"), (2, "w1 w2"), (3, None), (4, "?!"), (None, "all rights reserved"),
             (0, "c a b"), (10, " ".join(texts[8].split()[7:25]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for df, b in ((edge, bench), (docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")), (edge, bench.limit(0))):
        pairs = [(r["item_id"], r["text"]) for r in b.collect()]
        got = collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"]), r["contaminated"])
                                  for r in decontaminate(df, b).collect())
        want = expected_hits(table(df), pairs)
        assert got == want
        clean = sum(n for k, n in want.items() if not k[5])
        out = drop_contaminated(df, b)
        assert out.columns == df.columns and out.count() == clean


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontaminate_verifies_piece_by_piece(spark, monkeypatch, broadcast):
    """Windows across the borders of pieces, near misses, a benchmark too large to broadcast."""
    from tessera.llm import decontaminate as m
    monkeypatch.setattr(m, "PIECE", 7)
    if not broadcast:
        monkeypatch.setattr(m, "fits_broadcast", lambda df: False)
    rng = random.Random(9)
    item = [f"b{i}" for i in range(16)]
    rows = []
    for i in range(40):
        w = [rng.choice("x y z b1 b2 b3".split()) for _ in range(rng.randrange(60))]
        at = rng.randrange(len(w) + 1)
        w[at:at] = item[rng.randrange(7):][:rng.choice([9, 10, 13])] if i % 3 else item[:5] + ["q"] + item[6:]
        rows.append((i, " ".join(w)))
    rows += [rows[1], (None, rows[2][1]), (1, rows[4][1]), (99, " ".join(item * 30)), (98, ""), (97, None)]
    items = [(1, " ".join(item)), (2, "x y"), (3, "z"), (4, " ".join(item[3:] + ["x"])), (5, "absent words here")]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"]), r["contaminated"])
                              for r in m.decontaminate(docs, bench).collect())
    assert got == expected_hits(rows, items)


def test_host_rules_equal_brute_force(edge, docs):
    from tessera.llm.host_rules import host_rules
    for df in (edge, docs):
        want = collections.Counter()
        for d, t in table(df):
            w = BLANK_WORD.findall(t or "")
            grams = collections.Counter(tuple(w[a:a + 8]) for a in range(len(w) - 7))
            covered = set()
            for a in range(len(w) - 7):
                if grams[tuple(w[a:a + 8])] > 1:
                    covered.update(range(a, a + 8))
            lines = [x for x in (t or "").split("\n") if BLANK_WORD.search(x)]
            want[(d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered),
                  len(w) < 20 or 100 * len(covered) > 30 * len(w))] += 1
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        out = host_rules(df)
        assert result(out, *names) == want
        assert out.where("kept and base_failed").count() == 0


def test_bad_host_is_rejected_and_small_ones_are_shrunk(spark):
    from tessera.llm.host_rules import host_rules
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, "short" if i % 10 else good, "bad") for i in range(300)]
    rows += [(1000 + i, good if i % 20 else "short", f"h{i % 10}") for i in range(2000)] + [(9000, "short", "tiny"), (9001, good, None)]
    out = {r["doc_id"]: r for r in host_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not out[0]["kept"] and not out[0]["base_failed"]
    assert out[1001]["kept"] and out[9001]["kept"] and out[9001]["host_rate"] is None
    assert out[9000]["host_rate"] < 1.0


def test_mixing_meets_targets(edge, docs):
    from tessera.llm.mixing import mix_sources
    for df in (edge, docs):
        rows = mix_sources(df).collect()
        names = {(r["doc_id"], len(BLANK_WORD.findall(r["text"] or ""))): r["source"] for r in df.collect()}
        assert len(rows) == df.count()
        per = collections.defaultdict(lambda: [0, 0, None])
        for r in rows:
            assert 0 <= r["taken"] <= 2 * r["size"]
            s = per[names[(r["doc_id"], r["size"])]]
            s[0] += r["size"]
            s[1] += r["taken"]
            s[2] = r["target"]
            assert r["source_size"] >= r["size"]
        order = sorted(per, key=lambda x: (x is None, x or ""))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        total, capped = 1.5 * sum(v[0] for v in per.values()), set()
        while True:
            level = (total - sum(2 * per[s][0] for s in capped)) / max(sum(weight[s] for s in order if s not in capped), 1e-9)
            more = {s for s in order if s not in capped and weight[s] * level > 2 * per[s][0]}
            if not more:
                break
            capped |= more
        for s, (size, taken, target) in per.items():
            assert target == pytest.approx(2 * size if s in capped else weight[s] * level)
            assert taken == math.floor(target)
        assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mix_sources(df.repartition(5)).collect()), key=str)


def test_licence_phrases_equal_brute_force(edge, docs):
    from tessera.llm.licence_scan import licence_scan
    phrases = [("cc-by", ["cc", "by"]), ("gpl", ["general", "public", "license"]), ("reserved", ["all", "rights", "reserved"])]
    for df in (edge, docs):
        want = collections.Counter()
        for d, t in table(df):
            w = ALNUM_WORD.findall(low(t))
            at = [(i, n) for i in range(len(w)) for n, p in phrases if w[i:i + len(p)] == p]
            want[(d, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({n for _, n in at})))] += 1
        out = licence_scan(df)
        assert result(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
        for r in out.collect():
            assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
            assert 0 <= r["score"] <= 1


def test_licence_scan_merges_neighbouring_diagonals(spark):
    from tessera.llm.licence_scan import licence_scan
    rows = [(0, "is licensed under the new Apache License, version 2.0."), (1, "licensed tools under the sun"), (2, "nothing")]
    out = {r["doc_id"]: r for r in licence_scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert out[0]["labels"] == "apache" and out[1]["labels"] == "" and out[2]["score"] == 0.0


def test_licence_scan_finds_usual_variants(spark):
    from tessera.llm.licence_scan import licence_scan
    texts = {"Licensed under the terms of the Apache License, Version 2.0": "apache", "Released under the terms of the MIT License": "mit",
             "Licensed under the Apache 2.0 license.": "apache", "Creative Commons Attribution-NonCommercial 4.0 International": "cc-by-nc",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit",
             "license mit, the mit was under the license released": "", "the license apache under the terms of version 2.0": "",
             "under the bridge " + "far away " * 20 + "stands the mit and has no license": ""}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = {r["doc_id"]: r["labels"] for r in licence_scan(df).collect()}
    assert [out[i] for i in range(len(texts))] == list(texts.values())


def test_url_rules(spark):
    from tessera.llm.queries import URL_RULES
    from tessera.llm.url_rules import judge_urls
    urls = ["https://www.Example.com/en/1", "http://blog.example.com/en/2?x", "http://blog.example.com/fr/2", "ftp://a.net/es/q#f",
            "http://net/fr/", "http://evilnet/fr/", "http://x.org/en/", "nothing", None, "", "http://example.com", "http://example.com?/en/",
            "://com/", "a://b.net/es/://c.com/", "http://net./es/", "http://a.net/fr/1"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(0, urls[0], "x")], "page_id int, url string, rule string")
    want = collections.Counter()
    for i, u in [*enumerate(urls), (0, urls[0])]:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = low(host)
        fits = [(h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, "allow")
        want[(i, host, path, rule, verdict)] += 1
    assert result(judge_urls(df, URL_RULES), "page_id", "host", "path", "rule", "verdict") == want
    assert judge_urls(df.limit(0), URL_RULES).count() == 0


def test_ppm_base_and_model(spark, edge, docs):
    from tessera.llm.ppm import ppm_scores
    from tessera.llm.queries import fold_of
    for df in (edge, docs):
        rows = table(df)
        held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
        words = lambda t: [*low(t).encode().split(), None]
        counts = collections.Counter(w for i, t in rows if not held(i) for w in words(t))
        n, v = sum(counts.values()), len(counts)
        want = collections.Counter()
        for i, t in rows:
            w = words(t)
            want[(i, held(i), len(w), sum(counts[x] > 0 for x in w), n,
                  round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 4))] += 1
        out = ppm_scores(df, fold_of(10) != 0, often=50)
        got = out.withColumn("base", F.round("base_score", 4))
        assert result(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base") == want
        assert out.where("score > 0 or isnan(score)").count() == 0


def test_ppm_probabilities_sum_to_one(spark):
    from tessera.llm.common import Scratch
    from tessera.llm.ppm import price_grams
    from tests.llm.ppm_reference import Model, symbols
    texts, order = ["abracadabra", "a cab", "", "Abba"], 2
    seen = collections.Counter(int.from_bytes(c + bytes([s])) for t in texts for c, s in symbols(t, order))
    contexts = (b"ab", b"br", b"zz", b"\0\0", b"\0a")
    keys = set(seen) | {int.from_bytes(c + bytes([s])) for c in contexts for s in range(256)}
    grams = spark.createDataFrame([(k, seen[k], 1) for k in keys], "key bigint, n bigint, seen bigint")
    price = {r["key"]: r["price"] for r in price_grams(grams, order, Scratch(spark, "test")).collect()}
    model = Model(texts, order)
    for c in contexts:
        own = [price[int.from_bytes(c + bytes([s]))] for s in range(256)]
        assert own == pytest.approx([model.log10(c, s) for s in range(256)], abs=1e-9)
        total = sum(10 ** p for p in own)
        assert total == pytest.approx(1.0, abs=1e-9) or total < 1.0  # escapes of exhausted contexts lose mass, never gain it


def test_ppm_scores_equal_an_unpruned_model(spark):
    from tessera.llm.ppm import ppm_scores
    from tests.llm.ppm_reference import Model
    rng = random.Random(9)
    texts = ["".join(rng.choices("abcde fgñ", k=rng.randint(0, 60))) for _ in range(80)] + ["zzz never seen", "", "abc abc abc abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    model = Model([t for i, t in enumerate(texts) if i % 4], 3)
    want = [model.score(t) for t in texts]
    for bound in (1, 40, 1 << 21):  # what is sent to the workers must not change the scores
        got = {r["doc_id"]: r["score"] for r in ppm_scores(df, F.col("doc_id") % 4 != 0, order=3, max_nodes=bound, often=5).collect()}
        assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-9)


def test_price_table_finds_every_key():
    import numpy as np
    from tessera.llm.ppm import look_up, price_table
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        keys = np.unique(rng.integers(0, 1 << 48, n))
        values = rng.normal(size=len(keys))
        table = price_table(keys, values)
        asked = np.concatenate([keys, rng.integers(0, 1 << 48, 3000)])
        out, found = look_up(table, asked)
        assert found.tolist() == np.isin(asked, keys).tolist()
        assert (out[:len(keys)] == values).all() and (out[~found] == 0).all()


def test_classifiers_on_edge_cases(spark, edge):
    from tessera.llm.toxicity import toxicity
    from tessera.llm.zstd_quality import zstd_quality
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for f in (zstd_quality, toxicity):
        out = f(edge, none, F.lit(True))
        assert out.count() == edge.count() and out.where("score < 0 or score > 1 or score is null").count() == 0
        assert f(edge.limit(0), none, F.lit(True)).count() == 0


def test_quality_classifier_separates(spark, docs):
    from tessera.llm.zstd_quality import zstd_quality
    rng = random.Random(1)
    good = [" ".join(rng.choices(["the", "river", "runs", "slowly", "past", "old", "stone", "houses"], k=60)) for _ in range(80)]
    bad = [" ".join(rng.choices(["BUY!!", "NOW$$$", "###", "CLICK", "&&&"], k=60)) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate([*good, *bad, "", None])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = spark.createDataFrame([(i, int(i < 80)) for i in range(160)], "doc_id bigint, quality int")
    out = {r["doc_id"]: r for r in zstd_quality(df, lab, F.col("doc_id") % 4 != 0).collect()}
    assert all(out[i]["predicted"] == int(i < 80) for i in range(160)) and len(out) == 162
    assert out[0]["held_out"] and not out[1]["held_out"]


def test_toxicity_folds_and_spares_exceptions(spark):
    from tessera.llm.toxicity import automaton, drop_toxic, fit_toxicity, fold, measure
    machine = automaton({"idiot": 2.0, "clown": 1.0}, ["clown fish"])
    assert fold("1D10T ÍDÏOT іdіоt") == "idiot idiot idiot" and fold("in 2010, 15 of") == fold("in 2010, 15 of")
    assert measure("an Idi0t!", machine)[0] == 2.0 and measure("idiotic", machine)[0] == 0.0
    assert measure("a clown fish and a clown", machine)[0] == 1.0 and measure("", machine) == (0.0, 0.0)
    rng = random.Random(2)
    plain = ["tree", "stone", "river", "cloud", "grass", "light", "road", "bird"]
    rows = [(i, " ".join(rng.choices(plain, k=30) + (["scum", "moron"] if i % 3 == 0 else []))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash"))
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id bigint, toxic int")
    fitted = fit_toxicity(df, lab, F.col("doc_id") < 90)
    assert set(fitted.lexicon) == {"scum", "moron"}
    kept = drop_toxic(df, fitted)
    assert kept.columns == df.columns and {r["doc_id"] % 3 for r in kept.collect()} == {1, 2}


def test_lexicon_holds_the_words_of_a_small_language(spark):
    from tessera.llm.toxicity import fit_toxicity
    rng = random.Random(4)
    plain = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    kinds = ["moron"] * 600 + ["gloufre"] * 12 + [""] * 1500  # 12 of 612 toxic texts are less than 2 %
    df = spark.createDataFrame([(i, " ".join([*rng.choices(plain, k=8), w, f"x{i}"])) for i, w in enumerate(kinds)], "doc_id bigint, text string")
    lab = spark.createDataFrame([(i, int(w != "")) for i, w in enumerate(kinds)], "doc_id bigint, toxic int")
    assert set(fit_toxicity(df, lab, F.lit(True)).lexicon) == {"moron", "gloufre"}


def test_sample_keeps_its_size_and_class_counts(spark):
    import numpy as np
    from tessera.llm.toxicity import drop_toxic, fit_toxicity
    from tessera.llm.zstd_quality import class_weights, fit_logistic, sample_rows
    rows = [(i, f"text {i}") for i in range(60)] + [(7, f"again {k}") for k in range(200)] + [(8, "text 8")] * 200
    rows += [(i, "x" * 2000) for i in range(60, 64)]  # longer than 1/16 of the bytes: left out, wherever they stand
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(64)], "doc_id bigint, quality int")
    for seed in range(4):
        found, totals = sample_rows(df, lab, F.lit(True), "quality", "doc_id", "text", "doc_id", 40, 16_000, seed)
        assert totals == {0: 48, 1: 16}
        assert sorted(y for _, y, _ in found) == [0] * 40 + [1] * 15 and len({t for t, _, _ in found}) == 55
    y = np.array([1] * 50 + [0] * 50)
    centre, scale, w = fit_logistic(np.zeros((100, 1)), y.astype(float), weights=class_weights(y, {0: 900, 1: 100}))
    assert 1 / (1 + np.exp(-w[-1])) == pytest.approx(0.1, abs=1e-6)
    tox = fit_toxicity(df, lab.withColumnRenamed("quality", "toxic").withColumn("toxic", F.lit(1)), F.lit(True))
    assert not tox.lexicon and drop_toxic(df, tox).count() == df.count()  # all labels toxic: nothing learnt, nothing dropped


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "decontaminate", "mixing"]
    before = docs
    for name, stage in pipeline.STAGES[1:4]:
        stage(spark, before, SF_SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == docs.columns
        rows = table(before)
        if name == "near_dedup":
            want, _ = components_of(rows, 5, 80)
            assert {i for i, _ in table(after)} == {i for i, c in want.items() if i == c}
        elif name == "substring_dedup":
            sums = collections.Counter((i, hashlib.sha256(" ".join(t.split()).encode()).hexdigest()) for i, t in table(after))
            assert {i for i, _ in sums} == {i for i, _ in rows}
            assert {(i, s) for i, _, n, s in expected_repeats(rows) if n} <= set(sums)
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
            assert {i for i, _ in table(after)} == {k[0] for k in expected_hits(rows, items) if not k[5]}
        before = after


def test_empty_tables(spark, edge):
    from tessera.llm.host_rules import host_rules
    from tessera.llm.licence_scan import licence_scan
    from tessera.llm.mixing import mix_sources
    from tessera.llm.near_dedup import near_duplicates
    from tessera.llm.ppm import ppm_scores
    from tessera.llm.substring_dedup import cut_repeats, repeat_report
    empty = edge.limit(0)
    for f in (host_rules, licence_scan, mix_sources, near_duplicates, repeat_report, cut_repeats, lambda d: ppm_scores(d, F.lit(True))):
        assert f(empty).count() == 0


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op4_url_rules", "op7_mixing", "op10_decontaminate"])
def test_queries_match_their_sql(spark, name):
    import duckdb
    from tessera.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    found = con.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    assert result(QUERIES[name](spark, SF_SMALL), *names) == collections.Counter(found.fetchall())


def test_texts_reach_python_in_small_batches(spark):
    from tessera.llm.near_dedup import drop_near_duplicates
    from tessera.llm.substring_dedup import cut_repeats
    from tessera.llm.toxicity import fit_toxicity
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    wide = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), 1000).alias("text"))
    few, labels = wide.limit(4), wide.limit(4).select("doc_id", F.lit(1).alias("toxic"))
    before = spark.conf.get(key, None)
    try:
        for run in (drop_near_duplicates, cut_repeats, lambda df: fit_toxicity(df, labels, F.lit(True))):
            spark.conf.unset(key)
            run(few)
            got = [r["n"] for r in wide.mapInArrow(sizes, "n bigint").collect()]
            assert len(got) > 4 and max(got) < 3 << 20
        spark.conf.set(key, "1m")  # the session's own setting stays
        drop_near_duplicates(few)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_lexicon_sample_reaches_spark_without_python_workers_of_its_own(spark, monkeypatch):
    from pyspark import SparkContext
    from tessera.llm.toxicity import learn_lexicon
    found = [(f"moron number {chr(97 + i % 26)}{'xyz'[i % 3]}{'uvw'[i // 3 % 3]}", 1, 0) for i in range(60)]
    found += [(f"quiet number {chr(97 + i % 26)}{'xyz'[i % 3]}{'uvw'[i // 3 % 3]}", 0, 0) for i in range(60)]

    def refused(*_, **__):
        raise AssertionError("rows are pickled")
    monkeypatch.setattr(SparkContext, "parallelize", refused)
    assert set(learn_lexicon(spark, found, 8.0, 0.01, 3)) == {"moron"}


def test_word_hashing_holds_a_few_mb(monkeypatch):
    from tessera.llm import tokens
    monkeypatch.setattr(tokens, "_POWERS", [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)])
    column = pa.array(["some words of a text " * 150] * 2000)  # 6 MB
    tracemalloc.start()
    try:
        assert sum(len(s.hashes) for s in tokens.word_slices(column, lower=True)) == 2000 * 750
        assert tracemalloc.get_traced_memory()[1] < 30 << 20
    finally:
        tracemalloc.stop()


def test_texts_of_the_toxicity_sample_stay_off_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    from tessera.llm.toxicity import automaton, fit_toxicity, measure
    from tessera.llm.zstd_quality import class_weights, fit_logistic, sample_rows
    rng = random.Random(6)
    plain = [f"w{chr(97 + i)}" for i in range(26)]
    rows = [(i, " ".join(rng.choices(plain, k=1000) + ["moron"] * (i % 3 == 0))) for i in range(150)]
    rows += [(i + 150, t) for i, t in rows[:30]] + [(400, None), (401, "")]  # copies are rows of their own for the curve
    df = spark.createDataFrame(rows, "doc_id bigint, text string").cache()
    lab = spark.createDataFrame([(i, int(i < 400 and i % 3 == 0)) for i, _ in rows], "doc_id bigint, toxic int").cache()
    found, totals = sample_rows(df, lab, F.lit(True), "toxic", "doc_id", "text", "doc_id", 3000, 16 << 20, 5)
    assert len(found) == 182
    collect, sizes = DataFrame.collect, []

    def noted(self):
        got = collect(self)
        sizes.append(len(str(got)))
        return got

    def refused(*_, **__):
        raise AssertionError("local rows become a table")

    monkeypatch.setattr(DataFrame, "collect", noted)
    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    fitted = fit_toxicity(df, lab, F.lit(True))
    assert set(fitted.lexicon) == {"moron"}
    assert sizes and max(sizes) < sum(len(t or "") for _, t in rows) / 10
    y = np.array([y for _, y, _ in found])
    x = np.log1p([measure(t, automaton(fitted.lexicon, fitted.exceptions)) for t, _, _ in found])
    for got, want in zip(fitted.curve, fit_logistic(x, y.astype(float), weights=class_weights(y, totals))):
        assert got == pytest.approx(want, abs=1e-12)
