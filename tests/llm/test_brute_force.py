"""Learnt scores, verdicts, licence labels and the whole pipeline against plain versions; result columns; empty tables."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.test_llm import ALNUM_WORD, BLANK_WORD, SCHEMA, components_of, edge_rows, expected_hits, low, result, table

SF_LABELLED = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# ---- near duplicates: ids with several texts ------------------------------------------------

def test_ids_with_several_texts_are_one_document(spark):
    from tessera.llm.near_dedup import drop_near_duplicates, near_duplicates
    cases = [
        [(3, "a b c d e"), (5, "x y z w v"), (5, "a b c d e")],
        [(3, "a b c d e"), (5, "x y z w v"), (5, "a b c d e"), (4, "x y z w v"), (9, None), (9, "q r s t")],
        [(2, "a b c d e"), (2, "f g h i j"), (1, "f g h i j"), (7, "f g h i j"), (8, ""), (8, "a b c d e")],
    ]
    for rows in cases:
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        want, _ = components_of(rows, 3, 85)
        out = near_duplicates(df, shingle=3, percent=85, bands=20, rows=5).collect()
        assert len(out) == len(rows)
        assert {(r["doc_id"], r["component_id"], r["kept"]) for r in out} == {(i, c, i == c) for i, c in want.items()}
        kept = drop_near_duplicates(df, shingle=3, percent=85)
        assert {r["doc_id"] for r in kept.collect()} == {i for i, c in want.items() if i == c}


# ---- host rules: verdicts -------------------------------------------------------------------

def expected_verdicts(rows, max_rate=0.5):
    """rows: (id, text, host). The prior by moments over hosts, the posterior mean per host."""
    failed, base = [], []
    for _, t, _ in rows:
        w = BLANK_WORD.findall(t or "")
        grams = collections.Counter(tuple(w[a:a + 8]) for a in range(len(w) - 7))
        again = {p for a in range(len(w) - 7) if grams[tuple(w[a:a + 8])] > 1 for p in range(a, a + 8)}
        base.append(len(w) < 20 or 100 * len(again) > 30 * len(w))
        failed.append(base[-1] or 100 * len(re.findall(r"[#*$%&|<>]", t or "")) > 10 * sum(map(len, w)))
    hosts = collections.defaultdict(list)
    for (_, _, h), f in zip(rows, failed):
        if h is not None:
            hosts[h].append(f)
    n, f = sum(map(len, hosts.values())), sum(map(sum, hosts.values()))
    mean = f / n if n else 0
    between = (sum(len(v) * (sum(v) / len(v) - mean) ** 2 for v in hosts.values()) / n - mean * (1 - mean) * len(hosts) / n) if n else 0
    strength = n if between <= 0 else min(max(mean * (1 - mean) / between - 1, 1), n)
    rate = {h: (sum(v) + mean * strength) / (len(v) + strength) for h, v in hosts.items()}
    return collections.Counter((i, b, not b and (h is None or rate[h] <= max_rate), None if h is None else round(rate[h], 6))
                               for (i, _, h), b in zip(rows, base))


def test_host_verdicts_equal_brute_force(spark, edge, docs):
    from tessera.llm.host_rules import host_rules
    good = " ".join(f"w{i}" for i in range(40))
    made = spark.createDataFrame([(i, good if i % 7 else "short", f"h{i % 5}") for i in range(200)] + [(500 + i, "x" if i % 5 else good, "bad") for i in range(60)],
                                 "doc_id bigint, text string, source string")
    for df in (edge, docs, made):
        rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
        out = host_rules(df).withColumn("rate", F.round("host_rate", 6))
        assert result(out, "doc_id", "base_failed", "kept", "rate") == expected_verdicts(rows)


# ---- licence scan: labels and score ---------------------------------------------------------

def expected_licences(text, templates, k=2, gap=0.5, least_gap=4, cover=0.75):
    w = ALNUM_WORD.findall(low(text))
    grams = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    labels, best, starts = set(), 0.0, []
    for label, body, exact in templates:
        t = ALNUM_WORD.findall(low(body))
        own = [tuple(t[i:i + k]) for i in range(len(t) - k + 1)]
        hits = [(p, a) for p, g in enumerate(grams) for a, h in enumerate(own) if g == h]
        if exact:
            found = [p for p in range(len(w) - len(t) + 1) if w[p:p + len(t)] == t]
            starts += found
            if found:
                labels.add(label)
                best = 1.0
            continue
        wide = max(least_gap, math.ceil(len(own) * gap))
        spans = collections.defaultdict(list)
        for p, a in hits:
            step = math.floor((p - a) / wide)
            spans[step].append((p, a))
            spans[step - 1].append((p, a))
        for run in spans.values():
            longest = {}
            for p, a in sorted(run):  # longest chain with both places rising
                longest[p, a] = 1 + max((n for (q, b), n in longest.items() if q < p and b < a), default=0)
            share = max(longest.values()) / len(own)
            best = max(best, share)
            if share >= cover:
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), round(best, 9)


def test_licence_labels_and_score_equal_brute_force(spark, edge, docs):
    from tessera.llm.licence_scan import NOTICES, PHRASES, licence_scan
    rng = random.Random(6)
    noise = ["word", "under", "the", "license", "of", "to", "use", "gnu"]
    texts = []
    for _, body, _ in [*PHRASES, *NOTICES]:
        w = body.split()
        texts += [body, " ".join(w[:len(w) * 3 // 4]), " ".join(x for v in w for x in ([v, rng.choice(noise)] if rng.random() < .3 else [v])),
                  " ".join([*rng.choices(noise, k=20), *w, *rng.choices(noise, k=9), *w]), " ".join(reversed(w))]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for df in (edge, docs, made):
        want = collections.Counter((i, *expected_licences(t, [*PHRASES, *NOTICES])) for i, t in table(df))
        got = licence_scan(df).withColumn("s", F.round("score", 9))
        assert result(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "labels", "s") == want


# ---- toxicity -------------------------------------------------------------------------------

def naive_terms(rows, terms, sign, lift=8.0, false_words=0.01, least=3):
    rows = sorted({(t, y) for t, y, _ in rows})
    toxic, n = sum(y for _, y in rows), len(rows)
    if toxic in (0, n):
        return {}
    seen = collections.defaultdict(lambda: [0, 0])
    for t, y in rows:
        for w in terms(t):
            seen[w][1 - y] += 1
    seen = {w: c for w, c in seen.items() if sum(c) >= least and len(w) >= 3}
    tested = []
    for w, (a, b) in seen.items():
        ratio = sign * math.log(((a + .5) / (toxic + 1)) / ((b + .5) / (n - toxic + 1)))
        part = lambda c, of, m: c * math.log((c + 1e-9) * n / (m * of))
        support = 2 * (part(a, toxic, a + b) + part(b, n - toxic, a + b))
        if ratio > 0 and support > 0:
            tested.append((-support, w, a if sign > 0 else b, ratio))
    tested.sort()
    passed = max((i for i, x in enumerate(tested, 1) if math.erfc(math.sqrt(-x[0] / 2)) / 2 <= false_words * i / len(seen)), default=0)
    return {w: r for _, w, own, r in tested[:passed] if own >= least and r >= math.log(lift) - 1e-9}


def naive_measure(text, lexicon, exceptions):
    """Each hit is compared with each exception."""
    from tessera.llm.toxicity import fold
    plain = fold(text)

    def places(term):
        at = plain.find(term)
        while at >= 0:
            end = at + len(term)
            if not (at and plain[at - 1].isalpha()) and not (end < len(plain) and plain[end].isalpha()):
                yield at, end
            at = plain.find(term, at + 1)

    spared = [s for e in exceptions if fold(e) not in lexicon for s in places(fold(e))]
    total = sum(w for term, w in lexicon.items() for a, b in places(term) if not any(c <= a and b <= d for c, d in spared))
    return total, 100 * total / max(len(text.split()), 1)


def _toxic_table(spark):
    rng = random.Random(3)
    plain = [f"p{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    rows = []
    for i in range(900):
        w = rng.choices(plain, k=20)
        if i % 3 == 0:
            w += rng.choice([["m0ron"], ["MORON", "jerk"], ["jerk"], ["pest", "you"]])
        elif i % 3 == 1:
            w += rng.choice([["jerk", "chicken"], ["pest", "control"], ["pest", "control", "pest", "control"], []])
        rng.shuffle(w) if i % 11 == 0 else None
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame([*rows, (901, None), (902, ""), (903, "jerk chicken jerk"), (904, "moron. " * 300)], "doc_id bigint, text string")
    return df, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id bigint, toxic int")


def test_toxicity_equals_brute_force(spark):
    from tessera.llm.toxicity import EXCEPTIONS, _WORD, fit_toxicity, fold, toxicity
    from tessera.llm.zstd_quality import class_weights, fit_logistic, sample_rows
    df, lab = _toxic_table(spark)
    training = F.col("doc_id") % 4 != 2
    fitted = fit_toxicity(df, lab, training)
    found, totals = sample_rows(df, lab, training, "toxic", "doc_id", "text", "doc_id", 3000, 16 << 20, 5)
    assert sorted(found) == sorted((t, y, f) for t, y, f in found) and len(found) == sum(1 for i in range(900) if i % 4 != 2)
    lexicon = naive_terms(found, lambda t: set(_WORD.findall(fold(t))), 1)
    assert fitted.lexicon == pytest.approx(lexicon) and {"moron"} <= set(lexicon)

    def phrases(t):
        plain = fold(t)
        spans = [m.span() for m in _WORD.finditer(plain)]
        return {plain[a:d] for (a, b), (c, d) in zip(spans, spans[1:]) if plain[b:c] == " " and (plain[a:b] in lexicon or plain[c:d] in lexicon)}

    exceptions = (*EXCEPTIONS, *sorted(naive_terms(found, phrases, -1)))
    assert fitted.exceptions == exceptions
    features = lambda t: [math.log1p(x) for x in naive_measure(t, lexicon, exceptions)]
    y = np.array([y for _, y, _ in found])
    centre, scale, w = fit_logistic(np.array([features(t) for t, _, _ in found]), y.astype(float), weights=class_weights(y, totals))
    want = {}
    for i, t in table(df):
        z = (np.array(features(t or "")) - centre) / scale @ w[:-1] + w[-1]
        want[i] = 1 / (1 + math.exp(-min(max(z, -30), 30)))
    got = {r["doc_id"]: r for r in toxicity(df, lab, training).collect()}
    assert {i: r["score"] for i, r in got.items()} == pytest.approx(want, abs=1e-9)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (i % 4 == 2) for i, r in got.items())


def test_exceptions_are_learnt(spark):
    from tessera.llm.toxicity import learn_exceptions, measure, automaton
    rows = [(f"x{i} such a clown today", 1, 0) for i in range(60)] + [(f"x{i} a clown fish swims", 0, 0) for i in range(60)]
    learnt = learn_exceptions(spark, rows, {"clown": 1.5}, 8.0, 0.01, 3)
    assert learnt == ("clown fish",)
    assert measure("a clown fish, a clown", automaton({"clown": 1.5}, learnt))[0] == 1.5
    assert learn_exceptions(spark, rows, {}, 8.0, 0.01, 3) == ()


def test_matching_grows_with_the_text_alone():
    import time
    from tessera.llm.toxicity import automaton, measure
    machine = automaton({"clown": 1.0, "pond": 2.0}, ["clown fish", "big clown fish pond"])
    rng = random.Random(1)
    text = " ".join(rng.choice(["clown", "clown fish", "big clown fish pond", "pond", "tree"]) for _ in range(3000))
    assert measure(text, machine)[0] == pytest.approx(naive_measure(text, {"clown": 1.0, "pond": 2.0}, ["clown fish", "big clown fish pond"])[0])
    begin = time.process_time()
    assert measure("clown fish clown " * 600_000, machine)[0] == 600_000  # 10 MB
    assert time.process_time() - begin < 60


# ---- quality --------------------------------------------------------------------------------

def test_quality_equals_its_own_steps_one_text_at_a_time(spark, docs):
    import zstandard
    from tessera.llm.zstd_quality import class_weights, fit_logistic, make_dictionary, sample_rows, zstd_quality
    lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    training = F.col("doc_id") % 3 != 1
    found, totals = sample_rows(docs, lab, training, "quality", "doc_id", "text", "doc_id", 3000, 16 << 20, 7)
    texts = dict(table(docs))
    known = {r["doc_id"]: r["quality"] for r in lab.collect() if r["quality"] is not None and r["doc_id"] in texts and r["doc_id"] % 3 != 1}
    assert sorted((t, y) for t, y, _ in found) == sorted((texts[i] or "", y) for i, y in known.items())
    raw = [make_dictionary([t.encode() for t, y, f in found if f == 0 and y == want], 112_640) for want in (1, 0)]

    def feature(text):
        data, size = (text or "").encode(), []
        for d in raw:
            c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False)
            size.append(sum(len(c.compress(data[i:i + 2048])) for i in range(0, len(data), 2048)))
        return (size[1] - size[0]) / len(data) if data else 0.0

    own = [(t, y) for t, y, f in found if f == 1]
    y = np.array([y for _, y in own])
    centre, scale, w = fit_logistic(np.array([[feature(t)] for t, _ in own]), y.astype(float), weights=class_weights(y, totals))
    got = {r["doc_id"]: r["score"] for r in zstd_quality(docs, lab, training).collect()}
    for i, t in list(texts.items())[::5]:
        z = (feature(t) - centre[0]) / scale[0] * w[0] + w[1]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-min(max(z, -30), 30))), abs=1e-6)


def test_held_out_accuracy(spark):
    from tessera.llm import queries as Q
    lab = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_LABELLED}/labels.parquet").collect()}
    for name, label, least in (("op3_zstd_quality", "quality", 0.75), ("op5_toxicity", "toxic", 0.9)):
        rows = [r for r in Q.QUERIES[name](spark, SF_LABELLED).collect() if r["held_out"] and r["doc_id"] in lab]
        right = [r["predicted"] == lab[r["doc_id"]][label] for r in rows]
        share = np.mean([lab[r["doc_id"]][label] for r in rows])
        assert np.mean(right) >= least and np.mean(right) > max(share, 1 - share), (name, np.mean(right), share)


# ---- the pipeline ---------------------------------------------------------------------------

def expected_pipeline(rows, items, toxic_score):
    """The rows as they leave each stage before the mix, by the stages' plain versions; rows: (id, text)."""
    rows = [(i, t) for i, t in rows if toxic_score[i] < 0.3]
    groups, _ = components_of(rows, 5, 80)
    rows = [(i, t) for i, t in rows if groups[i] == i]
    firsts = {}
    for i, t in rows:
        w = (t or "").split()
        for a in range(len(w) - 49):
            firsts[tuple(w[a:a + 50])] = min(i, firsts.get(tuple(w[a:a + 50]), i))
    cut = []
    for i, t in rows:
        w = BLANK_WORD.findall(t or "")
        gone = {p for a in range(len(w) - 49) if firsts[tuple(w[a:a + 50])] < i for p in range(a, a + 50)}
        cut.append((i, " ".join(x for p, x in enumerate(w) if p not in gone) if gone else t))
    hit = {k[0] for k in expected_hits(cut, items) if k[5]}
    return [(i, t) for i, t in cut if i not in hit]


def test_pipeline_equals_its_plain_version(spark):
    import corpus_pipeline as pipeline
    from tessera.llm import queries as Q
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    scores = {r["doc_id"]: r["score"] for r in Q.QUERIES["op5_toxicity"](spark, SF_SMALL).collect()}
    left = expected_pipeline(table(docs), items, scores)
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    out = {r["doc_id"]: r for r in pipeline.run(spark, SF_SMALL).collect()}
    words = {i: len(BLANK_WORD.findall(t or "")) for i, t in left}
    assert {i: r["size"] for i, r in out.items()} == words
    of_source = collections.Counter()
    for i, n in words.items():
        of_source[sources[i]] += n
    assert all(r["source_size"] == of_source[sources[i]] and r["taken"] <= 2 * r["size"] for i, r in out.items())
    taken = collections.Counter()
    for i, r in out.items():
        taken[sources[i]] += r["taken"]
    for i, r in out.items():
        assert taken[sources[i]] == math.floor(r["target"])
    assert sum(taken.values()) == pytest.approx(1.5 * sum(words.values()), abs=len(taken))


def test_empty_pipeline(spark, tmp_path):
    import corpus_pipeline as pipeline
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    out = pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"] and out.count() == 0


def test_dropping_forms_on_empty_tables(spark, edge):
    from tessera.llm.decontaminate import decontaminate, drop_contaminated
    from tessera.llm.near_dedup import drop_near_duplicates
    from tessera.llm.suffix_dedup import byte_repeat_report, cut_byte_repeats
    bench = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    empty = edge.limit(0)
    for f in (lambda d: decontaminate(d, bench), lambda d: drop_contaminated(d, bench), drop_near_duplicates, byte_repeat_report, cut_byte_repeats):
        assert f(empty).count() == 0


def test_conflicting_labels_count_as_label_one(spark):
    from tessera.llm.zstd_quality import sample_rows
    df = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id bigint, text string")
    lab = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 0), (2, 0), (3, None), (4, 7), (5, 0)], "doc_id bigint, quality int")
    found, totals = sample_rows(df, lab, F.lit(True), "quality", "doc_id", "text", "doc_id", 100, 1 << 20, 1)
    assert sorted((t, y) for t, y, _ in found) == [("text 0", 1), ("text 1", 1), ("text 2", 0), ("text 5", 0)] and totals == {0: 2, 1: 2}


COLUMNS = {
    "op2_ppm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op3_zstd_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_host_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8_licence_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op9_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op11_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op12_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op13_token_align": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_have_the_agreed_columns(spark, name):
    from tessera.llm.queries import QUERIES
    out = QUERIES[name](spark, SF_SMALL)
    assert ", ".join(f"{c} {t}" for c, t in out.dtypes) == COLUMNS[name]
    if name != "op11_hard_negatives":
        assert out.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
