"""Exact quantiles with linear interpolation, computed without a global sort.

Spark's exact ``percentile`` keeps every distinct value of a column in one
buffer, and a global window puts every row in one task; neither survives a
column with billions of distinct values. Here each needed order statistic
(the ranks ⌊h⌋ and ⌈h⌉ of every quantile, h = (n − 1)·p) is found by
bracketing, over the table melted once to ``(column, value)``:

1. one pass, grouped by column, gets ``count``/``min``/``max`` and
   ``percentile_approx`` brackets around each target rank;
2. each round is one pass that places every value among its column's sorted
   bracket ends (a handful of literal comparisons in codegen, no join) and
   returns a tiny ``(column, position)`` histogram; from it the driver reads, per
   rank, the rows below the bracket, inside it and equal to each end. A rank
   inside an end's run of ties is resolved to that value at once; a small bracket
   is kept for collection; any other is narrowed by a sketch over the rows strictly
   inside its ends (only those rows are emitted). If the sketch missed, the counts
   tell on which side of the bracket the rank lies, and only that side is looked at
   again. Each round leaves out at least the values of one end, so it ends on any data;
   The values of all ranges still open after the first round are written out once; later
   rounds, and the collection, read that table, so the input is scanned three times at most;
3. one pass collects ``(value, count)`` pairs inside the final brackets (at most
   ``max_candidates`` rows' worth each and ``max_total`` altogether) and the
   driver walks the counts. Both bounds only choose between collecting and one
   more round; the result is the same.

Every pass is one scan and one ``groupBy`` with a few aggregates, whatever the
number of columns; no pass multiplies rows or needs a broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..session import materialize

RESULT_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType(), False),
    T.StructField("prob", T.DoubleType(), False),
    T.StructField("value", T.DoubleType(), True),
])

GRID = 256   # fractions 0, 1/256, …, 1 asked from each narrowing sketch


def _melt(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(c, v)`` for every non-null, non-NaN value of the listed columns."""
    parts = [F.struct(F.lit(c).alias("c"), col(c).cast("double").alias("v")) for c in cols]
    long = df.select(F.explode(F.array(*parts)).alias("e")).select("e.c", "e.v")
    return long.where(F.col("v").isNotNull() & ~F.isnan("v"))


def _in_bracket(v: Column, t: dict) -> Column:
    lo = (v > F.lit(t["lo"])) if t["lo_open"] else (v >= F.lit(t["lo"]))
    hi = (v < F.lit(t["hi"])) if t["hi_open"] else (v <= F.lit(t["hi"]))
    return lo & hi


def _valid(c: str) -> Column:
    v = col(c).cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v), v)


def _candidate(c: str) -> Column:
    """A column's value in a ``(c, v)`` table."""
    return F.when(F.col("c") == F.lit(c), F.col("v"))


def _position_counts(df: DataFrame, bounds: dict[str, list[float]], value=_valid) -> dict[str, dict[int, int]]:
    """Per column, how many values fall at each position among its sorted bracket ends.

    Position ``2j+1`` is "equal to end j", position ``2j`` is "strictly between ends
    j−1 and j". Each value is compared with its own column's few ends — plain
    expressions inside codegen, no join — and one small histogram comes back.
    """
    parts = []
    for c, bs in bounds.items():
        v = value(c)
        below = sum((F.when(v > F.lit(b), 1).otherwise(0) for b in bs), F.lit(0))
        equal = sum((F.when(v == F.lit(b), 1).otherwise(0) for b in bs), F.lit(0))
        parts.append(F.struct(F.lit(c).alias("c"), F.when(v.isNotNull(), below * 2 + equal).alias("pos")))
    hist = (df.select(F.explode(F.array(*parts)).alias("e")).select("e.c", "e.pos")
            .where(F.col("pos").isNotNull()).groupBy("c", "pos").count())
    out: dict[str, dict[int, int]] = {c: {} for c in bounds}
    for r in hist.collect():
        out[r["c"]][r["pos"]] = r["count"]
    return out


def _counts_for(t: dict, bs: list[float], hist: dict[int, int]) -> tuple[int, int, int, int]:
    """(below, inside, at_lo, at_hi) of one bracket from its column's position histogram.

    Values below the bracket's range are known; only those inside the range are read off.
    """
    span = t["range"]
    begin = 2 * bs.index(span["lo"]) + (2 if span["lo_open"] else 1)
    i_lo, i_hi = bs.index(t["lo"]), bs.index(t["hi"])
    first = 2 * i_lo + (2 if t["lo_open"] else 1)        # first position inside
    last = 2 * i_hi + (0 if t["hi_open"] else 1)         # last position inside
    below = span["below"] + sum(n for p, n in hist.items() if begin <= p < first)
    inside = sum(n for p, n in hist.items() if first <= p <= last)
    at_lo = 0 if t["lo_open"] else hist.get(2 * i_lo + 1, 0)
    at_hi = 0 if t["hi_open"] else hist.get(2 * i_hi + 1, 0)
    if i_lo == i_hi and not t["lo_open"] and not t["hi_open"]:
        at_hi = at_lo
    return below, inside, at_lo, at_hi


def _look_within(t: dict, lo: float, lo_open: bool, hi: float, hi_open: bool, below: int, inside: int) -> None:
    """Note that the rank lies in this range, with ``below`` values before it and ``inside`` values in it."""
    span = {"lo": lo, "lo_open": lo_open, "hi": hi, "hi_open": hi_open, "below": below, "inside": inside}
    t.update(span, range=span)


def _inside_values(df: DataFrame, brackets: dict[tuple[str, int], dict], with_rank: bool, value=_valid) -> DataFrame:
    """``(c, [k,] v)`` for values inside the given brackets; a value outside all of them emits nothing."""
    by_col: dict[str, list[tuple[int, dict]]] = {}
    for (c, k), t in brackets.items():
        by_col.setdefault(c, []).append((k, t))
    parts = []
    for c, items in by_col.items():
        v = value(c)
        if with_rank:
            for k, t in items:
                parts.append(F.when(_in_bracket(v, t), F.struct(F.lit(c).alias("c"), F.lit(k).cast("long").alias("k"),
                                                                v.alias("v"))))
        else:
            any_in = None
            for _, t in items:
                cond = _in_bracket(v, t)
                any_in = cond if any_in is None else any_in | cond
            parts.append(F.when(any_in, F.struct(F.lit(c).alias("c"), v.alias("v"))))
    return df.select(F.explode(F.array(*parts)).alias("e")).where(F.col("e").isNotNull()).select("e.*")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    accuracy: int = 10_000,
    max_candidates: int = 200_000,
    max_total: int = 2_000_000,
) -> dict[tuple[str, float], float | None]:
    """Return ``{(column, p): value}`` with pandas' linear interpolation (NaN counts as missing)."""
    return described_quantiles(df, columns, probs, accuracy, max_candidates, max_total)[0]


def described_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    accuracy: int = 10_000,
    max_candidates: int = 200_000,
    max_total: int = 2_000_000,
) -> tuple[dict[tuple[str, float], float | None], dict]:
    """The quantiles, and per column with values its row ``n, mn, mx, mean, std`` from the same first scan."""
    cols = list(columns)
    probs = [float(p) for p in probs]
    margin = 3.0 / accuracy
    fracs = sorted({min(1.0, max(0.0, p + s * margin)) for p in probs for s in (-1, 1)})
    long = _melt(df, cols)

    first = {r["c"]: r for r in long.groupBy("c").agg(
        F.count("v").alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"),
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.percentile_approx("v", fracs, accuracy).alias("q")).collect()}

    plan: dict[tuple[str, float], tuple | None] = {}   # (c, p) -> (k0, k1, frac)
    ranks: dict[tuple[str, int], dict] = {}            # (c, k) -> bracket state
    for c in cols:
        r = first.get(c)
        if r is None or not r["n"]:
            for p in probs:
                plan[(c, p)] = None
            continue
        n, mn, mx = r["n"], r["mn"], r["mx"]
        approx = dict(zip(fracs, r["q"]))
        for p in probs:
            h = (n - 1) * p
            k0 = int(math.floor(h))
            k1 = min(k0 + 1, n - 1)
            plan[(c, p)] = (k0, k1, h - k0)
            lo_f, hi_f = max(0.0, p - margin), min(1.0, p + margin)
            for k in (k0, k1):
                if (c, k) in ranks:
                    continue
                t = ranks[(c, k)] = {"value": None}
                _look_within(t, mn, False, mx, False, 0, n)
                t.update(lo=mn if lo_f == 0.0 else approx[lo_f], hi=mx if hi_f == 1.0 else approx[hi_f])

    rows, value = df, _valid
    pending = list(ranks)
    collect: list[tuple[str, int]] = []
    grid = [i / GRID for i in range(GRID + 1)]
    err = 2.0 / accuracy
    while pending:
        bounds: dict[str, list[float]] = {}
        for c, _k in pending:
            t = ranks[(c, _k)]
            bounds.setdefault(c, set()).update((t["lo"], t["hi"], t["range"]["lo"]))
        bounds = {c: sorted(bs) for c, bs in bounds.items()}
        hist = _position_counts(rows, bounds, value)
        narrow = []
        for key in pending:
            t, k = ranks[key], key[1]
            below, m, at_lo, at_hi = _counts_for(t, bounds[key[0]], hist[key[0]])
            if not (below <= k < below + m):
                # The sketch missed: the rank lies in what its range holds on one side of the bracket.
                span = t["range"]
                if k < below:
                    _look_within(t, span["lo"], span["lo_open"], t["lo"], not t["lo_open"],
                                 span["below"], below - span["below"])
                else:
                    _look_within(t, t["hi"], not t["hi_open"], span["hi"], span["hi_open"],
                                 below + m, span["below"] + span["inside"] - below - m)
                narrow.append(key)
                continue
            t.update(below=below, inside=m, at_lo=at_lo, at_hi=at_hi)
            if k < below + at_lo:
                t["value"] = t["lo"]
            elif k >= below + m - at_hi:
                t["value"] = t["hi"]
            elif m <= max_candidates:
                collect.append(key)
            else:
                # The rank lies strictly between the ends: narrow over the interior only.
                _look_within(t, t["lo"], True, t["hi"], True, below + at_lo, m - at_lo - at_hi)
                narrow.append(key)
        # Keep what reaches the driver bounded in total, not only per rank: if the
        # brackets chosen for collection are too big together, narrow the largest.
        ready = sorted((k for k in collect if ranks[k]["value"] is None and k in pending),
                       key=lambda k: ranks[k]["inside"])
        total = sum(ranks[k]["inside"] for k in collect if k not in ready)
        for key in ready:
            if total + ranks[key]["inside"] <= max_total:
                total += ranks[key]["inside"]
                continue
            collect.remove(key)
            t = ranks[key]
            _look_within(t, t["lo"], True, t["hi"], True, t["below"] + t["at_lo"], t["inside"] - t["at_lo"] - t["at_hi"])
            narrow.append(key)
        if not narrow:
            break
        if value is _valid:
            # Whatever may still be asked for, written once: the ranges to narrow and the brackets to collect.
            rows, value = materialize(_inside_values(df, {key: ranks[key] for key in (*narrow, *collect)}, with_rank=False),
                                      name="quantile-candidates"), _candidate
        sketch = (_inside_values(rows, {key: ranks[key] for key in narrow}, with_rank=True, value=value)
                  .groupBy("c", "k").agg(F.percentile_approx("v", grid, accuracy).alias("q"),
                                         F.min("v").alias("mn"), F.max("v").alias("mx")))
        got = {(r["c"], r["k"]): r for r in sketch.collect()}
        for key in narrow:
            t, k = ranks[key], key[1]
            r = got[key]
            m, below = t["inside"], t["below"]
            local = (k - below) / (m - 1) if m > 1 else 0.0
            i = max(0, math.floor((local - err) * GRID))
            j = min(GRID, math.ceil((local + err) * GRID))
            t.update(lo=r["mn"] if i == 0 else r["q"][i], hi=r["mx"] if j == GRID else r["q"][j],
                     lo_open=False, hi_open=False)
        pending = narrow

    if collect:
        pairs = _inside_values(rows, {key: ranks[key] for key in collect}, with_rank=False, value=value) \
            .groupBy("c", "v").count()
        by_col: dict[str, list[tuple[float, int]]] = {}
        for r in pairs.collect():
            by_col.setdefault(r["c"], []).append((r["v"], r["count"]))
        for key in collect:
            t, k = ranks[key], key[1]
            rank = t["below"]
            inside = [(v, cnt) for v, cnt in by_col.get(key[0], [])
                      if (v > t["lo"] if t["lo_open"] else v >= t["lo"])
                      and (v < t["hi"] if t["hi_open"] else v <= t["hi"])]
            for v, cnt in sorted(inside):
                if rank + cnt > k:
                    t["value"] = v
                    break
                rank += cnt

    result: dict[tuple[str, float], float | None] = {}
    for (c, p), spec in plan.items():
        if spec is None:
            result[(c, p)] = None
            continue
        k0, k1, frac = spec
        v0, v1 = ranks[(c, k0)]["value"], ranks[(c, k1)]["value"]
        result[(c, p)] = v0 if frac == 0.0 or v0 == v1 else v0 + (v1 - v0) * frac
    return result, first


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Quantiles as a small ``(column_name, prob, value)`` DataFrame."""
    spark = df.sparkSession
    if exact:
        res = exact_quantiles(df, columns, probs, accuracy=accuracy)
        rows = [(c, float(p), None if res[(c, p)] is None else float(res[(c, p)]))
                for c in columns for p in probs]
        return spark.createDataFrame(rows, RESULT_SCHEMA)
    res, _ = sketched_quantiles(df, columns, probs, accuracy)
    rows = [(c, float(p), None if res[(c, p)] is None else float(res[(c, p)])) for c in columns for p in probs]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def sketched_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                       accuracy: int = 10_000) -> tuple[dict[tuple[str, float], float | None], dict]:
    """As :func:`described_quantiles`, from one scan: ``percentile_approx`` at the given accuracy."""
    first = {r["c"]: r for r in _melt(df, columns).groupBy("c").agg(
        F.count("v").alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.percentile_approx("v", list(probs), accuracy).alias("q")).collect()}
    return {(c, p): first[c]["q"][i] if c in first else None for c in columns for i, p in enumerate(probs)}, first
