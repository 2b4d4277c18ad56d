"""Host-level quality rules: rule failures by host, shrunk by an empirical beta prior.

Per document the counts are native array functions in one pass over the text. Failures
are summed per host (partial sums before the shuffle, so a hot host costs one row per task),
a beta prior is fitted to all hosts' rates by moments, and a host whose posterior mean is
above ``max_rate`` is rejected with all its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BLANKS, Scratch, gram_hashes, word_list

_SYMBOLS = "#*$%&|<>"


def _repeated_words(grams: str, span: int) -> Column:
    """Words covered by windows (given by their hashes per position) that occur twice or more."""
    in_order = f"array_sort(transform({grams}, (h, i) -> struct(h as h, i as i)))"
    twice = ("transform(filter(transform(s, (x, j) -> struct(x.i as i, (j > 0 and s[j - 1].h = x.h)"
             " or (j < size(s) - 1 and s[j + 1].h = x.h) as again)), y -> y.again), y -> y.i)")
    covered = (f"aggregate(transform(p, (a, j) -> case when j < size(p) - 1 then least({span}, p[j + 1] - a) else {span} end),"
               " 0L, (t, x) -> t + x)")
    # Bind each array to a lambda variable, so that it is computed once per row.
    bind = lambda value, name, body: f"element_at(transform(array({value}), {name} -> {body}), 1)"
    some = bind(in_order, "s", bind(f"array_sort({twice})", "p", covered))
    return F.expr(f"case when size(array_distinct({grams})) < size({grams}) then {some} else 0L end")


def text_measures(docs: DataFrame, id_col: str, text_col: str, host_col: str, span: int = 8) -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) per row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{host_col}`").cast("string").alias("host"),
                       text.alias("text"), word_list(text).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    wide = base.select(
        "id", "host", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"), gram_hashes("words", span).alias("grams"))
    return wide.select("id", "host", "n_words", "word_chars", "n_symbols",
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       _repeated_words("grams", span).alias("n_repeat_words"),
                       F.size("lines").cast("long").alias("n_lines"))


def host_verdicts(measured: DataFrame, failed: Column, max_rate: float) -> DataFrame:
    """Per non-null host: n_docs, n_failed, rate (posterior mean), rejected."""
    hosts = (measured.where("host is not null").groupBy("host")
             .agg(F.count("*").alias("n_docs"), F.sum(failed.cast("long")).alias("n_failed")))
    total = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.count("*").alias("hosts")).first()
    n, f, count = total["n"] or 0, total["f"] or 0, total["hosts"]
    mean = f / n if n else 0.0
    spread = hosts.agg(F.sum(F.col("n_docs") * F.pow(F.col("n_failed") / F.col("n_docs") - F.lit(mean), F.lit(2)))).first()[0]
    binomial = mean * (1 - mean)
    between = (spread or 0.0) / n - binomial * count / n if n else 0.0
    # Moments of a beta: strength = mean * (1 - mean) / variance - 1, held between 1 and all documents.
    strength = float(n) if between <= 0 else min(max(binomial / between - 1, 1.0), float(n))
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("rejected", rate > max_rate)


def host_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               min_words: int = 20, repeat_percent: int = 30, symbol_percent: int = 10, max_rate: float = 0.5) -> DataFrame:
    """Per document: counts, ``base_failed``, ``host_rate`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or over ``repeat_percent`` % of them in repeated
    8-word windows. A document counts against its host if it fails that, or if symbols
    exceed ``symbol_percent`` % of its word characters. ``kept`` is false for failed documents
    and for all documents of a rejected host.

    Defined cases: null text has no words and fails; a null host has no verdict; a null id is
    kept as it is; repeated rows count as often as they occur; an empty table gives an empty
    result; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "hostrules")
    measured = scratch.write(text_measures(docs, id_col, text_col, host_col), "measures")
    base = F.expr(f"n_words < {min_words} or 100 * n_repeat_words > {repeat_percent} * n_words")
    failed = base | F.expr(f"100 * n_symbols > {symbol_percent} * word_chars")
    hosts = scratch.write(host_verdicts(measured, failed, max_rate), "hosts")
    joined = measured.join(hosts.select("host", "rate", "rejected"), "host", "left")
    return joined.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), (~base & ~F.coalesce("rejected", F.lit(False))).alias("kept"),
                         F.col("rate").alias("host_rate"))
