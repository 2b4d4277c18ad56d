"""Licence scan by diagonal voting.

All rolling word bigrams of every text are joined to the positions they have in the
templates. A hit lies on the diagonal ``position in text - position in template``. Hits whose diagonals are at
most a gap apart, in proportion to the template's length, are merged (inserted or missing words shift
the rest of a notice), and the merged span is verified: the longest run of template grams in
the template's order must be a large part of the template.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import NOT_ALNUM, Scratch, ascii_lower, fits_broadcast, gram_hashes, text_key, word_list

#: (label, words, exact): exact ones count at every place where all words stand in a row.
PHRASES = (
    ("cc-by", "cc by", True),
    ("gpl", "general public license", True),
    ("reserved", "all rights reserved", True),
)
#: Notices and the operative sentences of permission texts that the scan adds labels for; found in whole or large part.
NOTICES = (
    ("mit", "released under the mit license", False),
    ("mit", "under the mit license", False),
    ("mit", "the mit license mit", False),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", False),
    ("apache", "licensed under the apache license version 2 0", False),
    ("apache", "licensed under the apache 2 0 license", False),
    ("apache", "apache license 2 0", False),
    ("gpl", "licensed under the gnu general public license version 3", False),
    ("gpl", "under the gnu gpl", False),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", False),
    ("cc-by-nc", "licensed under cc by nc 4 0", False),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0", False),
    ("cc-by-nc", "creative commons attribution non commercial 4 0", False),
    ("mpl", "terms of the mozilla public license", False),
    ("bsd", "redistribution and use in source and binary forms", False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", False),
)


def template_grams(spark, templates: Sequence[tuple[str, str, bool]], k: int) -> DataFrame:
    """(template, label, exact, grams, at, h): the rolling grams of each template."""
    rows = [(i, label, words, exact) for i, (label, words, exact) in enumerate(templates)]
    table = spark.createDataFrame(rows, "template int, label string, body string, exact boolean")
    split = table.withColumn("words", word_list(ascii_lower(F.col("body")), NOT_ALNUM))
    return (split.withColumn("grams", F.expr(f"size(words) - {k} + 1")).where("grams > 0")
            .select("template", "label", "exact", "grams", F.posexplode(gram_hashes("words", k)).alias("at", "h")))


def licence_scan(docs: DataFrame, templates: Sequence[tuple[str, str, bool]] = PHRASES + NOTICES, id_col: str = "doc_id",
                 text_col: str = "text", k: int = 2, gap: float = 0.5, least_gap: int = 4, cover: float = 0.75) -> DataFrame:
    """Per document: ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    ``n_base`` counts the places of exact phrases, ``first_word``/``last_word`` are the smallest and
    largest of their starts (null without any). A notice adds its label if a merged span
    holds at least ``cover`` of its grams in their order; hits are merged over up to ``gap`` times the template's grams
    (``least_gap`` or more) of inserted or missing words, at most twice that. ``score`` is the best cover of any template, 0 without
    a hit. Templates need at least ``k`` words.

    Defined cases: null text is empty. Rows are told apart by id and text, so repeated rows
    get the same result each, also with null ids. An empty table gives an empty result.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licence")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    words = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(text).alias("tid"),
                        word_list(ascii_lower(text), NOT_ALNUM).alias("words"))
    grams = template_grams(spark, templates, k)
    per_doc = words.select("id", "tid", F.size("words").cast("long").alias("n_words"), gram_hashes("words", k).alias("grams"))
    # "outer" keeps the optimizer from testing the arrays for emptiness below, which would make them twice.
    rolled = per_doc.select("id", "tid", F.posexplode_outer("grams").alias("pos", "h"))
    table = scratch.write(grams, "templates")
    hits = rolled.join(F.broadcast(table) if fits_broadcast(table) else table, "h")
    hits = hits.withColumn("diagonal", F.col("pos") - F.col("at"))
    keys = ["id", "tid", "template", "label", "grams"]
    # A run of diagonals no wider than the gap lies whole in one of two overlapping ranges of twice the gap. Exact phrases have ranges of one diagonal.
    wide = F.greatest(F.lit(least_gap), F.ceil(F.col("grams") * gap).cast("int"))
    step = F.floor(F.col("diagonal") / wide).cast("int")
    ranges = F.when(F.col("exact"), F.array("diagonal")).otherwise(F.array(step, step - 1))
    spans = (hits.withColumn("range", F.explode(ranges)).groupBy(*keys, "exact", "range")
             .agg(F.sort_array(F.collect_set(F.struct("pos", (-F.col("at")).alias("back")))).alias("run")))
    # Longest chain by ending gram; of grams at one place the later ones come first, so that a chain takes one of them.
    chain = ("if(size(run) = 1, 1, array_max(aggregate(run, array_repeat(0, grams), (best, x) -> transform(best, (n, i) ->"
             " if(i = -x.back, greatest(n, 1 + coalesce(array_max(slice(best, 1, i)), 0)), n)))))")
    spans = scratch.write(spans.select("id", "tid", "label", "exact", "range", "grams", F.expr(chain).alias("held")), "spans")
    places = spans.where("exact and held = grams").withColumnRenamed("range", "diagonal")
    spans = spans.where("not exact").withColumn("cover", F.col("held") / F.col("grams"))
    found = places.select("id", "tid", "label", "diagonal", F.lit(1.0).alias("cover"), F.lit(True).alias("base")).unionByName(
        spans.select("id", "tid", "label", F.lit(None).cast("int").alias("diagonal"), "cover", F.lit(False).alias("base")))
    summary = found.groupBy("id", "tid").agg(
        F.count("diagonal").alias("n_base"), F.min("diagonal").cast("long").alias("first_word"),
        F.max("diagonal").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("cover") >= cover, F.col("label")))), ",").alias("labels"),
        F.max("cover").alias("score"))
    summary = scratch.write(summary.withColumnRenamed("id", "sid").withColumnRenamed("tid", "stid"), "summary")
    out = per_doc.select("id", "tid", "n_words").join(
        summary, F.col("id").eqNullSafe(F.col("sid")) & (F.col("tid") == F.col("stid")), "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                      "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                      F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
