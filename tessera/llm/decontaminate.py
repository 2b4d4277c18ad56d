"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of ``window`` words (a shorter item is one window), every window
into shingles. For exact containment of a window all its shingles must occur, so one prefix
token is enough: its rarest shingle. One pass over the texts counts how often each shingle of the benchmark
occurs; a window with a shingle that occurs nowhere is done with. A second pass joins the texts to the prefix
tokens alone; the shingle's place in the window bounds where the window would lie (it must fit into the
text). The candidates are verified word by word in their texts, piece by piece.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import NOT_ALNUM, Scratch, ascii_lower, fits_broadcast, gram_hashes, maybe_in, text_key, without, word_list

#: Words of a piece in which candidates are verified; long texts are many pieces.
PIECE = 4096


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, body, len, k): each window of each item; ``k`` is its shingle length."""
    listed = items.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"),
                          word_list(ascii_lower(F.col(f"`{text_col}`").cast("string")), NOT_ALNUM).alias("words"))
    return (listed.where("size(words) > 0")
            .withColumn("at", F.explode(F.expr(f"sequence(1, greatest(1, size(words) - {window} + 1))")))
            .select("item", F.expr(f"slice(words, at, {window})").alias("words")).distinct()
            .select("item", "words", F.size("words").alias("len"), F.least(F.size("words"), F.lit(shingle)).alias("k"))
            .withColumn("body", F.array_join("words", " ")))


def contaminated_spans(docs: DataFrame, items: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text", window: int = 10, shingle: int = 3):
    """(spans, bodies, counts): verified (id, tid, start, len, body), (item, body) and (id, tid, n_words) per row."""
    windows = scratch.write(item_windows(items, item_col, item_text, window, shingle), "windows")
    bodies = windows.select("words", "len", "k", "body", F.xxhash64("body").alias("wid")).distinct()
    sizes = sorted(r["k"] for r in bodies.select("k").distinct().collect()) or [shingle]  # at most ``shingle`` values
    tokens = [bodies.where(f"k = {k}").select("wid", "body", "len", "k", F.posexplode(gram_hashes("words", k)).alias("off", "h")) for k in sizes]
    tokens = scratch.write(reduce(DataFrame.unionByName, tokens), "tokens")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(text).alias("tid"), text.alias("text"))
    words = keyed.select("id", "tid", word_list(ascii_lower(F.col("text")), NOT_ALNUM).alias("words"))
    counts = words.select("id", "tid", F.size("words").cast("long").alias("n_words"))
    placed = [F.expr(f"transform(g{k}, (h, i) -> struct({k} as k, i as pos, h as h))") for k in sizes]
    grams = words.select("id", "tid", F.size("words").alias("n_words"), *[gram_hashes("words", k).alias(f"g{k}") for k in sizes])
    # "outer" keeps the optimizer from testing the arrays for emptiness below, which would make them twice.
    rolled = grams.select("id", "tid", "n_words", F.explode_outer(F.concat(*placed)).alias("g")).select("id", "tid", "n_words", "g.*")
    # Rarity, counted per task first; beyond the broadcast every shingle of the texts is counted and the benchmark's are picked after.
    wanted = scratch.write(tokens.select("h").distinct(), "wanted")
    counted = rolled.join(F.broadcast(wanted), "h") if fits_broadcast(wanted) else rolled
    rarity = scratch.write(counted.groupBy("h").agg(F.count("*").alias("df")).join(wanted, "h", "left_semi"), "rarity")
    # The rarest shingle is the one prefix token of a window; none if a shingle occurs nowhere.
    first = (tokens.join(rarity, "h", "left").groupBy("wid", "body", "len", "k")
             .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "off", "h")).alias("p")).where("p.df > 0")
             .select("wid", "len", F.col("k").alias("fk"), F.col("p.off").alias("off"), F.col("p.h").alias("h")))
    first = scratch.write(first, "prefix")
    found = (rolled.join(F.broadcast(first) if fits_broadcast(first) else first, "h").where("k = fk")
             .withColumn("start", F.expr("pos - off")).where("start >= 0 and start + len <= n_words")
             .select("id", "tid", "start", "wid").distinct())
    candidates = scratch.write(found, "candidates")
    # Every word of a candidate is compared, in the pieces of the texts that hold one.
    listed = (candidates.join(bodies.select("wid", "len", "body"), "wid")
              .groupBy("id", "tid", F.expr(f"start div {PIECE}").alias("piece")).agg(F.collect_list(F.struct("start", "len", "body")).alias("at"))
              .select(F.col("id").alias("cid"), F.col("tid").alias("ctid"), "piece", "at"))
    held = maybe_in(keyed, "tid", candidates, "tid").select(
        "id", "tid", word_list(ascii_lower(F.col("text")), NOT_ALNUM).alias("words"))
    # No test of the arrays before the row filter: the optimizer would move it, and the split, below the filter. A wordless text is one empty piece.
    pieces = held.select("id", "tid", F.expr(
        f"inline_outer(transform(sequence(0, cast(greatest(size(words) - 1, 0) div {PIECE} as int)),"
        f" p -> struct(cast(p as bigint) as piece, slice(words, p * {PIECE} + 1, {PIECE + window}) as part)))"))
    same = f"c -> array_join(slice(part, cast(c.start - piece * {PIECE} + 1 as int), c.len), ' ') = c.body"
    met = (pieces.join(listed.withColumnRenamed("piece", "cpiece"), F.col("id").eqNullSafe(F.col("cid")) & (F.col("tid") == F.col("ctid"))
                       & (F.col("piece") == F.col("cpiece")))
           .select("id", "tid", F.expr(f"inline(filter(at, {same}))")).distinct())
    spans = scratch.write(met, "spans")
    return spans, windows.select("item", "body"), counts


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted ids as strings), ``contaminated``.

    Words are compared with A-Z lower-cased. A word is hit if it lies in an occurrence of a window.

    Defined cases: null and wordless texts, of documents or items, have no words and no
    windows; a null item id counts as the empty string; items with the same id are one
    item. Rows are told apart by id and text, so repeated rows get the same result each, also
    with null ids. Empty tables give no hits. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    spans, bodies, counts = contaminated_spans(docs, items, scratch, id_col, text_col, item_col, item_text, window, shingle)
    before = Window.partitionBy("id", "tid").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    hit = (spans.select("id", "tid", "start", (F.col("start") + F.col("len")).alias("stop")).distinct()
           .withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(0)))
           .groupBy("id", "tid").agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reached"))).alias("n_hit")))
    named = (spans.select("id", "tid", "body").distinct().join(bodies, "body")
             .groupBy("id", "tid").agg(F.array_sort(F.collect_set("item")).alias("items")))
    hit = scratch.write(hit.select(F.col("id").alias("hid"), F.col("tid").alias("htid"), "n_hit"), "hit")
    named = scratch.write(named.select(F.col("id").alias("nid"), F.col("tid").alias("ntid"), "items"), "named")
    out = (counts.join(hit, F.col("id").eqNullSafe(F.col("hid")) & (F.col("tid") == F.col("htid")), "left")
           .join(named, F.col("id").eqNullSafe(F.col("nid")) & (F.col("tid") == F.col("ntid")), "left"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_of = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return out.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                      items_of.alias("items"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item; all columns stay."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    spans, _, _ = contaminated_spans(docs, items, scratch, id_col, text_col, **options)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return without(docs, text_key(text), spans.select("tid"), "tid")
