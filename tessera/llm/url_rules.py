"""URL filter: host-suffix and path-prefix expressions against a rule table by hash prefix.

Each distinct (host, path) is expanded into every host suffix joined to the path prefixes of
the lengths that rules have. Expressions meet rules on the first 32 bits of their SHA-256;
full digests confirm, and the longest host, then the longest path, wins (a block before an
allow for the same expression).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, ascii_lower


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    tail = F.regexp_extract(text, r"^(?s:.*?)://((?s:.*))$", 1)
    host = F.regexp_extract(tail, r"^[^/?#]*", 0)
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Per row: id, host, path, ``rule`` (host and path of the winner, else null), ``verdict``.

    ``rules``: (action, host, path) with action ``allow`` or ``block``. A rule fits its host and all
    subdomains if the path starts with the rule's path. Without a rule the verdict is ``default``.

    Defined cases: null urls, and urls without ``://``, have empty host and path; an
    empty path starts with no rule path but the empty one. Rows are judged one by one, so
    repeated and null ids keep their rows. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "url")
    host, path = url_parts(F.col(f"`{url_col}`"))
    parsed = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    table = spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")
    table = (table.withColumn("rule", F.concat("rule_host", "rule_path")).withColumn("digest", F.sha2("rule", 256))
             .withColumn("short", F.substring("digest", 1, 8)))
    lengths = sorted({len(p) for _, _, p in rules})
    distinct = parsed.select("host", "path").distinct()
    suffixes = F.expr("transform(sequence(1, size(split(host, '[.]', -1))), i -> substring_index(host, '.', -i))")
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    expanded = (distinct.withColumn("suffix", F.explode(suffixes)).withColumn("n", F.explode(prefixes))
                .withColumn("digest", F.sha2(F.concat("suffix", F.expr("substring(path, 1, n)")), 256))
                .select("host", "path", "digest", F.substring("digest", 1, 8).alias("short")))
    met = expanded.join(table.withColumnRenamed("digest", "rule_digest"), "short").where("digest = rule_digest")
    best = met.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule_host").alias("h"), F.length("rule_path").alias("p"), (F.col("action") == "block").alias("b"),
        "action", "rule")).alias("best"))
    best = scratch.write(best.select("host", "path", "best.rule", "best.action"), "best")
    return parsed.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
