"""A training-corpus pipeline over ``documents``: every stage is one operator of ``tessera.llm``.

Stages: drop toxic documents; keep one document of each group of near duplicates; cut passages
that an earlier document holds; drop documents with benchmark passages; mix the sources to
target weights. Each stage's rows are written as Parquet in the shared checkpoint
folder and read again by the next, so a lost executor never makes an earlier stage run twice.

The first four stages return the columns of ``documents``. The last returns one row per document:
doc_id, size, source_size, target, taken (words the mix takes of it, repeats counted).

Empty tables pass through all stages. Null texts are kept until the mix, where they weigh
nothing. Rows that share a doc_id are one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import queries
from tessera.llm.common import Scratch
from tessera.llm.decontaminate import drop_contaminated
from tessera.llm.mixing import mix_sources
from tessera.llm.near_dedup import drop_near_duplicates
from tessera.llm.substring_dedup import cut_repeats
from tessera.llm.toxicity import drop_toxic, fit_toxicity


def drop_toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, fit_toxicity(docs, labels, queries.fold_of(4) != 2))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=5, percent=80)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = cut_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mix_stage),
]

#: The learnt, hashed and iterative stages have no SQL; tests compare the rows with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**queries.QUERIES, "pipeline": run}
ORACLE = {**queries.ORACLE, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}
