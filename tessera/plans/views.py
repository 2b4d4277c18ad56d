"""Base views the generic operators run on, derived from the driver's tables.

``order_features`` (key ``o_orderkey``): orders ⟕ per-order line totals ⋈
customer ⋈ nation. Join order is chosen for the shuffle it costs:

1. ``lineitem`` is aggregated per order (partial aggregation; the output is
   already hash-partitioned on the order key);
2. ``orders`` is left-joined to it on the order key (only ``orders`` moves);
3. the result is joined to ``customer`` on the customer key (sort-merge at
   scale; AQE splits a hot customer's partition);
4. ``nation`` is tiny (its file size is under the broadcast threshold, so
   Catalyst broadcasts it by measured size).

Orders without lines keep real nulls in the line columns (the test tables
have no other nulls). ``lines_flag`` is "R" when any line was returned, else
"N" — a count, so the per-order aggregate stays a hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import utc_year

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_totals(lineitem: DataFrame) -> DataFrame:
    """Per-order totals of ``lineitem``."""
    return (lineitem.groupBy("l_orderkey")
            .agg(F.sum("l_quantity").alias("lines_qty"),
                 F.sum("l_extendedprice").alias("lines_value"),
                 F.count(F.lit(1)).cast("long").alias("lines_cnt"),
                 F.when(F.count_if(F.col("l_returnflag") == "R") > 0, F.lit("R"))
                 .otherwise(F.lit("N")).alias("lines_flag"),
                 F.max("l_shipdate").alias("_last_ship"))
            .select("l_orderkey", "lines_qty", "lines_value", "lines_cnt", "lines_flag",
                    utc_year(F.col("_last_ship"), lineitem.schema["l_shipdate"].dataType)
                    .alias("last_ship_year")))


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = line_totals(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"))
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                      utc_year(F.col("o_orderdate"), orders.schema["o_orderdate"].dataType).alias("order_year"))
    j = (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
         .join(customer, F.col("o_custkey") == customer.c_custkey, "inner")
         .join(nation, F.col("c_nationkey") == nation.n_nationkey, "inner"))
    return j.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                    "order_year", "c_acctbal", "c_mktsegment", "n_name",
                    "lines_qty", "lines_value", "lines_cnt", "lines_flag", "last_ship_year")


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` ⟕ ``labels``: real nulls for unlabelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, on="doc_id", how="left")


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw text, the way a CSV export arrives: every column a string,
    with the null token ``NA`` written for every tenth customer key and a
    fractional total written into the integer column for every seventh order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("o_orderkey"),
        F.when(k % 10 == 0, F.lit("NA")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(k % 7 == 0, F.col("o_totalprice").cast("string"))
        .otherwise(F.col("o_custkey").cast("string")).alias("o_items"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.col("o_orderstatus").alias("o_orderstatus"),
    )
