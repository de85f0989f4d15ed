"""Adapter from the driver's star-schema tables to retail invoice lines.

lines = lineitem ⋈ orders ⋈ part ⋈ supplier ⋈ nation ⋈ region, with the lines of every
fiftieth order key present twice (exact copies).

Join plan: lineitem meets supplier and part first, each joined as a plain scan, whose size Catalyst
knows: they grow with the scale factor, so a broadcast is left to its size-checked choice
(``spark.sql.autoBroadcastJoinThreshold``). nation (25 rows) and region (5 rows) are fixed by the
schema and are broadcast explicitly. orders comes last, a large-large equi-join on the order key:
its shuffle deals out the lines by invoice, so that copies, which share their invoice, are removed
without another one, and lines of an invoice are written next to each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table

LINE_COLUMNS = (
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
)


#: Extra column of keyed lines: their order's key, which ``invoice_no`` holds as text, so equal lines have equal keys.
LINE_KEY = "line_key"


def source_lines(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Raw lines in the source layout (8 columns), copies included; with ``keyed`` also ``LINE_KEY``."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("country"))
    joined = (
        lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    returned = F.col("l_returnflag") == "R"
    lines = joined.select(
        F.when(returned, F.concat(F.lit("C"), F.col("l_orderkey").cast("string")))
        .otherwise(F.col("l_orderkey").cast("string"))
        .alias("invoice_no"),
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("PROMO"), F.col("l_partkey").cast("string")))
        .otherwise(F.format_string("%05d", F.col("l_partkey")))
        .alias("stock_code"),
        F.col("p_name").alias("description"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("bigint").alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(0.0))
        .otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
        .alias("unit_price"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.col("country"),
        F.col("l_orderkey"),
    )
    # Lines of every fiftieth order appear twice (exact copies). A local explode instead of a
    # union keeps one join tree: the star joins run once.
    times = F.when(F.col("l_orderkey") % 50 == 0, F.lit(2)).otherwise(F.lit(1))
    copies = lines.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")
    return copies.withColumnRenamed("l_orderkey", LINE_KEY) if keyed else copies.drop("l_orderkey")

