"""Customer-level aggregates: RFM, countries per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import country_display
from ..params import Params


def build_rfm(lines: DataFrame, params: Params) -> DataFrame:
    """One row per customer with at least one valid purchase.

    A single ``groupBy(customer_id)`` with conditional aggregates replaces the
    positive-lines/net/countries three-way join: recency, frequency and gross come from
    valid lines only, net from every known line, countries from every line. The one
    distinct count is planned by Spark as a (customer, invoice) aggregate first, so a
    customer owning a large share of all lines is spread over many tasks before the
    per-customer merge. Money stays decimal, so totals do not depend on order.
    """
    valid = F.col("is_valid_positive_purchase")
    agg = lines.groupBy("customer_id").agg(
        F.max(F.when(valid, F.to_date("invoice_date"))).alias("last_purchase"),
        F.count_distinct(F.when(valid, F.col("invoice_no"))).alias("frequency"),
        F.sum(F.when(valid, F.col("line_amount"))).alias("gross_monetary"),
        F.sum("line_amount").alias("net_monetary"),
        country_display(F.col("country")).alias("country_display"),
        F.max(valid).alias("_has_valid"),
    )
    return agg.where("_has_valid").select(
        "customer_id",
        "country_display",
        "last_purchase",
        F.datediff(F.lit(params.reference_date).cast("date"), F.col("last_purchase")).cast("bigint").alias("recency"),
        F.col("frequency").cast("bigint").alias("frequency"),
        "gross_monetary",
        "net_monetary",
    )


def customer_countries(lines: DataFrame, rfm: DataFrame | None = None) -> DataFrame:
    """Lines, distinct invoices and net per (customer, country) of clustered customers (those
    with at least one valid purchase). A null country stays a group.

    The restriction is applied after the aggregate, not by joining the lines: the
    (customer, country) rows carry ``max(valid)``, and a window over a customer's few rows
    (one per country) keeps customers with any valid line. No line-level join exists, so a
    customer owning a third of all lines never lands whole in one join task.
    """
    per = lines.groupBy("customer_id", "country").agg(
        F.count(F.lit(1)).alias("transaction_lines"),
        F.count_distinct("invoice_no").alias("distinct_invoices"),
        F.sum("line_amount").alias("net_monetary"),
        F.max("is_valid_positive_purchase").alias("_valid"),
    )
    clustered = per.withColumn("_clustered", F.max("_valid").over(Window.partitionBy("customer_id")))
    return clustered.where("_clustered").drop("_valid", "_clustered")
