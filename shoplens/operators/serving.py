"""Serving queries: invoice timelines, customer filters, lookups, options, points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def invoice_timeline(lines: DataFrame) -> DataFrame:
    """Per (customer, invoice): first line time, Σ amount, line count, any cancellation flag,
    any valid purchase line. A filter on the customer pushes below this aggregate."""
    return lines.groupBy("customer_id", "invoice_no").agg(
        F.min("invoice_date").alias("invoice_date"),
        F.sum("line_amount").alias("invoice_amount"),
        F.count(F.lit(1)).alias("line_count"),
        F.max("is_cancellation").alias("is_cancellation"),
        F.max("is_valid_positive_purchase").alias("has_valid_positive_line"),
    )


def customer_timeline(lines: DataFrame, customer_id: str) -> DataFrame:
    """One customer's invoices ordered by time then number (distributed sort, no single task)."""
    return invoice_timeline(lines.where(F.col("customer_id") == customer_id)).orderBy("invoice_date", "invoice_no")


def filtered_customers(
    segmented: DataFrame,
    countries_table: DataFrame,
    segments: Sequence[str] = (),
    countries: Sequence[str] = (),
    cap_status: str = "all",
) -> DataFrame:
    """Composed filter: empty list = no filter. Countries match *any* country the customer
    bought in (left-semi join on the customer-country table), cap status all/capped/uncapped."""
    out = segmented
    if segments:
        out = out.where(F.col("segment_code").isin(list(segments)))
    if countries:
        eligible = countries_table.where(F.col("country").isin(list(countries))).select("customer_id")
        out = out.join(eligible, "customer_id", "left_semi")
    if cap_status == "capped":
        out = out.where(F.col("any_capped_flag"))
    elif cap_status == "uncapped":
        out = out.where(~F.col("any_capped_flag"))
    return out


def country_index(countries_table: DataFrame, home_country: str) -> DataFrame:
    """Per country the number of customers; option order: home country first, then A–Z.

    The per-country aggregate is a partial count-distinct; only the small result (one row
    per country) is ordered."""
    per = countries_table.where(F.col("country").isNotNull()).groupBy("country").agg(
        F.count_distinct("customer_id").alias("customers")
    )
    return per.withColumn(
        "option_order",
        F.row_number().over(Window.orderBy((F.col("country") != F.lit(home_country)).cast("int"), "country")),
    )


def comparison(value: F.Column, median: F.Column) -> tuple[F.Column, F.Column, F.Column]:
    """Bar widths of a customer value against the segment median (percent of a shared top)."""
    top = F.lit(1.18) * F.greatest(F.abs(value), F.abs(median), F.lit(1.0))
    return (
        top,
        F.least(F.lit(100.0), F.lit(100.0) * F.abs(value) / top),
        F.least(F.lit(100.0), F.lit(100.0) * F.abs(median) / top),
    )
