"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Column names and output types are fixed here and mirrored by ``plans.oracles``: dates and
timestamps leave as ISO text, money as a double rounded to 4 places, other doubles rounded
to 6 places, counts as BIGINT.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.output import day_text, dbl, money_out, quantile_out, timestamp_text
from ..operators import lines as L
from ..params import DEFAULT, SOURCE_COLUMNS, Params
from ..session import ensure_checkpoint_dir
from ..sources.adapter import LINE_COLUMNS, source_lines
from .build import Build

Query = Callable[[SparkSession, str], DataFrame]


def _b(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> Build:
    return Build.of(spark, sf_dir, params)


def _line_cols_out() -> list:
    return [F.col(c) if c != "invoice_date" else timestamp_text(F.col(c)).alias(c) for c in LINE_COLUMNS]


# ---------------------------------------------------------------- source and lines
def source_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source facts in one aggregate over the copy groups."""
    dedup = _b(spark, sf_dir).dedup
    return dedup.agg(
        F.sum("copies").cast("bigint").alias("raw_rows"),
        F.lit(len(LINE_COLUMNS)).cast("bigint").alias("fields"),
        F.count_distinct("invoice_no").cast("bigint").alias("unique_invoices"),
        day_text(F.min("invoice_date")).alias("date_start"),
        day_text(F.max("invoice_date")).alias("date_end"),
        F.coalesce(F.sum(F.when(F.col("customer_id").isNull(), F.col("copies"))), F.lit(0))
        .cast("bigint")
        .alias("missing_customer_rows"),
        dbl(F.sum(F.when(F.col("customer_id").isNull(), F.col("copies"))) / F.sum("copies")).alias(
            "missing_customer_share"
        ),
        F.sum(F.col("copies") - 1).cast("bigint").alias("duplicate_extra_rows"),
        F.count(F.lit(1)).cast("bigint").alias("deduplicated_rows"),
    )


def duplicate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 8-column line that occurs more than once, with its copy count."""
    dedup = _b(spark, sf_dir).dedup
    return dedup.where(F.col("copies") > 1).select(
        *_line_cols_out(),
        F.col("copies").cast("bigint").alias("copies"),
        (F.col("copies") - 1).cast("bigint").alias("extra_copies"),
    )


def lines_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated lines with the source row number of the first copy."""
    numbered = _b(spark, sf_dir).numbered
    return numbered.select(
        "source_row_number",
        *_line_cols_out(),
        F.col("copies").cast("bigint").alias("copies"),
    )


def lines_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known, normalised lines with line id and the five flags."""
    return _flagged(_b(spark, sf_dir))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from CSV files: the source lines are written as a folder of packed files in the order of their columns, and read
    again by position, header contract, missing-value tokens and strict types (A1-A4, B2, B3, F1, F2)."""
    raw = source_lines(spark, sf_dir)
    order = [F.col(c).asc_nulls_first() for c in LINE_COLUMNS]
    shown = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if c == "invoice_date" else F.col(c) for c in LINE_COLUMNS]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shoplens-csv-{uuid.uuid4().hex[:12]}"
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    raw.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        *[c.alias(n) for c, n in zip(shown, SOURCE_COLUMNS, strict=True)]).write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
    return _flagged(Build.from_csv(spark, path))


def _flagged(build: Build) -> DataFrame:
    flagged = L.known_lines(build.numbered.drop("copies"))
    return flagged.select(
        "line_id",
        "source_row_number",
        *_line_cols_out(),
        money_out(F.col("line_amount")).alias("line_amount"),
        *L.FLAG_COLUMNS,
    )


def customer_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, invoices and net per (customer, country) of clustered customers."""
    c = _b(spark, sf_dir).countries
    return c.select(
        "customer_id",
        "country",
        F.col("transaction_lines").cast("bigint").alias("transaction_lines"),
        F.col("distinct_invoices").cast("bigint").alias("distinct_invoices"),
        money_out(F.col("net_monetary")).alias("net_monetary"),
    )


# ---------------------------------------------------------------- RFM
def rfm_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: one RFM row per customer with a valid purchase."""
    rfm = _b(spark, sf_dir).rfm
    return rfm.select(
        "customer_id",
        "country_display",
        day_text(F.col("last_purchase")).alias("last_purchase_date"),
        "recency",
        "frequency",
        money_out(F.col("gross_monetary")).alias("gross_monetary"),
        money_out(F.col("net_monetary")).alias("net_monetary"),
    )


# ---------------------------------------------------------------- model
def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with capped and scaled features, raw cluster, segment, distance, flags."""
    seg = _b(spark, sf_dir).segmented
    return seg.select(
        "customer_id",
        "country_display",
        day_text(F.col("last_purchase")).alias("last_purchase_date"),
        "recency",
        "frequency",
        money_out(F.col("gross_monetary")).alias("gross_monetary"),
        money_out(F.col("net_monetary")).alias("net_monetary"),
        quantile_out(F.col("frequency_capped")).alias("frequency_capped"),
        quantile_out(F.col("net_monetary_capped")).alias("net_monetary_capped"),
        "scaled_recency",
        "scaled_frequency",
        "scaled_net_monetary",
        F.col("raw_cluster").cast("bigint").alias("raw_cluster"),
        "segment_code",
        "centroid_distance",
        "frequency_capped_flag",
        "monetary_capped_flag",
        "any_capped_flag",
        "is_representative",
    )


def registry() -> dict[str, Query]:
    from . import catalog_eval, catalog_model

    return {
        "rfm_profile": rfm_profile,
        "source_facts": source_facts,
        "duplicate_audit": duplicate_audit,
        "lines_deduplicated": lines_deduplicated,
        "lines_flagged": lines_flagged,
        "csv_lines": csv_lines,
        "customer_countries": customer_countries,
        "customer_segments": customer_segments,
        **catalog_model.registry(),
        **catalog_eval.registry(),
    }
