"""Line-level operators: exact-copy removal, normalisation, flags, known lines, row numbers.

Order of operations follows the source semantics: copies are detected on the eight
*un-normalised* columns, then text is trimmed and amounts are derived.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.numeric import money
from ..functions.text import is_cancellation, is_product_like, py_strip
from ..session import materialize
from ..sources.adapter import LINE_COLUMNS, LINE_KEY

FLAG_COLUMNS = (
    "is_cancellation",
    "is_valid_positive_purchase",
    "is_nonpositive_quantity",
    "is_nonpositive_price",
    "is_product_like",
)


def _order_keys(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def deduplicate(raw: DataFrame) -> DataFrame:
    """One row per distinct 8-column line, with the number of copies it had. Where lines carry their place in the source
    (``source_row_number``), the first copy is the one that is kept: its number stays.

    A hash aggregate with map-side partial aggregation: a group of copies holding a large
    share of all rows is reduced in every map task before the shuffle, so no single
    task receives the hot group whole. Keyed lines (``LINE_KEY``, the same for equal lines)
    have the key as a grouping column: dealt out by it already, they are not shuffled again.
    """
    first = [F.min("source_row_number").alias("source_row_number")] if "source_row_number" in raw.columns else []
    key = [LINE_KEY] if LINE_KEY in raw.columns else []
    return raw.groupBy(*key, *LINE_COLUMNS).agg(F.count(F.lit(1)).alias("copies"), *first).drop(*key)


def duplicate_extra_rows(raw: DataFrame) -> DataFrame:
    """Σ (copies − 1) over the 8-column groups, with raw and deduplicated counts."""
    return deduplicate(raw).agg(
        F.sum("copies").cast("bigint").alias("raw_rows"),
        F.count(F.lit(1)).cast("bigint").alias("deduplicated_rows"),
        F.sum(F.col("copies") - 1).cast("bigint").alias("duplicate_extra_rows"),
    )


#: Rows that a rank partition is meant to hold; the partition count follows the data.
ROWS_A_PARTITION = 500_000


def running_ranks(
    df: DataFrame,
    order_cols: Sequence[str],
    weights: dict[str, Column],
    start: dict[str, int],
    num_partitions: int | None = None,
) -> DataFrame:
    """Contiguous ranks in a global order without a single-task window.

    For each name in ``weights`` the row gets ``start + Σ weight of all rows before it``.
    Plan: range-partition on the order (sampled bounds, as many partitions as the rows ask
    for) and sort inside each partition; one Arrow pass per partition appends the running
    sums and leaves every other column as it is; per-partition totals (one row per
    partition) give the offsets. Rows that tie on every order column are interchangeable. The
    ranked partitions are written as Parquet: a lost executor cannot renumber rows, and
    readers prune columns.
    """
    spark = df.sparkSession
    names = list(weights)
    weighted = df.withColumns({f"_w_{k}": w.cast("long") for k, w in weights.items()})
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_PARTITION))
    tagged = (
        weighted.repartitionByRange(n, *_order_keys(order_cols))
        .sortWithinPartitions(*_order_keys(order_cols))
        .withColumn("_pid", F.spark_partition_id())
    )
    out_schema = StructType(list(tagged.schema.fields) + [StructField(f"_b_{k}", LongType(), False) for k in names])

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = dict.fromkeys(names, 0)
        for batch in batches:
            before = []
            for k in names:
                w = batch.column(f"_w_{k}").to_numpy(zero_copy_only=False).astype("int64")
                before.append(pa.array(w.cumsum() - w + carried[k], pa.int64()))
                carried[k] += int(w.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, *before], names=[*batch.schema.names, *(f"_b_{k}" for k in names)])

    # Range bounds are sampled from input whose row order is not fixed, so the ranked
    # partitions are written once and totals read from that copy.
    local = materialize(tagged.mapInArrow(prefix, out_schema), "ranks")
    totals = local.groupBy("_pid").agg(*[F.sum(f"_w_{k}").alias(f"_t_{k}") for k in names])
    whole = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{k}").over(whole), F.lit(0)).alias(f"_o_{k}") for k in names])
    ranked = local.join(F.broadcast(offsets), "_pid")  # one row per partition
    return ranked.select(
        *df.columns,
        *[(F.lit(start[k]) + F.col(f"_o_{k}") + F.col(f"_b_{k}")).cast("bigint").alias(k) for k in names],
    )


def normalise(lines: DataFrame) -> DataFrame:
    """Trim ids/codes/country like ``str.strip``, upper-case the stock code, add the line amount."""
    return lines.withColumns(
        {
            "invoice_no": py_strip(F.col("invoice_no")),
            "stock_code": F.upper(py_strip(F.col("stock_code"))),
            "customer_id": py_strip(F.col("customer_id")),
            "country": py_strip(F.col("country")),
            "line_amount": money(F.col("quantity") * F.col("unit_price")),
        }
    )


NORMALISED = ("invoice_no", "stock_code", "customer_id", "country")


def with_normalised(dedup: DataFrame) -> DataFrame:
    """Deduplicated lines plus their normalised text (``n_*``) and line amount, stored side by
    side so that readers filter on stored columns (pushdown) and ranks use the raw ones."""
    return dedup.withColumns(
        {
            "n_invoice_no": py_strip(F.col("invoice_no")),
            "n_stock_code": F.upper(py_strip(F.col("stock_code"))),
            "n_customer_id": py_strip(F.col("customer_id")),
            "n_country": py_strip(F.col("country")),
            "line_amount": money(F.col("quantity") * F.col("unit_price")),
        }
    )


def normalised_view(stored: DataFrame) -> DataFrame:
    """The normalised lines (plus ``copies``) of a ``with_normalised`` table."""
    cols = [F.col(f"n_{c}").alias(c) if c in NORMALISED else F.col(c) for c in LINE_COLUMNS]
    return stored.select(*cols, "line_amount", "copies")


def known(lines: DataFrame) -> Column:
    return F.col("customer_id").isNotNull() & (F.col("customer_id") != "")


def add_flags(lines: DataFrame) -> DataFrame:
    cancel = is_cancellation(F.col("invoice_no"))
    nonpos_q = F.coalesce(F.col("quantity") <= 0, F.lit(False))
    nonpos_p = F.coalesce(F.col("unit_price") <= 0, F.lit(False))
    return lines.withColumns(
        {
            "is_cancellation": cancel,
            "is_nonpositive_quantity": nonpos_q,
            "is_nonpositive_price": nonpos_p,
            "is_valid_positive_purchase": ~cancel & ~nonpos_q & ~nonpos_p,
            "is_product_like": is_product_like(F.col("stock_code")),
        }
    )


def known_lines(lines: DataFrame, normalised: bool = False) -> DataFrame:
    """Normalised, flagged lines of known customers (after trim: not null, not empty)."""
    norm = lines if normalised else normalise(lines)
    return add_flags(norm.where(known(norm)))


def clean_lines(raw: DataFrame) -> DataFrame:
    """Known lines of the deduplicated source: the input of the RFM build."""
    return known_lines(deduplicate(raw).drop("copies"))




def number_deduplicated(dedup: DataFrame) -> DataFrame:
    """``source_row_number`` of the first copy and ``line_id`` (1, 2, ... over known lines), both in source order. Lines of a
    file bring their row numbers; a source without an order (joined tables) is numbered in the order of its eight columns."""
    cid = py_strip(F.col("customer_id"))
    is_known = (cid.isNotNull() & (cid != "")).cast("int")
    if "source_row_number" in dedup.columns:
        return running_ranks(dedup, ["source_row_number"], {"line_id": is_known}, {"line_id": 1})
    return running_ranks(
        dedup,
        LINE_COLUMNS,
        {"source_row_number": F.col("copies"), "line_id": is_known},
        {"source_row_number": 2, "line_id": 1},
    )
