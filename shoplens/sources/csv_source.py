"""Typed scan of source invoice lines from CSV (header contract, missing-value tokens,
strict numbers, mixed timestamp formats).

The header is checked by Spark itself (``enforceSchema=false`` compares the file header with
the declared schema and fails the read on a mismatch), so no file is opened on the driver.
Numbers are read as text and cast under ANSI rules: a bad value fails the job instead of
turning into null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import na_to_null
from ..params import SOURCE_COLUMNS
from ..session import materialize
from .adapter import LINE_COLUMNS

# Timestamp layouts accepted for InvoiceDate, tried in order.
TIMESTAMP_FORMATS = (
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
)
_DAY, _ISO = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
#: Shape of the text of each layout: only a text of that shape is handed to its parser.
TIMESTAMP_SHAPES = (
    rf"{_DAY} [0-9]{{1,2}}:[0-9]{{2}}$",
    rf"{_DAY} [0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}$",
    rf"{_ISO} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$",
    rf"{_ISO}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$",
    rf"{_ISO} [0-9]{{2}}:[0-9]{{2}}$",
    rf"{_ISO}$",
)


def source_schema() -> StructType:
    return StructType([StructField(c, StringType(), True) for c in SOURCE_COLUMNS])


#: Where a line stands: its file, the first byte of its split, and a number that rises along the split.
POSITION = ("source_file", "source_block", "source_at")


def read_source_text(spark: SparkSession, path: str, multi_line: bool = False, positions: bool = False) -> DataFrame:
    """The 8 columns as text with snake_case names, missing-value tokens as null; with ``positions`` also ``POSITION``.

    Doubled quotes inside a quoted field are read as quotes. ``multi_line`` also reads quoted line breaks; a file is
    one task then (Spark cannot split it), so it is off unless asked for."""
    raw = (
        spark.read.schema(source_schema())
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return raw.select(*[na_to_null(F.col(s)).alias(d) for s, d in zip(SOURCE_COLUMNS, LINE_COLUMNS, strict=True)],
                      *([c.alias(n) for c, n in zip(place, POSITION, strict=True)] if positions else []))


def in_source_order(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The text lines with ``source_row_number``: 2, 3, ... along the files in path order, copies included (1 is a header).

    A line's number is the rows of all splits before its own plus its place in the split. Lines are written once with their
    positions, so a task that runs again cannot move them; one small aggregate counts the rows of each split, and their
    running sum is a window over one row per split, which is broadcast. No sort and no shuffle of the lines."""
    written = materialize(read_source_text(spark, path, multi_line, positions=True), "source-lines")
    splits = written.groupBy("source_file", "source_block").agg(F.count(F.lit(1)).alias("rows"), F.min("source_at").alias("first"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("source_file", "source_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = splits.select("source_file", "source_block", (before - F.col("first") + 2).alias("shift"))
    placed = written.join(F.broadcast(offsets), ["source_file", "source_block"])
    return placed.select(*LINE_COLUMNS, (F.col("source_at") + F.col("shift")).cast("bigint").alias("source_row_number"))


def parse_date(text: Column) -> Column:
    """The first layout that parses, as a timestamp without a zone (a local time in a clock change stays as written);
    text that no layout parses fails the job."""
    shaped = [
        F.when(text.rlike(shape), F.to_timestamp_ntz(text, F.lit(layout)))
        for layout, shape in zip(TIMESTAMP_FORMATS, TIMESTAMP_SHAPES, strict=True)
    ]
    unread = F.raise_error(F.concat(F.lit("unparseable InvoiceDate: "), text)).cast("timestamp_ntz")
    return F.when(text.isNotNull(), F.coalesce(*shaped, unread))


def typed(text: DataFrame) -> DataFrame:
    """Numbers and dates of text lines. Quantity: integer text, else error (a fractional value is an error too). Unit
    price: number or missing."""
    qty = F.col("quantity")
    return text.withColumns(
        {
            "quantity": F.when(qty.isNull(), F.raise_error(F.lit("missing Quantity"))).otherwise(qty.cast("bigint")),
            "invoice_date": parse_date(F.col("invoice_date")),
            "unit_price": F.col("unit_price").cast("double"),
        }
    )


def read_source_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Source lines in the 8-column layout with typed columns."""
    return typed(read_source_text(spark, path, multi_line))
