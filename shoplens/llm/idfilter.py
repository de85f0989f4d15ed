"""A bit table of ids: a first test of membership, sized by the ids and of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

BITS_PER_ID = 16
LEAST, MOST = 1 << 16, 1 << 28  # bits of a table: 8 KB to 32 MB, the bound of the broadcast
ROW = 256  # words of 64 bits in a row of the table


def _bit(value: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(value.cast("long")), F.lit(bits))


def maybe_in(df: DataFrame, column: str, ids: DataFrame, split: bool = False):
    """Rows whose id may be among ``ids`` (one column); with ``split`` also the rows whose id is surely not.

    The table has 16 bits for each id (about 6 % of the other rows pass), 32 MB at most: from 17 million ids on more rows
    pass, all of them in the end, so results must not depend on it and callers join exactly afterwards. It is dense, in rows of
    256 words, and broadcast. The caller's columns travel in one struct: no name of theirs can clash."""
    spark = df.sparkSession
    ids = materialize(ids.select(F.col(ids.columns[0]).cast("long").alias("id")), "asked-ids")
    count, bits = ids.count(), LEAST
    while bits < min(MOST, count * BITS_PER_ID):
        bits *= 2
    at = _bit(F.col("id"), bits)
    set_ = ids.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int")).alias("bits"))
    dense = set_.unionByName(spark.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")))
    words = dense.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = words.groupBy(F.floor(F.col("word") / ROW).alias("row")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))
    table = materialize(table, "bit-table")
    whole = free_name(df.columns, "whole")
    tested = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(whole), _bit(F.col(column), bits).alias("at")).withColumn(
        "row", F.floor(F.shiftright("at", 6) / ROW)).join(F.broadcast(table), "row")
    word = F.get("words", F.pmod(F.shiftright("at", 6), F.lit(ROW)).cast("int"))
    hit = F.call_function("shiftrightunsigned", word, F.col("at").bitwiseAND(63).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
    held = tested.where(F.coalesce(hit, F.lit(False))).select(f"{whole}.*")
    return (held, tested.where(~F.coalesce(hit, F.lit(False))).select(f"{whole}.*")) if split else held
