"""Sharding by a minimax contiguous partition over atomic groups (native functions only).

Rows with equal texts form one atomic group. Groups are ordered by the digest of their text, which spreads sizes evenly
along the order, so a shard is a contiguous range of digests and a row finds its shard by comparing its digest with
the ``n - 1`` cut digests: no join, and a group that holds a third of all rows needs no special care.

The smallest feasible capacity is found by bisection, many capacities at a time: a capacity is feasible when greedily
filled shards, each taking groups while it holds at most that many bytes, cover everything in ``n`` shards. The greedy
check needs, for a shard's start, the last group whose running size stays within reach; running sizes are built per
digest bucket (a fixed number of hex digits, so buckets stay even) plus bucket offsets, and each look-up is one
aggregate over the buckets that the candidate limits fall into.

Law: bytes. Null texts form a group of their own of size 1 per row and have checksum 0; they come first in the order.
Repeated rows each get a slot. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

HEX_DIGITS = 3  # 16**3 = 4096 buckets, the bound of what reaches the driver
CANDIDATES = 24  # capacities tried in one pass


def _key(text: Column) -> Column:
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def _bucket(key: Column) -> Column:
    return F.when(key == "", 0).otherwise(F.conv(F.substring(key, 1, HEX_DIGITS), 16, 10).cast("int"))


def running_sizes(rows: DataFrame) -> tuple[DataFrame, list[tuple[int, int, int]], int]:
    """Groups with their running size inside their bucket (``upto``), written once; bucket totals as
    (bucket, bytes before, bytes up to) on the driver (at most 4096); the largest group."""
    groups = rows.groupBy("bucket", "key").agg(F.sum("size").alias("bytes"))
    order = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    table = materialize(groups.withColumn("upto", F.sum("bytes").over(order)), "shard-groups")
    totals, before = [], 0
    for b, n, _ in sorted(map(tuple, table.groupBy("bucket").agg(F.sum("bytes").alias("n"), F.max("bytes").alias("m")).collect())):
        totals.append((b, before, before + n))
        before += n
    largest = table.agg(F.max("bytes")).first()[0] or 0
    return table, totals, largest


def _last_within(table: DataFrame, totals: list[tuple[int, int, int]], limits: list[int]) -> list[tuple[int, str]]:
    """For each limit, the running size and key of the last group whose running size is at most the limit
    ((0, '') when even the first group is beyond it). One aggregate over the buckets that hold the limits."""
    before = [t[1] for t in totals]
    asks = {}
    for limit in set(limits):
        at = max(bisect_right(before, limit) - 1, 0)
        asks[limit] = totals[at]
    buckets = sorted({t[0] for t in asks.values()})
    names = list(asks)
    aggs = [F.max(F.when((F.col("bucket") == asks[x][0]) & (F.col("upto") <= x - asks[x][1]), F.struct("upto", "key"))).alias(f"c{n}")
            for n, x in enumerate(names)]
    got = table.where(F.col("bucket").isin(buckets)).agg(*aggs).first()
    ends = {}
    for n, x in enumerate(names):
        found = got[f"c{n}"]
        ends[x] = (asks[x][1] + found["upto"], found["key"]) if found is not None else (asks[x][1], None)
    return [ends[x] for x in limits]


def smallest_capacity(table: DataFrame, totals: list[tuple[int, int, int]], largest: int, shards: int) -> int:
    """Bisection over capacities; every pass tries ``CANDIDATES`` of them through ``shards`` greedy look-ups."""
    total = totals[-1][2]
    low, high = max(-(-total // shards), largest), -(-total // shards) + largest
    while low < high:
        tried = sorted({low + (high - low) * i // CANDIDATES for i in range(CANDIDATES)})
        reach = [0] * len(tried)
        for _ in range(shards):
            reach = [r if r >= total else e[0] for r, e in
                     zip(reach, _last_within(table, totals, [min(r + c, total) for r, c in zip(reach, tried, strict=True)]), strict=True)]
        fits = [c for c, r in zip(tried, reach, strict=True) if r >= total]
        fails = [c for c, r in zip(tried, reach, strict=True) if r < total]
        high = min([high, *fits])
        low = max([low, *(c + 1 for c in fails)])
    return high


def cut_keys(table: DataFrame, totals: list[tuple[int, int, int]], capacity: int, shards: int) -> list[str]:
    """The last key of each shard but the last, greedily filled; shards left over stay empty at the end."""
    total, reach, cuts = totals[-1][2], 0, []
    while len(cuts) < shards - 1:
        end, key = _last_within(table, totals, [min(reach + capacity, total)])[0]
        if end >= total:
            break
        if key is None:  # the limit ends exactly with a bucket
            bucket = max(t[0] for t in totals if t[2] <= end and t[1] < t[2])
            key = table.where(F.col("bucket") == bucket).agg(F.max("key")).first()[0]
        cuts.append(key)
        reach = end
    return cuts


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless within a shard, by spread and id), grown_shard (null)."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), _key(text).alias("key"),
                       (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
                       F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    rows = materialize(rows.withColumn("bucket", _bucket(F.col("key"))), "shard-rows")  # 60 bytes a row, without the texts
    table, totals, largest = running_sizes(rows)
    cuts = cut_keys(table, totals, smallest_capacity(table, totals, largest, shards), shards) if totals else []
    shard = sum((F.when(F.col("key") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    # slots: rows are spread by a hash of the whole row key, numbered inside each part, parts of a shard stacked
    parts = 16 ** HEX_DIGITS
    dealt = rows.select("doc_id", "size", "text_crc32", "key", shard.cast("int").alias("shard"),
                        F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts)).cast("int").alias("part"))
    counts = dealt.groupBy("part", "shard").count()  # at most 4096 x shards rows
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "shard", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy("part", "shard").orderBy("doc_id", "key"))
    return dealt.withColumn("n", number).join(F.broadcast(starts), ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("n") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
