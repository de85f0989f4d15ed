"""Small column helpers and the distributed connected components shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import materialize, read_table

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Separators of alphanumeric words: every ASCII character but 0-9 and a-z (the text is lower-cased first).
WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SLICE_BYTES = 4 << 20  # text that a task holds as Python objects at a time (or a single longer text)

__all__ = ["ascii_lower", "connected_components", "free_name", "inline_table", "materialize", "pair_words", "read_table", "row_id", "sliced", "text_of",
           "word_array"]


def free_name(columns: Sequence[str], stem: str) -> str:
    """A column name like ``stem`` that none of ``columns`` has (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def sliced(batch: pa.RecordBatch, column: int | str, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Views of a batch in row order whose texts in ``column`` hold about ``limit`` bytes each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin, limit = 0, limit or SLICE_BYTES
    while begin < batch.num_rows:
        held = size[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(size, held + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the fast built-in, which is the same there."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower()))


def word_array(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z-lowered text, in order."""
    return F.array_remove(F.split(ascii_lower(text), WORD_SEPARATORS), "")


def pair_words(words: str, k: int) -> Column:
    """Rolling hashes of ``k`` consecutive words, one for each start; starts too near the end hash fewer words."""
    return F.expr(f"transform({words}, (w, i) -> xxhash64(w" + "".join(f", get({words}, i + {j})" for j in range(1, k)) + "))")


def row_id() -> Column:
    """A number for each input row: rows that repeat stay apart. Used only inside one lineage over stored tables,
    where a task that runs again reads the same file split and gives the same numbers."""
    return F.monotonically_increasing_id()


def inline_table(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """A small literal table (fixed values of an operator), planned as a local projection."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of each node that has an edge: columns ``node``, ``component``.

    Rounds of large-star and small-star (every node is hooked to the least node it knows of); each round is two
    aggregations over the edges, written to the shared checkpoint folder, and the edge set only shrinks. The driver
    sees one count and one checksum a round. A star of any size converges in a round; a hub's minimum is gathered with
    map-side combine, and joined back to its edges by a shuffle that AQE splits where the hub's part is large enough.
    """
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    cur = materialize(cur, "edges")
    before = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large-star: each larger neighbour of u is hooked to the least node around u
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: u and its smaller neighbours are hooked to the least of them
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(floor, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        cur = materialize(hooked.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == before:
            return cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
