"""Evaluation of fitted labelings: exact silhouettes and pairwise ARI.

Silhouette (Euclidean, full population) is quadratic by definition. A task holds one row block and streams all points past
it as columns, so that no task ever holds more than a row block, its sums and one Arrow batch:

* every point belongs to one row block and travels once to every row block as a *column* (x, y, z and its labels, one byte
  each): there are ``BLOCKS`` row blocks, more only where small tables or many labelings ask for blocks of fewer rows, so
  the points are not copied more often as they become more;
* columns come ordered by their label vector: the distances of a slice are first added up over columns with the same vector
  (seeds mostly agree, so vectors are few), then over the clusters of every labeling, each as one product with a 0/1 matrix;
* when the columns are through, a row's sums are complete: its silhouettes are made in place, and only one sum per
  labeling leaves the task.

One path serves every size. Point pairs are never rows. Labelings that are equal as partitions
are evaluated once (``sweeps`` passes distinct ones).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .segments import adjusted_rand

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

ROW_BLOCK = 4_000  # rows of a block, unless there are more than BLOCKS of them
BLOCKS = 64
COL_CELLS = 4_000_000  # cells of a task's sums: rows of a block x clusters of all labelings
ROWS, COLUMNS = 32, 2_048  # distances of a slice: they stay in the processor's cache


class _Block:
    """A row block with the distance sums of its rows to each cluster."""

    def __init__(self, fits: Sequence[int], sizes: dict[int, list[int]]) -> None:
        self.fits = fits
        self.sizes = [np.array(sizes[f], np.float64) for f in fits]
        self.place = np.concatenate([[0], np.cumsum([len(s) for s in self.sizes])]).astype(np.int64)
        self.at, self.mine, self.sums = np.zeros((0, 3)), np.zeros((0, len(fits)), np.int64), None

    def add_rows(self, at: np.ndarray, labels: np.ndarray) -> None:
        self.at, self.mine = np.concatenate([self.at, at]), np.concatenate([self.mine, labels])

    def add_columns(self, to: np.ndarray, labels: np.ndarray) -> None:
        if self.sums is None:
            self.sums = np.zeros((len(self.at), self.place[-1]))
        part, square = np.empty((ROWS, COLUMNS)), np.empty((ROWS, COLUMNS))
        new = np.append(True, (labels[1:] != labels[:-1]).any(axis=1)) if len(to) else np.zeros(0, bool)
        to = np.ascontiguousarray(to.T).T
        for c in range(0, len(to), COLUMNS):
            cols, cells = to[c:c + COLUMNS], labels[c:c + COLUMNS] + self.place[:-1]
            new[c] = True
            starts = np.flatnonzero(new[c:c + COLUMNS])
            group = None
            if 2 * len(starts) <= len(cols):  # columns with equal labels stand together: they are added up first
                group = np.zeros((len(cols), len(starts)))
                group[np.arange(len(cols)), np.cumsum(new[c:c + COLUMNS]) - 1] = 1.0
                cells = cells[starts]
            held = np.zeros((len(cells), self.place[-1]))
            held[np.arange(len(cells))[:, None], cells] = 1.0
            for r in range(0, len(self.at), ROWS):
                rows = self.at[r:r + ROWS]
                d, e = part[:len(rows), :len(cols)], square[:len(rows), :len(cols)]
                np.subtract(rows[:, :1], cols[:, 0], out=d)
                np.multiply(d, d, out=d)
                for axis in (1, 2):
                    np.subtract(rows[:, axis:axis + 1], cols[:, axis], out=e)
                    np.multiply(e, e, out=e)
                    np.add(d, e, out=d)
                np.sqrt(d, out=d)
                self.sums[r:r + ROWS] += (d if group is None else d @ group) @ held

    def totals(self) -> list[float]:
        """Sum of the rows' silhouettes, for each labeling."""
        if self.sums is None or not len(self.at):
            return [0.0] * len(self.fits)
        out, row = [], np.arange(len(self.at))
        for n, size in enumerate(self.sizes):
            sums, label = self.sums[:, self.place[n]:self.place[n + 1]], self.mine[:, n]
            own = size[label]
            inner = sums[row, label] / np.maximum(own - 1, 1)
            mean = np.where(size > 0, sums / np.maximum(size, 1), np.inf)
            mean[row, label] = np.inf
            outer = mean.min(axis=1)
            far = np.maximum(inner, outer)
            good = (own > 1) & np.isfinite(outer) & (far > 0)
            out.append(float(((outer[good] - inner[good]) / far[good]).sum()))
        return out


def silhouettes(labelled: DataFrame, sizes: dict[int, list[int]], fit_order: dict[str, list[int]]) -> DataFrame:
    """Mean silhouette per fit: (fit, silhouette).

    ``labelled``: (space, customer_id, x, y, z, labels) with ``labels`` an array aligned with ``fit_order[space]``.
    ``sizes``: cluster sizes per fit (bounded by fits × k). A point alone in its cluster counts 0.
    """
    spark = labelled.sparkSession
    counts = {r["space"]: r["n"] for r in labelled.groupBy("space").agg(F.count(F.lit(1)).alias("n")).collect()}
    spaces = [sp for sp in fit_order if counts.get(sp)]
    order = {sp: list(fit_order[sp]) for sp in spaces}
    blocks: dict[str, tuple[int, int]] = {}  # space -> its first block, its number of blocks
    total = 0
    for sp in spaces:
        cells = max(1, COL_CELLS // max(1, sum(len(sizes[f]) for f in order[sp])))
        rows = min(max(ROW_BLOCK, -(-counts[sp] // BLOCKS)), cells)
        blocks[sp] = (total, max(1, -(-counts[sp] // rows)))
        total += blocks[sp][1]
    plan = spark.createDataFrame([(n, sp, *blocks[sp]) for n, sp in enumerate(spaces)], "nr int, space string, first int, blocks int")
    base = labelled.join(F.broadcast(plan), "space").select("customer_id", "nr", "first", "blocks", "x", "y", "z", F.col("labels").cast("array<tinyint>").alias("labels"))
    row = F.pmod(F.xxhash64("customer_id"), "blocks").cast("int")
    as_row = base.select((F.col("first") + row).alias("block"), "nr", F.lit(0).alias("side"), "x", "y", "z", "labels")
    to = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1))
    as_col = base.select(to.alias("block"), "nr", F.lit(1).alias("side"), "x", "y", "z", "labels")
    fits = [order[sp] for sp in spaces]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            nr, side = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("nr", "side"))
            at = np.stack([batch.column(a).to_numpy(zero_copy_only=False).astype(np.float64) for a in "xyz"], axis=1)
            if block is None:  # a task has one block, its rows first
                block = _Block(fits[nr[0]], sizes)
            labels = batch.column("labels").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(at), -1)
            rows = side == 0
            if rows.any():
                block.add_rows(at[rows], labels[rows])
            if not rows.all():
                block.add_columns(at[~rows], labels[~rows])
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array(block.fits, pa.int64()), pa.array(block.totals(), pa.float64())], names=["fit", "s"])

    dealt = as_row.unionByName(as_col).repartitionById(max(1, total), "block").sortWithinPartitions("side", F.xxhash64("labels"))
    sums = dealt.mapInArrow(run, "fit long, s double").groupBy("fit").agg(F.sum("s").alias("s"))
    points = spark.createDataFrame([(f, counts[sp]) for sp in spaces for f in order[sp]], "fit long, n long")
    return sums.join(F.broadcast(points), "fit").select("fit", (F.col("s") / F.col("n")).alias("silhouette"))


def pairwise_ari(labelled: DataFrame, groups: dict[str, list[tuple[str, list[int], list[int]]]]) -> DataFrame:
    """ARI for every unordered pair of labelings inside each group: (grp, fa, fb, ari).

    ``groups[space]`` lists (group name, positions in the labels array, fit ids). Customers with
    the same label vector are counted first, so the literal pair list (bounded by seeds²) is
    expanded next to the distinct vectors only; stable seeds leave few of them. The contingency
    counts are partial aggregates of (pair × k × k) rows, written once for their three readers."""
    entries = []
    for space, gl in groups.items():
        for gname, positions, fits in gl:
            for i in range(len(positions)):
                for j in range(i + 1, len(positions)):
                    entries.append((space, gname, positions[i], positions[j], fits[i], fits[j]))
    spark = labelled.sparkSession
    pairs = spark.createDataFrame(entries, "space string, grp string, pa int, pb int, fa long, fb long")
    by_space = pairs.groupBy("space").agg(F.collect_list(F.struct("grp", "pa", "pb", "fa", "fb")).alias("pl"))
    vectors = labelled.groupBy("space", "labels").agg(F.count(F.lit(1)).alias("customers"))
    cells = (
        vectors.join(F.broadcast(by_space), "space")
        .select("labels", "customers", F.inline("pl"))
        .select("grp", "fa", "fb", F.element_at("labels", F.col("pa") + 1).alias("la"), F.element_at("labels", F.col("pb") + 1).alias("lb"), "customers")
        .groupBy("grp", "fa", "fb", "la", "lb")
        .agg(F.sum("customers").alias("n"))
    )
    return ari_from_cells(materialize(cells, "ari-cells"), ["grp", "fa", "fb"])


def ari_from_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ARI per key from contingency cells (keys..., la, lb, n)."""
    c2 = lambda c: c * (c - 1) / 2.0
    s_ij = cells.groupBy(*keys).agg(F.sum(c2(F.col("n"))).alias("s_ij"), F.sum("n").alias("n_all"))
    s_a = cells.groupBy(*keys, "la").agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.sum(c2(F.col("n"))).alias("s_a"))
    s_b = cells.groupBy(*keys, "lb").agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.sum(c2(F.col("n"))).alias("s_b"))
    j = s_ij.join(s_a, list(keys)).join(s_b, list(keys))
    pairs = F.col("n_all") * (F.col("n_all") - 1) / 2.0
    expected = F.when(pairs > 0, F.col("s_a") * F.col("s_b") / pairs).otherwise(F.lit(0.0))
    denom = (F.col("s_a") + F.col("s_b")) / 2.0 - expected
    return j.select(*keys, F.when(denom == 0, F.lit(1.0)).otherwise((F.col("s_ij") - expected) / denom).alias("ari"))


__all__ = ["silhouettes", "pairwise_ari", "ari_from_cells", "adjusted_rand"]
