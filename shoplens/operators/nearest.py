"""Nearest centres of many fits at once, on Arrow batches: the inner step of a Lloyd round.

A batch of points meets the centres of its space's fits as one distance matrix (points x centres) per slice. The squared
distances are those of the SQL text, rounded to ``DISTANCE_DIGITS`` before they are compared, ties to the lower label: where no
second centre is within half a rounding step the plain minimum decides, the few others are rounded one by one.

Sums are exact. A coordinate counts as its DECIMAL(18,10), a whole number of 1e-10 units, held in two halves whose sums over a
slice are whole numbers below 2^53: one matrix product of the 0/1 membership with the halves gives them without rounding.
A null coordinate makes every distance null: the point then belongs to label 0, and adds nothing to that coordinate's sum.

Rows that follow each other are taken as a box (``near_together`` lays them out so that boxes are small). Where one centre is
nearer than every other by more than the rounding of distances all over the box, all its points have that label, and the box
counts with its sums; only the boxes that a border of clusters may cross are looked at point by point. This is no estimate: which
rows form a box changes the time and no result.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import DISTANCE_DIGITS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

Centre = tuple[float, float, float]
UNITS = 10**10  # of a coordinate's DECIMAL(18,10)
HALF = 1 << 26
BOX = 64  # rows of a box
HELD = 65_536  # rows that a task holds at once
ROWS_OUT = 4_096  # rows whose labels in all fits are held at once
CELLS = 16_384  # labels of a slice: its work arrays stay in the processor's cache
STEP = Decimal(1).scaleb(-DISTANCE_DIGITS)
WIDE = Context(prec=400, rounding=ROUND_HALF_UP)
PARTS = ("n", *(f"{half}{a}" for half in ("hi_", "lo_", "in_") for a in "xyz"), "changed")


def _rounded(value: float) -> Decimal:
    return Decimal(repr(value)).quantize(STEP, context=WIDE)


def whole_units(values: np.ndarray) -> np.ndarray:
    """DECIMAL(18,10) of doubles, in units of 1e-10. Values that a product of doubles could misplace go through their text."""
    scaled = values * float(UNITS)
    with np.errstate(invalid="ignore"):
        out = np.rint(scaled)
        odd = np.flatnonzero((np.abs(scaled) >= 2.0**50) | (np.abs(np.abs(scaled - out) - 0.5) < 0.01 + np.abs(scaled) * 2.5e-16))
        units = out.astype(np.int64)
    for n in odd.tolist():
        exact = int(Decimal(repr(float(values[n]))).scaleb(10).to_integral_value(context=WIDE))
        if abs(exact) >= 10**18:
            raise ArithmeticError(f"coordinate {values[n]} does not fit DECIMAL(18,10)")
        units[n] = exact
    return units


def rounded(values: np.ndarray) -> np.ndarray:
    """Doubles >= 0 rounded half up to ``DISTANCE_DIGITS`` places of their text, as SQL does it."""
    scaled = values * float(UNITS)
    whole = np.rint(scaled)
    out = whole / UNITS
    with np.errstate(invalid="ignore"):
        odd = np.nonzero(np.isfinite(scaled) & ((scaled >= 2.0**50) | (np.abs(np.abs(scaled - whole) - 0.5) < 1e-6 + scaled * 2.5e-16)))
    if len(odd[0]):
        out[odd] = [float(_rounded(float(v))) for v in values[odd]]
    return out


class Centres:
    """The centres of one space's fits, side by side; fits with fewer centres than the widest are filled up with far ones."""

    def __init__(self, fits: Sequence[Sequence[Centre]]) -> None:
        self.fits, self.width = len(fits), max(map(len, fits))
        flat = np.full((self.fits, self.width, 3), np.inf)
        for n, centres in enumerate(fits):
            flat[n, :len(centres)] = centres
        self.flat = flat.reshape(-1, 3)
        self.sides = np.ascontiguousarray(flat.transpose(1, 2, 0))  # (place, axis, fit)

    def squared(self, points: np.ndarray) -> np.ndarray:
        """Squared distances (points x fits x centres). ``points`` holds no NaN."""
        part = points[:, :1] - self.flat[:, 0]
        d2 = np.multiply(part, part, out=part)
        for axis in (1, 2):
            part = points[:, axis:axis + 1] - self.flat[:, axis]
            np.multiply(part, part, out=part)
            d2 += part
        return d2.reshape(len(points), self.fits, self.width)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the least squared distance (the first of equal ones), that distance and the next one, for each point and fit."""
        shape = len(points), self.fits
        label, second = np.zeros(shape, np.int16 if self.width < 1 << 15 else np.int64), np.full(shape, np.inf)
        least, d2, part, less = np.empty(shape), np.empty(shape), np.empty(shape), np.empty(shape, bool)
        for j in range(self.width):
            out = d2 if j else least
            np.subtract(points[:, :1], self.sides[j, 0], out=out)
            np.multiply(out, out, out=out)
            for axis in (1, 2):
                np.subtract(points[:, axis:axis + 1], self.sides[j, axis], out=part)
                np.multiply(part, part, out=part)
                np.add(out, part, out=out)
            if j:
                np.less(d2, least, out=less)
                np.copyto(label, j, where=less)
                np.maximum(least, d2, out=part)
                np.minimum(second, part, out=second)
                np.minimum(least, d2, out=least)
        if np.isnan(least).any():  # of a centre without a coordinate: it counts as the nearest
            odd = np.flatnonzero(np.isnan(least).any(axis=1))
            label[odd] = self.squared(points[odd]).argmin(axis=2)
        return label, least, second

    def least(self, points: np.ndarray) -> np.ndarray:
        """Rounded squared distance of each point to its nearest centre in each fit (points x fits)."""
        out = np.empty((len(points), self.fits))
        for part in _slices(self, len(points)):
            out[part] = self.nearest(points[part])[1]
        return rounded(out)

    def labels(self, points: np.ndarray) -> np.ndarray:
        """Label of each point in each fit (points x fits). ``points`` holds no NaN."""
        best, least, second = self.nearest(points)
        if self.width > 1:
            reach = least + (1.5 * 10.0**-DISTANCE_DIGITS + least * 1e-15)
            r, f = np.nonzero(second <= reach)
            if len(r):
                part = points[r, None, :] - self.flat.reshape(self.fits, self.width, 3)[f]
                d2 = part[..., 0] * part[..., 0] + part[..., 1] * part[..., 1] + part[..., 2] * part[..., 2]
                low, close = least[r, f][:, None], d2 <= reach[r, f][:, None]
                for n in np.flatnonzero((close & (d2 != low)).any(axis=1)).tolist():
                    row = d2[n]
                    best[r[n], f[n]] = min(np.flatnonzero(close[n]).tolist(), key=lambda j, row=row: (_rounded(float(row[j])), j))
        return best


def _points(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates (points x 3) with zeros for missing ones, and where they are missing."""
    at = np.stack([batch.column(a).to_numpy(zero_copy_only=False).astype(np.float64) for a in "xyz"], axis=1)
    gone = np.isnan(at)
    at[gone] = 0.0
    return at, gone


def _slices(centres: Centres, n: int) -> Iterator[slice]:
    rows = max(1, CELLS // centres.fits)
    return (slice(s, min(s + rows, n)) for s in range(0, n, rows))


class _Boxes:
    """Rows of one space, ``BOX`` after ``BOX``, with the box that holds each of these parts."""

    def __init__(self, at: np.ndarray, bad: np.ndarray) -> None:
        self.at, self.bad = at, bad
        self.starts = np.arange(0, len(at), BOX)
        low, high = np.minimum.reduceat(at, self.starts), np.maximum.reduceat(at, self.starts)
        self.mid, self.half = (low + high) / 2, (high - low) / 2
        self.odd = np.logical_or.reduceat(bad, self.starts)

    def settled(self, c: Centres) -> np.ndarray:
        """Label of all points of a box in each fit, -1 where they may have several (boxes x fits).

        |x - a|² - |x - b|² is linear in x, so its largest value in a box follows from the middle and the half sides."""
        out, places = [], c.flat.reshape(c.fits, c.width, 3)
        for part in _slices(c, len(self.mid)):
            mid, half = self.mid[part], self.half[part]
            label, least, _ = c.nearest(mid)
            near = places[np.arange(c.fits), label]
            one = np.ones(label.shape, bool)
            with np.errstate(invalid="ignore", over="ignore"):
                for j in range(c.width):
                    d2, reach = np.zeros(label.shape), np.zeros(label.shape)
                    for a in range(3):
                        d2 += (mid[:, a:a + 1] - c.sides[j, a]) ** 2
                        reach += half[:, a:a + 1] * np.abs(c.sides[j, a] - near[..., a])
                    slack = 10 * 10.0**-DISTANCE_DIGITS + 1e-12 * (least + d2 + reach)
                    one &= (least - d2 + 2 * reach < -slack) | (label == j) | np.isposinf(c.sides[j, 0])
            label[~one | self.odd[part, None]] = -1
            out.append(label)
        return np.concatenate(out)

    def rows(self, open_boxes: np.ndarray) -> np.ndarray:
        rows = (self.starts[open_boxes][:, None] + np.arange(BOX)).ravel()
        return rows[rows < len(self.at)]

    def labels_of(self, one: Centres, rows: np.ndarray) -> np.ndarray:
        """Labels of some rows in a single fit."""
        got = np.concatenate([one.labels(self.at[rows[part]])[:, 0] for part in _slices(one, len(rows))])
        got[self.bad[rows]] = 0
        return got

    def labels(self, c: Centres, alone: Sequence[Centres]) -> np.ndarray:
        """Label of each row in each fit (rows x fits)."""
        settled = self.settled(c)
        label = np.repeat(settled, BOX, axis=0)[:len(self.at)]
        for f in np.flatnonzero((settled < 0).any(axis=0)).tolist():
            rows = self.rows(settled[:, f] < 0)
            label[rows, f] = self.labels_of(alone[f], rows)
        return label


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, about ``HELD`` at once."""
    kept, rows = [], 0
    for batch in batches:
        kept.append(batch)
        rows += batch.num_rows
        if rows >= HELD:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches(max_chunksize=2 * HELD)
            kept, rows = [], 0
    if rows:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches(max_chunksize=2 * HELD)


def _kd_order(at: np.ndarray) -> np.ndarray:
    """Row numbers in the order of a kd-tree's leaves of ``BOX`` rows: the widest side is cut in the middle, again and again."""
    order, parts = np.arange(len(at)), [(0, len(at))]
    while parts:
        a, b = parts.pop()
        if b - a <= BOX:
            continue
        mine = order[a:b]
        here = at[mine]
        axis = int(np.argmax(here.max(axis=0) - here.min(axis=0)))
        cut = BOX * (-(-(b - a) // BOX) // 2)
        order[a:b] = mine[np.argpartition(here[:, axis], cut)]
        parts += [(a, a + cut), (a + cut, b)]
    return order


def near_together(points: DataFrame, parts: int) -> DataFrame:
    """The same points in ``parts`` partitions, neighbours next to each other: dealt out by range of one coordinate, and each
    partition (``HELD`` rows at once) in the order of a kd-tree's leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _held(batches):
            at, _ = _points(batch)
            space = batch.column("space").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            places = [np.flatnonzero(space == n) for n in np.unique(space)]
            yield batch.take(pa.array(np.concatenate([mine[_kd_order(at[mine])] for mine in places])))

    points = points.select("space", "customer_id", "x", "y", "z")
    dealt = points.repartitionByRange(parts, "space", "x", "y", "customer_id") if parts > 1 else points.coalesce(1)
    return dealt.mapInArrow(run, points.schema)


def _by_space(points: DataFrame, spaces: Sequence[str], *extra: str) -> DataFrame:
    """The points of some spaces, each with its space's place in the list."""
    at = F.lit(None).cast("int")
    for n, sp in reversed(list(enumerate(spaces))):
        at = F.when(F.col("space") == sp, n).otherwise(at)
    return points.where(F.col("space").isin(list(spaces))).select(at.alias("at"), *extra, "x", "y", "z")


def _add(total: np.ndarray, sums: np.ndarray) -> None:
    total[:, :7] += sums[:, :7].astype(np.int64)
    total[:, 7:10] += (sums[:, 7:] if sums.shape[1] > 7 else sums[:, :1]).astype(np.int64)


def _add_boxes(boxes: _Boxes, c: Centres, alone: Sequence[Centres], table: np.ndarray, total: np.ndarray) -> None:
    """Adds the rows of ``table`` to the sums of their clusters: whole boxes where all points share a label. The sums of ``HELD``
    rows are whole numbers below 2^53."""
    settled, whole = boxes.settled(c), np.add.reduceat(table, boxes.starts)
    for j in range(c.width):
        _add(total[j::c.width], (settled == j).T.astype(np.float64) @ whole)
    for f in np.flatnonzero((settled < 0).any(axis=0)).tolist():
        rows = boxes.rows(settled[:, f] < 0)
        label, mine = boxes.labels_of(alone[f], rows), table[rows]
        sums = (label == np.arange(alone[f].width)[:, None]).astype(np.float64) @ mine
        _add(total[f * c.width:f * c.width + alone[f].width], sums)


def round_sums(points: DataFrame, fits: dict[str, list[tuple[int, list[Centre]]]], follows: dict[int, int] | None = None) -> DataFrame:
    """(fit, l) with the number of members, the halves of their coordinate sums and how many values each has. ``fits[space]``
    lists (fit, centres). ``follows[fit]`` names an earlier fit of the same space: ``changed`` counts members with another label there.

    Each task adds up its own points first, so that (tasks x fits x k) rows are shuffled."""
    spaces = list(fits)
    numbers = [np.array([f for f, _ in fits[sp]], np.int64) for sp in spaces]
    sets = [[c for _, c in fits[sp]] for sp in spaces]
    place = [{f: n for n, (f, _) in enumerate(fits[sp])} for sp in spaces]
    before = [np.array([place[n].get((follows or {}).get(f, f)) for f, _ in fits[sp]], np.int64) for n, sp in enumerate(spaces)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = [Centres(s) for s in sets]
        alone = [[Centres([c]) for c in s] for s in sets]
        total = [np.zeros((c.fits * c.width, len(PARTS)), np.int64) for c in centres]
        for batch in _held(batches):
            at, gone = _points(batch)
            units = np.stack([whole_units(at[:, a]) for a in range(3)], axis=1)
            # 1, the high halves, the low halves, and where values are missing which are present
            columns = [np.ones((len(at), 1)), units // HALF, units % HALF, *([~gone] if gone.any() else [])]
            table = np.concatenate(columns, axis=1, dtype=np.float64)
            space, bad = batch.column("at").to_numpy(zero_copy_only=False), gone.any(axis=1)
            for n, c in enumerate(centres):
                mine = np.flatnonzero(space == n)
                if follows is None and len(mine):
                    _add_boxes(_Boxes(at[mine], bad[mine]), c, alone[n], table[mine], total[n])
                    continue
                for part in _slices(c, len(mine)):
                    rows = mine[part]
                    label = c.labels(at[rows])
                    label[bad[rows]] = 0
                    mine_table = table[rows]
                    for j in range(c.width):
                        _add(total[n][j::c.width], (label == j).T.astype(np.float64) @ mine_table)
                    moved = label != label[:, before[n]]
                    cell = label + np.arange(c.fits) * c.width
                    total[n][:, 10] += np.bincount(cell[moved], minlength=c.fits * c.width)
        for n, c in enumerate(centres):
            some = np.flatnonzero(total[n][:, 0])
            cols = [pa.array(np.repeat(numbers[n], c.width)[some]), pa.array((some % c.width).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(total[n][some, j]) for j in range(len(PARTS))], names=["fit", "l", *PARTS])

    sums = _by_space(points, spaces).mapInArrow(run, "fit long, l long, " + ", ".join(f"{p} long" for p in PARTS))
    return sums.groupBy("fit", "l").agg(*[F.sum(p).alias(p) for p in PARTS])


def centre(row) -> tuple[float | None, ...]:
    """Means of a ``round_sums`` row: the exact sum as a double, divided by the members; null where no member has the coordinate."""
    return tuple((row[f"hi_{a}"] * HALF + row[f"lo_{a}"]) / UNITS / row["n"] if row[f"in_{a}"] else None for a in "xyz")


def label_steps(points: DataFrame, space: str, sets: Sequence[Sequence[Centre]]) -> DataFrame:
    """(step, customer_id, label_before, label_after) of every point whose label under ``sets[step]`` is not that under
    ``sets[step - 1]``."""
    sets = [list(s) for s in sets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Centres(sets)
        for batch in batches:
            at, gone = _points(batch)
            bad, ids = gone.any(axis=1), batch.column("customer_id")
            for part in _slices(c, len(at)):
                label = c.labels(at[part])
                label[bad[part]] = 0
                row, step = np.nonzero(label[:, 1:] != label[:, :-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(step + 1), ids.take(pa.array(row + part.start)), pa.array(label[row, step].astype(np.int64)), pa.array(label[row, step + 1].astype(np.int64))],
                    names=["step", "customer_id", "label_before", "label_after"])

    return _by_space(points, [space], "customer_id").mapInArrow(run, "step long, customer_id string, label_before long, label_after long")


def label_vectors(points: DataFrame, fits: dict[str, list[Sequence[Centre]]], distances: bool = True) -> DataFrame:
    """(space, customer_id, x, y, z, labels, d2s): label and rounded squared distance of every point in each fit of its space, in
    the order of ``fits[space]``. A point with a missing coordinate has label 0 and null distances. Without ``distances`` the
    labels alone, as smallint."""
    spaces = list(fits)
    sets = [fits[sp] for sp in spaces]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, alone = [Centres(s) for s in sets], [[Centres([c]) for c in s] for s in sets]
        for batch in _held(batches):
            at, gone = _points(batch)
            space, bad = batch.column("at").to_numpy(zero_copy_only=False), gone.any(axis=1)
            for n, c in enumerate(centres):
                all_mine = np.flatnonzero(space == n)
                for start in range(0, len(all_mine), ROWS_OUT):
                    mine = all_mine[start:start + ROWS_OUT]
                    label = _Boxes(at[mine], bad[mine]).labels(c, alone[n])
                    ends = pa.array(np.arange(len(mine) + 1, dtype=np.int32) * c.fits)
                    lists = [pa.ListArray.from_arrays(ends, pa.array(label.astype(np.int32 if distances else np.int16).ravel()))]
                    if distances:
                        lists.append(pa.ListArray.from_arrays(ends, pa.array(c.least(at[mine]).ravel(), mask=np.repeat(bad[mine], c.fits))))
                    kept = batch.select(["space", "customer_id", "x", "y", "z"]).take(pa.array(mine))
                    yield pa.RecordBatch.from_arrays([*kept.columns, *lists], names=[*kept.schema.names, "labels", "d2s"][:5 + len(lists)])

    lists = "labels array<int>, d2s array<double>" if distances else "labels array<smallint>"
    return _by_space(points, spaces, "space", "customer_id").mapInArrow(run, f"space string, customer_id string, x double, y double, z double, {lists}")


def fit_stats(points: DataFrame, fits: dict[str, list[tuple[int, Sequence[Centre]]]]) -> DataFrame:
    """(fit, label) with the members ``n``, the least customer id, two checksums of the members' ids (``a``, ``b``, each in two halves
    of 32 bits) and, at the first label of a fit in a task, the rounded squared distances of the fit's points to their centres in units of
    1e-10 (halves ``hi``, ``lo``; points without a coordinate add none). ``fits[space]`` lists (fit, centres).

    Each task adds up its own points, so (point, fit) pairs never become rows."""
    spaces = list(fits)
    numbers = [np.array([f for f, _ in fits[sp]], np.int64) for sp in spaces]
    sets = [[c for _, c in fits[sp]] for sp in spaces]
    sums = ("n", "a1", "a0", "b1", "b0", "hi", "lo")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, alone = [Centres(s) for s in sets], [[Centres([c]) for c in s] for s in sets]
        total = [np.zeros((c.fits, c.width, len(sums)), np.int64) for c in centres]
        least: list[dict[tuple[int, int], str]] = [{} for _ in centres]
        for batch in _held(batches):
            at, gone = _points(batch)
            space, bad = batch.column("at").to_numpy(zero_copy_only=False), gone.any(axis=1)
            halves = [h for c in ("h1", "h2") for v in [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64)] for h in (v >> np.uint64(32), v & np.uint64(0xFFFFFFFF))]
            table = np.stack([np.ones(len(at)), *halves], axis=1).astype(np.float64)
            for n, c in enumerate(centres):
                all_mine = np.flatnonzero(space == n)
                for start in range(0, len(all_mine), ROWS_OUT):
                    mine = all_mine[start:start + ROWS_OUT]
                    label = _Boxes(at[mine], bad[mine]).labels(c, alone[n])
                    d2 = c.least(at[mine])
                    d2[bad[mine]] = 0.0
                    d2[np.isnan(d2)] = 0.0  # of a centre without a coordinate
                    for i, f in zip(*np.nonzero(d2 >= 1e8), strict=True):  # their units are more than 64 bits hold in a sum
                        far = int(Decimal(repr(float(d2[i, f]))).scaleb(10).to_integral_value(context=WIDE))
                        total[n][f, 0, 5:] += far // HALF, far % HALF
                        d2[i, f] = 0.0
                    units = whole_units(d2.ravel()).reshape(d2.shape)
                    total[n][:, 0, 5] += (units // HALF).sum(axis=0)
                    total[n][:, 0, 6] += (units % HALF).sum(axis=0)
                    ids = batch.column("customer_id").take(pa.array(mine))
                    by_id = pc.sort_indices(ids, null_placement="at_end").to_numpy()[:len(mine) - ids.null_count]
                    for j in range(c.width):
                        held = label == j
                        total[n][:, j, :5] += (held.T.astype(np.float64) @ table[mine]).astype(np.int64)
                        of_known = held[by_id]
                        for f in np.flatnonzero(of_known.any(axis=0)).tolist():
                            who = ids[int(by_id[of_known[:, f].argmax()])].as_py()
                            if (f, j) not in least[n] or who < least[n][f, j]:
                                least[n][f, j] = who
        for n, c in enumerate(centres):
            f, j = np.nonzero(total[n].any(axis=2))
            names = [least[n].get(k) for k in zip(f.tolist(), j.tolist(), strict=True)]
            cols = [pa.array(numbers[n][f]), pa.array(j.astype(np.int64)), pa.array(names, pa.string()), *(pa.array(total[n][f, j, i]) for i in range(len(sums)))]
            yield pa.RecordBatch.from_arrays(cols, names=["fit", "l", "least", *sums])

    hashes = [F.xxhash64("customer_id").alias("h1"), F.xxhash64("customer_id", F.lit("second")).alias("h2")]
    rows = _by_space(points, spaces, "customer_id", *hashes).mapInArrow(run, "fit long, l long, least string, " + ", ".join(f"{c} long" for c in sums))
    return rows.groupBy("fit", "l").agg(F.min("least").alias("least"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in sums])


def _draws(tails: list[bytes], head: bytes) -> np.ndarray:
    """u of each point: (h + 0.5) / 2^52 with h the first 13 hex digits of the md5 of ``head`` and the point's tail."""
    digests = b"".join([hashlib.md5(head + t, usedforsecurity=False).digest() for t in tails])
    return ((np.frombuffer(digests, ">u8")[::2] >> 12).astype(np.float64) + 0.5) / 4503599627370496.0


def seed_picks(points: DataFrame, fits: dict[str, list[tuple[int, int, int, list[Centre]]]], step: int) -> DataFrame:
    """(fit, p): the point with the least score -ln(u)/D² in a step of the seeded start, ties to the lower customer id. ``fits[space]``
    lists (fit, seed, init, centres so far). A task keeps one row a fit; (point, fit) pairs never become rows."""
    spaces = list(fits)
    mine_of = [fits[sp] for sp in spaces]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = [Centres([c for *_, c in m]) if step else None for m in mine_of]
        best: dict[int, tuple] = {}
        for batch in batches:
            at, gone = _points(batch)
            space, bad = batch.column("at").to_numpy(zero_copy_only=False), gone.any(axis=1)
            ids = batch.column("customer_id").to_pylist()
            for n, listed in enumerate(mine_of):
                mine = np.flatnonzero(space == n)
                if not len(mine):
                    continue
                tails = [b"" if ids[i] is None else b"|" + ids[i].encode() for i in mine.tolist()]
                if step:
                    d2 = sets[n].least(at[mine])
                    d2[bad[mine]] = 0.0
                for f, (fit, seed, init, _) in enumerate(listed):
                    u = _draws(tails, f"{seed}|{init}|{step}".encode())
                    s = -np.log(u)
                    if step:
                        s = np.divide(s, d2[:, f], out=np.full(len(mine), np.inf), where=d2[:, f] > 0)
                    for j in np.flatnonzero(s <= s.min() * (1 + 1e-14)).tolist():
                        r = int(mine[j])
                        score = -math.log(u[j]) / (float(d2[j, f]) if step else 1.0) if s[j] < np.inf else math.inf
                        where = [None if gone[r, a] else float(at[r, a]) for a in range(3)]
                        key = (score, ids[r] is not None, ids[r] or "", *((v is not None, v or 0.0) for v in where))
                        if fit not in best or key < best[fit][0]:
                            best[fit] = (key, (fit, score, ids[r], *where))
        if best:
            cols = zip(*(row for _, row in best.values()), strict=True)
            kinds = (pa.int64(), pa.float64(), pa.string(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["fit", "s", "customer_id", "x", "y", "z"])

    rows = _by_space(points, spaces, "customer_id").mapInArrow(run, "fit long, s double, customer_id string, x double, y double, z double")
    return rows.groupBy("fit").agg(F.min(F.struct("s", "customer_id", "x", "y", "z")).alias("p"))


def least_of_fits(rows: DataFrame) -> DataFrame:
    """The row of each fit with the least score ``s``, ties to the lower customer id, from (fit, s, customer_id, x, y, z). Each task
    keeps one row a fit, so the (point, fit) rows are neither sorted nor shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            fit, s = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fit", "s"))
            order = np.lexsort((s, fit))
            starts = np.flatnonzero(np.diff(fit[order], prepend=fit[order[0]] - 1)) if len(order) else order
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
                tied = order[a:b][s[order[a:b]] == s[order[a]]]
                for row in batch.take(pa.array(tied)).to_pylist():
                    key = (row["s"], row["customer_id"])
                    if row["fit"] not in best or key < best[row["fit"]][0]:
                        best[row["fit"]] = (key, row)
        if best:
            yield pa.RecordBatch.from_pylist([row for _, row in best.values()], schema=schema)

    return rows.mapInArrow(run, rows.schema).groupBy("fit").agg(F.min(F.struct("s", "customer_id", "x", "y", "z")).alias("p"))
