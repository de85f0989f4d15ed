"""Embedding near-duplicates by collision-counting projections.

Vectors of one label are projected on ``PROJECTIONS`` random unit directions. On each direction a pair collides when one
lies in the window centred on the other; close pairs collide on nearly all directions, others on few. Collisions are
counted per pair, pairs that reach a count calibrated for recall ``RECALL`` at the threshold distance are verified by
cosine in double precision.

Plan: equal vectors of a label are one class with a count. Classes are sorted into strips of the first direction, as wide as
the distance of the threshold, so a link never reaches beyond the next strip (a projection shrinks distances);
strips are dealt into even parts by hash, and each pair of parts that can hold links is one task of at most about
2 x ``PART`` vectors. A task returns a number and one hook per vector, never the pairs: rows grow with vectors and
parts, not with the square of a group of near copies. A label with n vectors in one strip costs about n * n / 2
counted pairs in blocks, which is the price of one-dimensional windows when a label's vectors lie in one strip.

Vectors that are null, empty, zero, or hold null or non-finite components, and vectors with a null label, link with
nothing: 0 links, a component of their own, kept. Vectors of different lengths are never compared. Repeated rows
count as vectors of their own. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize

PROJECTIONS = 16
WINDOW = 2.0  # half width, in standard deviations of a projected pair at the threshold distance
RECALL = 0.999
PART = 2048


def directions(dim: int, count: int = PROJECTIONS) -> np.ndarray:
    """Random unit directions (columns), the same for every task."""
    r = np.random.default_rng(20240517 + dim).standard_normal((dim, count))
    return r / np.linalg.norm(r, axis=0)


def needed_count(recall: float = RECALL, count: int = PROJECTIONS, window: float = WINDOW) -> int:
    """The largest count that a pair at the threshold distance reaches with probability ``recall``."""
    p = erf(window / sqrt(2))
    tail, c = 0.0, count
    while True:
        tail += comb(count, c) * p ** c * (1 - p) ** (count - c)
        if tail >= recall:
            return c
        c -= 1


def usable(values) -> np.ndarray | None:
    """The vector in double precision, or None where nothing can be linked with it."""
    if values is None or len(values) == 0 or any(v is None for v in values):
        return None
    x = np.asarray(values, dtype=np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def _read(distance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            label = batch.column("label").to_pylist()
            vectors = [usable(v) if k is not None else None for v, k in zip(batch.column("embedding").to_pylist(), label, strict=True)]
            strips = []
            for x in vectors:
                if x is None:
                    strips.append(None)
                    continue
                if len(x) not in made:
                    made[len(x)] = directions(len(x))[:, 0]
                scaled = x / np.abs(x).max()
                strips.append(int(np.floor(float(scaled @ made[len(x)]) / np.linalg.norm(scaled) / distance)))
            data = [None if x is None else (x + 0.0).tobytes() for x in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([None if x is None else len(x) for x in vectors], pa.int32()),
                 pa.array(strips, pa.int32()), pa.array(data, pa.binary()), pa.array([None if d is None else xxhash.xxh3_128_digest(d) for d in data], pa.binary())],
                names=["vec_id", "label", "dim", "strip", "data", "digest"])

    return run


def _compare(threshold: float, needed: int):
    distance = sqrt(2 - 2 * threshold)

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        cid, weight = table.column("cid").to_numpy(), table.column("rows").to_numpy()
        x = np.stack([np.frombuffer(b, np.float64) for b in table.column("data").to_pylist()])
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in squares; cosine does not change
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        own = side[0] == 2
        left, right = (np.arange(len(x)),) * 2 if own else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        p = (x @ directions(x.shape[1])).astype(np.float32)
        half = np.float32(WINDOW * distance / sqrt(x.shape[1]))
        links, root = np.zeros(len(x), np.int64), np.arange(len(x))
        for a in range(0, len(left), 256):
            rows = left[a:a + 256]
            count = np.zeros((len(rows), len(right)), np.uint8)
            for t in range(p.shape[1]):
                count += np.abs(p[rows, t][:, None] - p[right, t][None, :]) <= half
            i, j = np.nonzero(count >= needed)
            i, j = rows[i], right[j]
            if own:
                i, j = i[i < j], j[i < j]
            for b in range(0, len(i), 200_000):
                u, v = i[b:b + 200_000], j[b:b + 200_000]
                near = np.einsum("nd,nd->n", x[u], x[v]) >= threshold
                u, v = u[near], v[near]
                np.add.at(links, u, weight[v])
                np.add.at(links, v, weight[u])
                root = _hooked(root, u, v)
        out = np.flatnonzero(links)
        return pa.table({"cid": pa.array(cid[out], pa.int64()), "links": pa.array(links[out], pa.int64()), "hook": pa.array(cid[root[out]], pa.int64())})

    return run


def _hooked(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``root`` (the least of each set) after the links u-v. Only roots are hooked, so no set made before falls apart; a root
    with links to several others takes the least, and its links stay until both their ends have one root."""
    root = root.copy()
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            return root
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    distance = sqrt(2 - 2 * threshold)
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"),
                            F.col(label_col).cast("string").alias("label"))
    read = source.mapInArrow(_read(distance), "vec_id long, label string, dim int, strip int, data binary, digest binary")
    rows = materialize(read.withColumn("row", F.monotonically_increasing_id()), "vectors")
    classes = rows.where("dim is not null").groupBy("label", "dim", "strip", "digest").agg(
        F.min("row").alias("cid"), F.min("vec_id").alias("doc"), F.count("*").alias("rows"), F.min_by("data", "row").alias("data"))
    classes = materialize(classes, "vector-classes")

    parts = classes.groupBy("label", "dim", "strip").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    around = parts.select("label", "dim", (F.col("strip") - 1).alias("below"), F.col("parts").alias("parts_below"))
    above = parts.select("label", "dim", (F.col("strip") + 1).alias("above"), F.col("parts").alias("parts_above"))
    sizes = parts.join(around.withColumnRenamed("below", "strip"), ["label", "dim", "strip"], "left").join(
        above.withColumnRenamed("above", "strip"), ["label", "dim", "strip"], "left").fillna(0)
    # ``parts_below`` counts the parts of the strip after this one, ``parts_above`` those of the one before it
    mine = F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")
    placed = classes.join(sizes, ["label", "dim", "strip"]).withColumn("part", mine)

    def cells(count: str, make) -> F.Column:
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), make)).otherwise(F.array())

    def cell(sa, ia, sb, ib, side):
        return F.struct(sa.alias("sa"), ia.cast("int").alias("ia"), sb.alias("sb"), ib.cast("int").alias("ib"), side.alias("side"))

    s, i = F.col("strip"), F.col("part")
    same = cells("parts", lambda j: F.when(j == i, cell(s, i, s, j, F.lit(2))).when(j > i, cell(s, i, s, j, F.lit(0))).otherwise(cell(s, j, s, i, F.lit(1))))
    after = cells("parts_below", lambda j: cell(s, i, s + 1, j, F.lit(0)))
    earlier = cells("parts_above", lambda j: cell(s - 1, j, s, i, F.lit(1)))
    dealt = placed.select("label", "dim", "cid", "rows", "data", F.explode(F.concat(same, after, earlier)).alias("c")).select(
        "label", "dim", "c.*", "cid", "rows", "data")
    found = dealt.groupBy("label", "dim", "sa", "ia", "sb", "ib").applyInArrow(_compare(threshold, needed_count()), "cid long, links long, hook long")
    found = materialize(found, "vector-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    reached = connected_components(found.where("cid <> hook"), "cid", "hook")

    named = classes.select("label", "dim", "digest", "cid", "doc", "rows").join(counts, "cid", "left").join(
        reached.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = named.groupBy("component").agg(F.min("doc").alias("least"))
    ids = named.join(least, "component").select("label", "dim", "digest", "least", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("links"))
    return rows.select("vec_id", "label", "dim", "digest").join(ids, ["label", "dim", "digest"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("dim").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
