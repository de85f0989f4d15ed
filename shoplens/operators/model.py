"""The segmentation model: caps → z-scores → best of n seeded K-means fits → named segments.

Only small things reach the driver: two caps, three means and stds, k centres per fit,
k medians, k representatives. The customer table is written once as Parquet in the shared
checkpoint folder (it is both the iteration input and the base of every customer-level
output), so later queries read only the columns they need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import Params
from ..session import materialize
from . import kmeans as K
from .features import SCALED, Caps, Scale, apply_caps, apply_scale, compute_caps, compute_scale
from .nearest import near_together
from .segments import code_expr, representatives, semantic_mapping

XYZ = SCALED


@dataclass
class Model:
    params: Params
    caps: Caps
    scale: Scale
    customers: DataFrame  # rfm + capped + scaled, checkpointed
    points: DataFrame  # (space, customer_id, x, y, z)
    states: dict[int, K.FitState]
    best: K.FitState
    mapping: dict[int, str]
    representatives: dict[str, str]

    @property
    def centres(self) -> list[K.Centre]:
        return self.best.centres

    def label_expr(self) -> tuple[Column, Column]:
        """(raw cluster, exact distance) to the final centres, as literal expressions."""
        return labels_for(self.centres)

    def segmented(self) -> DataFrame:
        """The customer segment table (19 columns, booleans as booleans)."""
        label, dist = self.label_expr()
        reps = list(self.representatives.values())
        return self.customers.withColumns({"raw_cluster": label, "centroid_distance": dist}).withColumns(
            {
                "segment_code": code_expr(F.col("raw_cluster"), self.mapping),
                "is_representative": F.col("customer_id").isin(reps) if reps else F.lit(False),
            }
        )


def labels_for(centres: list[K.Centre]) -> tuple[Column, Column]:
    from ..functions.numeric import nearest_centre

    pts = [F.col(c) for c in XYZ]
    label, _ = nearest_centre(pts, centres)
    dists = []
    for c in centres:
        s = None
        for p, v in zip(pts, c, strict=True):
            d = p - F.lit(float(v))
            s = d * d if s is None else s + d * d
        dists.append(F.sqrt(s))
    dist = F.element_at(F.array(*dists), label + 1)
    return label.cast("bigint"), dist


def prepare_customers(rfm: DataFrame, quantile: float | None) -> tuple[Caps, Scale, DataFrame]:
    caps = compute_caps(rfm, quantile)
    capped = apply_caps(rfm, caps)
    scale = compute_scale(capped)
    return caps, scale, apply_scale(capped, scale)


def as_points(customers: DataFrame, space: str) -> DataFrame:
    return customers.select(
        F.lit(space).alias("space"),
        "customer_id",
        F.col(XYZ[0]).alias("x"),
        F.col(XYZ[1]).alias("y"),
        F.col(XYZ[2]).alias("z"),
    )


def iteration_input(points: DataFrame, rows: int, fits: int, rows_per_task: int = 1_000_000, least: int = 10_000) -> DataFrame:
    """Size the iteration input to the point × fit work: one task per ~1M (point, fit)
    pairs and ``least`` points or more, at most max(shuffle partitions, current partitions),
    neighbours next to each other (one shuffle of the point table before the rounds start; sums
    are exact decimals, so the row placement cannot change a result)."""
    have = points.rdd.getNumPartitions()
    cap = max(have, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    want = max(1, min(cap, -(-rows * fits // rows_per_task), -(-rows // least)))
    return near_together(points, want)


def fit_model(rfm: DataFrame, params: Params, space: str = "base") -> Model:
    caps, scale, scaled = prepare_customers(rfm, params.cap_quantile)
    customers = materialize(scaled, "customers")
    # In memory on top of the checkpoint: rounds re-read it; a lost block is re-read from the checkpoint.
    points = iteration_input(as_points(customers, space), customers.count(), params.n_init).persist()
    specs = [K.FitSpec(fit=i, space=space, k=params.k, seed=params.seed, init=i) for i in range(params.n_init)]
    # Restart 0 keeps its centre history: the Lloyd trace is recomputed from it in one job.
    states = K.fit_many(points, specs, params.max_iter, keep_history=[0], tol=params.tol)
    best = K.best_of(points, states, {0: [s.fit for s in specs]})[0]
    label, dist = labels_for(best.centres)
    labelled = customers.select("customer_id", "net_monetary", label.alias("raw_cluster"), dist.alias("centroid_distance"))
    mapping = semantic_mapping(labelled)
    reps = {
        r["segment_code"]: r["customer_id"]
        for r in representatives(labelled.withColumn("segment_code", code_expr(F.col("raw_cluster"), mapping))).collect()
    }
    return Model(params, caps, scale, customers, points, states, best, mapping, reps)
