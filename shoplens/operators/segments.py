"""From fitted clusters to named segments: mapping, profiles, centroids, representatives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

PROFILE_METRICS = ("recency", "frequency", "gross_monetary", "net_monetary")


def semantic_mapping(labelled: DataFrame, label_col: str = "raw_cluster") -> dict[int, str]:
    """Clusters ranked by the median of *raw* net value, ties to the lower cluster number,
    named S1..Sk. Medians come from the exact distributed quantile operator."""
    med = exact_quantiles(labelled, [label_col], "net_monetary", [0.5]).collect()
    ordered = sorted(((r["q"], r[label_col]) for r in med), key=lambda t: (t[0], t[1]))
    return {int(label): f"S{i + 1}" for i, (_, label) in enumerate(ordered)}


class NotOneToOne(ValueError):
    """Two clusters share a segment, or a segment has no cluster."""


def require_one_to_one(mapping: dict[int, str], segments: Sequence[str]) -> dict[int, str]:
    """The mapping itself; raises where it does not name every segment exactly once."""
    if sorted(mapping.values()) != sorted(segments):
        raise NotOneToOne(f"clusters {mapping} do not name the segments {sorted(segments)} one to one")
    return mapping


def mapping_frame(spark: SparkSession, mapping: dict[int, str]) -> DataFrame:
    return spark.createDataFrame(
        [(int(k), v, int(v[1:])) for k, v in sorted(mapping.items())],
        "raw_cluster int, segment_code string, segment_order int",
    )


def code_expr(label: Column, mapping: dict[int, str]) -> Column:
    """Literal label → code map (k entries), evaluated inline without a join."""
    expr = None
    for k, v in sorted(mapping.items()):
        expr = F.when(label == k, F.lit(v)) if expr is None else expr.when(label == k, F.lit(v))
    return expr


def dimension(spark: SparkSession, segments: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """The segment dimension: code, order, name, description, hypothesis, KPIs (4 rows)."""
    return spark.createDataFrame(
        [(c, int(c[1:]), n, d, h, k) for c, n, d, h, k in segments],
        "segment_code string, segment_order int, segment_name string, description string, "
        "strategy_hypothesis string, future_kpis string",
    )


def representatives(segmented: DataFrame) -> DataFrame:
    """Per segment the customer nearest to its centre, ties to the first customer id.

    ``min(struct(distance, id))`` is a partial aggregate: each task keeps one candidate per
    segment, so a segment with most customers never lands whole in one task."""
    best = segmented.groupBy("segment_code").agg(
        F.min(F.struct("centroid_distance", "customer_id")).alias("b")
    )
    return best.select("segment_code", F.col("b.customer_id").alias("customer_id"), F.col("b.centroid_distance").alias("centroid_distance"))


def profiles(segmented: DataFrame, dim: DataFrame) -> DataFrame:
    """Segment profile: size, shares, net total and mean/q25/median/q75 of R, F, gross, net in
    original units. Left join from the dimension, so empty segments still have a row."""
    totals = segmented.agg(F.count(F.lit(1)).alias("_n_all"), F.sum("net_monetary").alias("_net_all"))
    base = segmented.groupBy("segment_code").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("net_monetary").alias("net_monetary_total"),
        *[F.avg(F.col(m).cast("double")).alias(f"{m}_mean") for m in PROFILE_METRICS],
    )
    long = segmented.select(
        "segment_code",
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in PROFILE_METRICS])
        ),
    )
    qs = exact_quantiles(long, ["segment_code", "metric"], "v", [0.25, 0.5, 0.75])
    names = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    wide = qs.groupBy("segment_code").agg(
        *[
            F.max(F.when((F.col("metric") == m) & (F.col("p") == p), F.col("q"))).alias(f"{m}_{n}")
            for m in PROFILE_METRICS
            for p, n in names.items()
        ]
    )
    # totals is a single row: attach it through a literal key (no cross join).
    totals = totals.withColumn("_one", F.lit(1))
    out = (
        dim.join(base, "segment_code", "left")
        .join(wide, "segment_code", "left")
        .withColumn("_one", F.lit(1))
        .join(F.broadcast(totals), "_one")
    )
    return out.select(
        *dim.columns,
        F.coalesce(F.col("customers"), F.lit(0)).cast("bigint").alias("customers"),
        (F.coalesce(F.col("customers"), F.lit(0)) / F.col("_n_all")).alias("customer_share"),
        F.coalesce(F.col("net_monetary_total"), F.lit(0).cast("decimal(18,4)")).alias("net_monetary_total"),
        (F.coalesce(F.col("net_monetary_total"), F.lit(0)).cast("double") / F.col("_net_all").cast("double")).alias(
            "net_monetary_share"
        ),
        *[
            F.col(f"{m}_{n}")
            for m in PROFILE_METRICS
            for n in ("mean", "q25", "median", "q75")
        ],
    )




def adjusted_rand(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """ARI of two labelings from contingency counts: one aggregate per (a, b) cell, then sums
    of C(n, 2). 1.0 when the denominator is 0 (e.g. both labelings have one cluster)."""
    cells = pairs.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    c2 = lambda c: c * (c - 1) / 2.0
    rows_a = cells.groupBy(a).agg(F.sum("n").alias("n"))
    rows_b = cells.groupBy(b).agg(F.sum("n").alias("n"))
    s_ij = cells.agg(F.sum(c2(F.col("n"))).alias("s_ij"), F.sum("n").alias("n_all"))
    s_a = rows_a.agg(F.sum(c2(F.col("n"))).alias("s_a"))
    s_b = rows_b.agg(F.sum(c2(F.col("n"))).alias("s_b"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    allv = one(s_ij).join(one(s_a), "_one").join(one(s_b), "_one")
    pairs = F.col("n_all") * (F.col("n_all") - 1) / 2.0
    expected = F.when(pairs > 0, F.col("s_a") * F.col("s_b") / pairs).otherwise(F.lit(0.0))
    maximum = (F.col("s_a") + F.col("s_b")) / 2.0
    denom = maximum - expected
    return allv.select(
        F.when(denom == 0, F.lit(1.0)).otherwise((F.col("s_ij") - expected) / denom).alias("ari")
    )
