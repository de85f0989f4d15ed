"""Exact, linearly interpolated quantiles per group: one path for every size.

1. A sketch (``percentile_approx``, mergeable, of bounded size) gives, for each (group, p), a bracket of values around the
   quantile. Its rank error is at most ``n / ACCURACY``, so the bracket between the sketch's quantiles at
   ``p ± 3 / ACCURACY`` holds the wanted rows; at the ends, and for groups of so few rows that a rank is more than
   ``n / ACCURACY``, the bracket ends at the extremes.
2. One counting pass: values below the bracket are one counter, values inside it are counted by value (with map-side
   combine, so a value shared by a third of all rows is one row per task).
3. The exact position is looked up in the running counts of the bracket's distinct values: about ``8 n / ACCURACY`` rows of
   a group at most, in a window per (group, p).

Interpolation: pos = (n − 1)·p, lo = ⌊pos⌋, hi = ⌈pos⌉, q = (hi − pos)·v[lo] + (pos − lo)·v[hi] (v[lo] when lo = hi).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
SLACK = 3 / ACCURACY


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(groups..., p, q) for each non-empty group and each probability. Nulls are ignored."""
    if not groups:
        return exact_quantiles(df.withColumn("_g", F.lit(0)), ["_g"], value, probs).drop("_g")
    data = df.select(*groups, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    asked = [float(p) for p in probs]
    ends = sorted({min(1.0, max(0.0, p + side * SLACK)) for p in asked for side in (-1, 1)})
    at = {e: n for n, e in enumerate(ends)}
    sketched = data.groupBy(*groups).agg(F.percentile_approx("_v", ends, ACCURACY).alias("_s"), F.count(F.lit(1)).alias("_n"),
                                         F.min("_v").alias("_min"), F.max("_v").alias("_max"))

    few = F.col("_n") <= ACCURACY

    def bracket(p: float):
        low, high = max(0.0, p - SLACK), min(1.0, p + SLACK)
        return F.struct(
            F.lit(p).alias("p"),
            F.when(F.lit(low == 0.0) | few, F.col("_min")).otherwise(F.get("_s", F.lit(at[low]))).alias("_low"),
            F.when(F.lit(high == 1.0) | few, F.col("_max")).otherwise(F.get("_s", F.lit(at[high]))).alias("_high"),
        )

    keys = [f"_k{i}" for i in range(len(groups))]
    named = [F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)]
    brackets = sketched.select(*named, F.inline(F.array(*[bracket(p) for p in asked])))
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    # group columns are compared null-safely: a null group is a group
    on = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(groups, keys, strict=True)]
    met = data.join(brackets, on).where(F.col("_v") <= F.col("_high")).select(*groups, "p", F.when(inside, F.col("_v")).alias("_v"))
    counts = met.groupBy(*groups, "p", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*groups, "p").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_to", F.sum("_c").over(upto))  # rows up to and with this value
    sized = ranked.join(sketched.select(*named, "_n"), on).withColumn("_pos", (F.col("_n") - 1) * F.col("p"))
    lo, hi = F.floor("_pos").cast("bigint"), F.ceil("_pos").cast("bigint")
    here = lambda rank: F.max(F.when((rank >= F.col("_to") - F.col("_c")) & (rank < F.col("_to")), F.col("_v")))
    picked = sized.groupBy(*groups, "p", "_pos").agg(here(lo).alias("_vlo"), here(hi).alias("_vhi"))
    q = F.when(lo == hi, F.col("_vlo")).otherwise((hi - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - lo) * F.col("_vhi"))
    return picked.select(*groups, "p", q.alias("q"))
