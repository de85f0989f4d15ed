"""Model input: upper caps at an exact quantile, then population z-scores.

Caps and scaling statistics are single-row aggregates over the customer table (partial
aggregation, one tiny result); they come back to the driver as a handful of numbers and
go into later plans as literals, so no join is needed to apply them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dec_to_double
from ..params import FEATURE_DIGITS
from .quantiles import exact_quantiles


SCALED = ("scaled_recency", "scaled_frequency", "scaled_net_monetary")


@dataclass(frozen=True)
class Caps:
    quantile: float | None
    frequency_cap: float | None
    net_monetary_cap: float | None


@dataclass(frozen=True)
class Scale:
    means: tuple[float, float, float]
    stds: tuple[float, float, float]


def net_double(df: DataFrame):
    return dec_to_double(F.col("net_monetary"))


def compute_caps(rfm: DataFrame, quantile: float | None) -> Caps:
    """Exact interpolated quantiles of frequency and net, by the distributed quantile operator."""
    if quantile is None:
        return Caps(None, None, None)
    long = rfm.select(
        F.inline(
            F.array(
                F.struct(F.lit("f").alias("metric"), F.col("frequency").cast("double").alias("v")),
                F.struct(F.lit("m").alias("metric"), net_double(rfm).alias("v")),
            )
        )
    )
    found = {r["metric"]: float(r["q"]) for r in exact_quantiles(long, ["metric"], "v", [quantile]).collect()}
    return Caps(quantile, found["f"], found["m"])


def apply_caps(rfm: DataFrame, caps: Caps) -> DataFrame:
    """Upper clip (no lower clip) and the capped flags, which compare the *uncapped* value."""
    f = F.col("frequency").cast("double")
    m = net_double(rfm)
    if caps.quantile is None:
        return rfm.withColumns(
            {
                "frequency_capped": f,
                "net_monetary_capped": m,
                "frequency_capped_flag": F.lit(False),
                "monetary_capped_flag": F.lit(False),
                "any_capped_flag": F.lit(False),
            }
        )
    fc, mc = F.lit(caps.frequency_cap), F.lit(caps.net_monetary_cap)
    return rfm.withColumns(
        {
            "frequency_capped": F.least(f, fc),
            "net_monetary_capped": F.least(m, mc),
            "frequency_capped_flag": f > fc,
            "monetary_capped_flag": m > mc,
            "any_capped_flag": (f > fc) | (m > mc),
        }
    )


SUM_DIGITS = 8  # places of the values that the variance is taken of; sums of their squares are exact


def compute_scale(df: DataFrame, values: Sequence[Column] | None = None) -> Scale:
    """Mean and population standard deviation of the given (double) features, by default the model's.

    Σx and Σx² are exact decimals (x to 8 places), so they do not depend on partitioning or row order, and the variance is
    (n·Σx² − (Σx)²) / n² in whole numbers: a spread far below the mean loses no digit. One conversion at the end."""
    values = values or model_features()
    fixed = [v.cast(f"decimal(18,{SUM_DIGITS})") for v in values]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[dec_to_double(F.sum(v.cast("decimal(38,10)"))).alias(f"m{i}") for i, v in enumerate(values)],
        *[F.sum(v).cast("string").alias(f"s{i}") for i, v in enumerate(fixed)],
        *[F.sum(v * v).cast("string").alias(f"q{i}") for i, v in enumerate(fixed)],
    ).first()
    n, count = row["n"], len(fixed)
    if not n:
        return Scale((0.0,) * count, (0.0,) * count)
    unit = 10**SUM_DIGITS
    whole = lambda text, scale: int(Decimal(text).scaleb(scale).to_integral_value())
    with localcontext() as exact:
        exact.prec = 120
        spread = [n * whole(row[f"q{i}"], 2 * SUM_DIGITS) - whole(row[f"s{i}"], SUM_DIGITS) ** 2 for i in range(count)]
    return Scale(tuple(row[f"m{i}"] / n for i in range(count)), tuple(math.sqrt(float(v)) / (n * float(unit)) for v in spread))


def model_features() -> list[Column]:
    return [F.col("recency").cast("double"), F.col("frequency_capped"), F.col("net_monetary_capped")]


def apply_scale(df: DataFrame, scale: Scale, values: Sequence[Column] | None = None) -> DataFrame:
    """z = (x − mean) / std_pop (std 0 → 1), rounded to 10 places so that the clustering
    input is the same in every engine and on every partitioning."""
    out = {}
    for name, c, mean, std in zip(SCALED, values or model_features(), scale.means, scale.stds, strict=True):
        divisor = std if std and std == std else 1.0
        out[name] = F.round((c - F.lit(float(mean))) / F.lit(float(divisor)), FEATURE_DIGITS)
    return df.withColumns(out)


# ---------------------------------------------------------------- alternatives to capping
def robust_scale(rfm: DataFrame) -> Scale:
    """Median and interquartile range of raw recency, frequency and net, as a Scale: exact distributed quantiles."""
    long = rfm.select(F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), v.alias("v")) for n, v in enumerate(raw_features())])))
    found = {(r["feature"], r["p"]): float(r["q"]) for r in exact_quantiles(long, ["feature"], "v", [0.25, 0.5, 0.75]).collect()}
    if not found:
        return Scale((0.0,) * 3, (0.0,) * 3)
    return Scale(tuple(found[n, 0.5] for n in range(3)), tuple(found[n, 0.75] - found[n, 0.25] for n in range(3)))


def raw_features() -> list[Column]:
    return [F.col("recency").cast("double"), F.col("frequency").cast("double"), dec_to_double(F.col("net_monetary"))]


def log_features() -> list[Column]:
    """ln(1 + x) of the raw features, rounded like every clustering input; for customers with a positive net value."""
    return [F.round(F.log(F.lit(1.0) + v), FEATURE_DIGITS) for v in raw_features()]


def non_finite_count(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Rows with NaN, ±inf or null in any of ``cols`` (K7)."""
    bad = None
    for c in cols:
        cond = F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
        bad = cond if bad is None else bad | cond
    return df.agg(F.count(F.when(bad, 1)).cast("bigint").alias("non_finite_rows"))
