"""Scoring customers with stored model parameters (caps, scaler, centres, segment names)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import Caps, Scale, apply_caps, apply_scale
from .model import labels_for
from .segments import code_expr


def score(rfm: DataFrame, params: dict) -> DataFrame:
    """Apply stored caps and z-scores, then the nearest stored centre and its segment.

    The parameters are k rows (bounded by the model), so they enter the plan as literals:
    scoring is a single map over the customers, with no join and no shuffle."""
    caps = Caps(params["cap_quantile"], params["frequency_cap"], params["net_monetary_cap"])
    scale = Scale(tuple(params["means"]), tuple(params["stds"]))
    scaled = apply_scale(apply_caps(rfm, caps), scale)
    label, dist = labels_for(params["centres"])
    return scaled.withColumns({"raw_cluster": label, "centroid_distance": dist}).withColumn(
        "segment_code", code_expr(F.col("raw_cluster"), params["mapping"])
    )
