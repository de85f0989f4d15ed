"""Numeric expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DISTANCE_DIGITS, MONEY_SQL_TYPE


def money(c: Column) -> Column:
    """Money is summed as a decimal so totals do not depend on summation order."""
    return c.cast(MONEY_SQL_TYPE)






def squared_distance(point: Sequence[Column], centre: Sequence[Column | float]) -> Column:
    """Squared Euclidean distance, rounded so near-ties break the same way everywhere."""
    terms = None
    for p, c in zip(point, centre, strict=True):
        c_col = c if isinstance(c, Column) else F.lit(float(c))
        d = p - c_col
        term = d * d
        terms = term if terms is None else terms + term
    return F.round(terms, DISTANCE_DIGITS)


def nearest_centre(point: Sequence[Column], centres: Sequence[Sequence[float]]) -> tuple[Column, Column]:
    """(label, squared distance) of the nearest of literal centres; ties go to the lower label.

    ``array_min`` over (distance, label) structs compares the distance first and the label
    second, so the whole arg-min stays one codegen expression.
    """
    pairs = [
        F.struct(squared_distance(point, c).alias("d2"), F.lit(i).alias("label"))
        for i, c in enumerate(centres)
    ]
    best = F.array_min(F.array(*pairs))
    return best["label"], best["d2"]




def dec_to_double(c: Column) -> Column:
    """Decimal → double through its text form: correctly rounded, the same in every engine."""
    return c.cast("string").cast("double")
