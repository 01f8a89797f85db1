"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(x: Column, digits: int) -> Column:
    """``x`` rounded to ``digits`` decimals as ``round(x * 10^d) / 10^d``.

    Rounding to an integer is exact and identical in every engine (the half
    points are representable), so this form gives bit-identical results
    wherever the same double goes in - unlike rounding on the decimal text of
    the double, which can differ at half points.
    """
    scale = float(10 ** digits)
    return F.round(x * F.lit(scale)) / F.lit(scale)

