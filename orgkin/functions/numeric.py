"""Rounding that agrees with IEEE round-half-even on the exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgkin.functions.text import _col

_SPLIT = float(2**27 + 1)  # splits a double into two halves whose products are exact


def round_exact(c: Column | str, digits: int) -> Column:
    """Round the exact value of a double (half to even), unlike SQL ``round``.

    SQL engines round the shortest decimal text or a rescaled product, which moves
    weighted sums that sit on a decimal tie. Here the scaling error is recovered
    exactly, so a score lands on the same side of its tie everywhere. Valid while
    |value| * 10**digits stays below 2**52.
    """
    x = _col(c).cast("double")
    scale = F.lit(float(10**digits))
    high = x * F.lit(_SPLIT) - (x * F.lit(_SPLIT) - x)
    low = x - high
    product = x * scale
    error = (high * scale - product) + low * scale
    whole = F.floor(product).cast("double")
    beyond = (product - whole - F.lit(0.5)) + error
    up = (beyond > 0) | ((beyond == 0) & (F.pmod(whole, F.lit(2.0)) == 1))
    return (whole + F.when(up, 1.0).otherwise(0.0)) / scale


def percent(c: Column | str) -> Column:
    """Whole-number percent of a 0..1 score, half up, for display."""
    return F.floor(_col(c) * 100 + F.lit(0.5)).cast("long")
