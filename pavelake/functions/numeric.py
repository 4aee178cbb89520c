"""Rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round to the nearest integer with ties to even, scale back: array-library rounding.

    ``bround`` goes through the decimal text of the number and so differs from it on values such
    as 0.575, whose product with 100 lies just below the tie.
    """
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)
