"""Rounding of doubles by their exact binary value, ties to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Below this size a product is off by less than 2 ** -13, so a distance from the next whole number under NO_TIE is under a half.
PLAIN_SIZE, NO_TIE = 2.0**40, 0.4997


def round_exact(x: Column, digits: int) -> Column:
    """``x`` to ``digits`` decimals: 2.675 is a little less than it looks and becomes 2.67, 0.125 becomes 0.12.

    Numbers that are not near a tie are rounded by arithmetic: the division of two whole doubles gives the double nearest to the
    decimal. The others go through a number format, which rounds by the binary value, unlike ``round``, which goes by the shortest
    decimal text. NULL and NaN stay, an infinite number becomes NULL. ``x`` is named only once, as the one element of an array, so long
    expressions don't grow; Spark also leaves a projection with such a lambda out of whole-stage code, which would put the whole
    decision layer into one method of more than the 8,000 bytes that the JVM compiles.
    """

    def rounded(v: Column) -> Column:
        scaled = v * F.lit(10.0**digits)
        nearest = F.rint(scaled)
        plain = (F.abs(scaled) < PLAIN_SIZE) & (F.abs(scaled - nearest) < NO_TIE)
        by_format = F.replace(F.format_number(v, digits), F.lit(","), F.lit("")).try_cast("double")
        return F.when(plain, nearest / F.lit(10.0**digits)).otherwise(by_format)

    return F.get(F.transform(F.array(x), rounded), F.lit(0))
