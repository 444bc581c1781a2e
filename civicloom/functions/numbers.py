"""Number formats and relative bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(value: Column) -> Column:
    """``1234567`` as ``1,234,567``."""
    return F.format_number(value, 0)


def percent_1dp(value: Column) -> Column:
    """``12.5%``: one decimal of the exact binary value, true ties to the even digit.

    Spark's own ``round``, ``bround`` and ``format_string`` round the shortest decimal text
    of a double instead, which turns 0.05 (in binary a little above) the wrong way.
    The double is compared with the midpoint of the two candidates; only where it equals the
    midpoint's nearest double does the sign of ``20 * value - (2 * below + 1)`` decide, and
    that is worked out without error on the two halves of the double.
    """
    size = F.abs(value.cast("double"))
    below = F.floor(size * 10)
    odd = (below * 2 + 1).cast("double")
    midpoint = odd / 20.0
    high = size.cast("float").cast("double")
    rest = (high * 20.0 - odd) + (size - high) * 20.0
    step = (
        F.when(size > midpoint, 1)
        .when(size < midpoint, 0)
        .when(rest > 0, 1)
        .when(rest < 0, 0)
        .otherwise(below % 2)
    )
    tenths = below + step
    digits = F.concat(
        (F.floor(tenths / 10)).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%")
    )
    return F.when(value < 0, F.concat(F.lit("-"), digits)).otherwise(digits)


def relative_bin(value: Column, largest: Column, cuts: Sequence[float]) -> Column:
    """0 for zero, then 1, 2, ... by strict ``<`` against shares of the largest value; null for null."""
    bins = F.when(value.isNull(), F.lit(None).cast("int")).when(value == 0, 0)
    for number, cut in enumerate(cuts, 1):
        bins = bins.when(value < largest * F.lit(cut), number)
    return bins.otherwise(len(cuts) + 1).cast("int")
