"""Means and rounding that do not depend on the order rows arrive in.

Sums of doubles differ in their last bits from run to run, which would break ties before a ranking. Here each value is
taken apart into five whole numbers: its whole part above and below 2^28, and three times 28 bits behind the point.
Each is added in a long counter, exactly and in any order, for up to 2^35 rows of a group; the counters meet in two
decimals at the end. Values are so kept to 2^-84. There is no other way for small or large ones; only infinite values,
NaN and values from 2^90, whose whole part fits no counter, are added as doubles and make the mean what doubles make it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = 1e9
_STEP = float(1 << 28)
_MOST = float(1 << 90)
PARTS = ("high", "behind0", "behind1", "behind2", "behind3", "large", "value")


def settle(c: Column) -> Column:
    """Double kept to nine decimals, so mathematically equal scores compare equal."""
    return F.rint(c * F.lit(_UNITS)) / F.lit(_UNITS)


def round6(c: Column) -> Column:
    return F.rint(c * F.lit(1e6)) / F.lit(1e6)


def parts(c: Column) -> dict[str, Column]:
    """What `mean_of` adds up of one value: the five whole numbers, values too large for them, and the value itself."""
    x = c.cast("double")
    fits = F.abs(x) < F.lit(_MOST)
    size, sign = F.when(fits, F.abs(x)), F.when(x < 0, -1).otherwise(1)
    # multiples of powers of two and remainders are exact, so each part comes from the value itself
    behind = lambda k: sign * F.floor((size * F.lit(_STEP ** k)) % F.lit(_STEP))
    return {"high": sign * F.floor(size / F.lit(_STEP)), **{f"behind{k}": behind(k) for k in range(4)},
            "large": F.when(~fits, x), "value": x}


def mean_of(added: Mapping[str, Column]) -> Column:
    """Mean as a double, from the `parts` of each value; NULL when nothing was counted."""
    counter = lambda name: F.coalesce(F.sum(added[name]), F.lit(0)).cast("decimal(19,0)")
    step = F.lit(1 << 28).cast("decimal(9,0)")
    joined = lambda a, b: (a * step + b).cast("decimal(38,0)")
    whole = joined(counter("high"), counter("behind0"))
    fraction = joined(joined(counter("behind1"), counter("behind2")).cast("decimal(28,0)"), counter("behind3"))
    total = whole.cast("double") + fraction.cast("double") / F.lit(_STEP ** 3)
    large = F.coalesce(F.sum(added["large"]), F.lit(0.0))
    return F.try_divide(total + large, F.count(added["value"]))


def mean(c: Column) -> Column:
    """Mean as a double; NULL when nothing was counted."""
    return mean_of(parts(c))
