"""Order-independent averages of doubles.

A value below ``LIMIT`` that is a multiple of 2**-60 (every double from 2**-8 on is, and so is every short decimal
in that range) is three integers of at most 24 bits: x = a * 2**-12 + b * 2**-36 + c * 2**-60.  Sums of integers
are the same in any order and fit 64 bits for 2**39 rows, so such an average does not change with the partitioning, and its
sum is rounded once.

Every other value (large, infinite, or with finer bits) is summed as a plain double, as ``avg`` does: nothing is
rounded, cut off or saturated, and the last bits may depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT = float(1 << 12)
UNIT = float(1 << 60)
PARTS = ("a", "b", "c", "rest")


def not_nan(col: Column) -> Column:
    """NaN counts as missing."""
    x = col.cast("double")
    return F.when(~F.isnan(x), x)


def split(col: Column) -> dict[str, Column]:
    """The three integers of a value, or the value itself as ``rest``."""
    x = not_nan(col)
    fits = (F.abs(x) < LIMIT) & (F.rint(x * UNIT) == x * UNIT)
    scaled = x * F.lit(float(1 << 12))
    a = F.floor(scaled)
    next_ = (scaled - a.cast("double")) * F.lit(float(1 << 24))
    b = F.floor(next_)
    c = F.floor((next_ - b.cast("double")) * F.lit(float(1 << 24)))
    return {"a": F.when(fits, a), "b": F.when(fits, b), "c": F.when(fits, c), "rest": F.when(~fits, x)}


def mean(sums: dict[str, Column], n: Column) -> Column:
    """Average from the sums of the parts and the number of values; NULL without values."""
    def whole(name: str) -> Column:
        return F.coalesce(sums[name], F.lit(0)).cast("decimal(20,0)")

    total = (whole("a") * F.lit(1 << 48).cast("decimal(15,0)") + whole("b") * F.lit(1 << 24).cast("decimal(8,0)")
             + whole("c"))
    return F.when(n > 0, F.try_divide(total.cast("double") / F.lit(UNIT) + F.coalesce(sums["rest"], F.lit(0.0)),
                                      n.cast("double")))


def exact_avg(col: Column) -> Column:
    return mean({k: F.sum(v) for k, v in split(col).items()}, F.count(not_nan(col)))
