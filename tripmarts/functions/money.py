"""Sums and means of amounts that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNTS = ("fare_amount", "total_revenue")
# Decimals that hold an amount exactly: the usual ones in one machine word, others in a wide one.
NARROW, WIDE = "decimal(18,4)", "decimal(27,9)"
# A double within so much of a decimal stands for it: the last digits of a product or sum.
NOISE = 1e-15


def amount_sum(name: str) -> Column:
    """Sum of an amount as a double; NULL without amounts.

    Amounts of up to nine decimals below 1e18 are summed as decimals, so exactly and in any order. What
    no decimal holds (more decimals, larger amounts, NaN, infinities) is added as doubles: NaN and
    infinities show in the result as in a plain sum.
    """
    value = F.col(name).cast("double")
    narrow, wide = F.col(name).try_cast(NARROW), F.col(name).try_cast(WIDE)
    near = F.abs(value) * NOISE
    in_narrow, in_wide = (F.coalesce(F.abs(x.cast("double") - value) <= near, F.lit(False)) for x in (narrow, wide))
    whole = [F.sum(F.when(in_narrow, narrow)), F.sum(F.when(~in_narrow & in_wide, wide))]
    first, second = (F.coalesce(part, F.lit(0).cast("decimal(1,0)")) for part in whole)
    rest = F.coalesce(F.sum(F.when(~in_narrow & ~in_wide, value)), F.lit(0.0))
    return F.when(F.count(name) > 0, (first + second).cast("double") + rest)


def amount_mean(name: str) -> Column:
    """Mean of all amounts that are not NULL; NaN or infinite where one of them is."""
    return F.try_divide(amount_sum(name), F.count(name))
