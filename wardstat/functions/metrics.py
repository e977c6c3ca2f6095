"""Arithmetic shared by the gold and serving metrics."""

from functools import reduce
from operator import add

from pyspark.sql import functions as F

DECIMALS = 2
# Parts of one that sums keep, and bits of the lower half of such a sum.
UNIT = 1e6
HALF = 24


def zero_if_null(col):
    return F.coalesce(col, F.lit(0.0))


def null_safe_sum(*cols):
    """Row total with null counted as 0; never null."""
    return reduce(add, [zero_if_null(F.col(c)) for c in cols])


def guarded_ratio(numerator, denominator, scale=None):
    """Rounded ratio. A denominator that is null, 0 or negative gives 0; a null
    numerator over a good denominator stays null."""
    ratio = F.col(numerator) / F.col(denominator)
    if scale is not None:
        ratio = ratio * F.lit(scale)
    return F.round(F.when(F.col(denominator) > 0, ratio).otherwise(0.0), DECIMALS)


def mean_of_present(*cols):
    """Row mean over the non-null columns, null when there are none."""
    present = reduce(add, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.round(F.try_divide(null_safe_sum(*cols), present), DECIMALS)


def _value(name):
    return F.col(name) if isinstance(name, str) else name


def exact_sum(name):
    """Aggregate: sum to six decimals, the same for every order of the rows.

    Doubles summed as they come give a last digit that depends on the tasks.
    Whole millionths do not; published hours and rounded ratios have two
    decimals. They are added up in two halves, so that a total of any size is
    exact. Values that are no such number, beyond nine million million or not
    finite, are added as doubles: a NaN or an infinity shows in the result. So
    does, as NaN, a total that even the halves cannot hold. Null only if there is
    no value.
    """
    value = _value(name)
    units = F.rint(value * F.lit(UNIT)).try_cast("bigint")
    high = F.try_sum(F.shiftright(units, HALF))
    low = F.try_sum(units.bitwiseAND(F.lit((1 << HALF) - 1)))
    whole = high.cast("decimal(20,0)") * F.lit(1 << HALF).cast("decimal(9,0)") + low.cast("decimal(20,0)")
    held = F.when(high.isNull() == low.isNull(), whole.cast("double") / F.lit(UNIT)).otherwise(float("nan"))
    rest = F.sum(F.when(units.isNull(), value))
    return F.coalesce(held + rest, held, rest)


def exact_mean(name):
    """Aggregate: mean of the values that ``exact_sum`` sums, null without any."""
    return F.try_divide(exact_sum(name), F.count(_value(name)))
