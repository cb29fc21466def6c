"""Percentages rounded half-up to two places, and exact means of such percentages.

A percentage is a double rounded once, as a Spark user would write it. A mean of
rounded percentages is taken over whole hundredths instead: summing doubles gives
a result that depends on the order in which tasks finish, and every second mean
of an even number of rows sits on a rounding tie.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole, two places; null where whole is 0 or null."""
    return F.round(F.try_divide(part, whole) * 100, 2)


def growth_percent(value: Column, base: Column) -> Column:
    """Relative change from base to value in percent, two places."""
    return percent_of(value - base, base)


def hundredths(percent: Column) -> Column:
    """A two-place percentage as a whole number of hundredths."""
    return F.round(percent * 100).cast("long")


def mean_of_hundredths(total: Column, count: Column) -> Column:
    """total / count hundredths as a percentage, rounded half away from zero.

    Whole-number arithmetic throughout; null where count is 0.
    """
    count = F.nullif(count, F.lit(0))
    magnitude = F.call_function("div", F.abs(total) * 2 + count, count * 2)
    return F.when(total < 0, -magnitude).otherwise(magnitude) / F.lit(100.0)
