"""Sums and means that do not depend on the order of the rows.

A double sum changes in its last digits with the layout of the data, so that a tie could flip. Values are therefore
rounded to nine places and added up as two whole numbers, their whole part and the billionths above it: exact whatever the
order, and as fast as any sum of longs. Decimals are made of the sums only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

#: Values must be below this in size; a load quarantines others.
LIMIT = 1e9
TOTAL = "decimal(28,9)"
_COUNT = "decimal(12,0)"


def finite(value: Column) -> Column:
    """NaN counts as missing, as NULL does; a value out of range is an error."""
    value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    message = F.concat(F.lit("value out of range: "), value.cast("string"))
    return F.when(F.abs(value) >= LIMIT, F.raise_error(message).cast("double")).otherwise(value)


def exact_sum(grouped: GroupedData, value: str, total: str, count: str, *more: Column) -> DataFrame:
    """The groups with the exact sum (a decimal of nine places) and the count of ``value``, a column that is ``finite``."""
    whole = F.floor(value)
    billionths = F.rint((F.col(value) - whole) * 1e9).cast("bigint")
    made = grouped.agg(F.sum(whole).alias("_whole"), F.sum(billionths).alias("_above"), F.count(value).alias(count), *more)
    units = F.col("_whole").cast("decimal(19,0)") * F.lit(1_000_000_000) + F.col("_above").cast("decimal(19,0)")
    exact = units.cast("decimal(28,0)") * F.expr("0.000000001BD")
    return made.withColumn(total, exact.cast(TOTAL)).drop("_whole", "_above")


def mean(total: Column, count: Column) -> Column:
    """The mean as a double, from an exact sum."""
    return F.try_divide(total, count.cast(_COUNT)).cast("double")


def greater_mean(total: Column, count: Column, other_total: Column, other_count: Column) -> Column:
    """Whether ``total / count`` is above ``other_total / other_count``, without a rounded division.

    Whole parts first, then the remainders crosswise: both products fit a decimal of 38 digits.
    """
    def parts(t: Column, n: Column) -> tuple[Column, Column]:
        t = t.cast("decimal(30,9)")
        whole = F.floor(F.try_divide(t, n.cast(_COUNT)))
        rest = t - whole.cast("decimal(12,0)") * n.cast(_COUNT)
        # a quotient that was rounded up to a whole number leaves a negative rest
        short = rest < 0
        return (
            F.when(short, whole - 1).otherwise(whole),
            F.when(short, rest + n.cast(_COUNT)).otherwise(rest).cast("decimal(21,9)"),
        )

    whole, rest = parts(total, count)
    other_whole, other_rest = parts(other_total, other_count)
    higher = rest * other_count.cast(_COUNT) > other_rest * count.cast(_COUNT)
    return (whole > other_whole) | ((whole == other_whole) & higher)
