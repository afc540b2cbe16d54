"""Which part of a span of time a set of half-open windows covers, and what is missing: gaps and islands.

Windows are cut at midnight and each day is worked out alone, so that days can go to different tasks; what touches across
midnight is joined again at the end, among the few stretches that are left.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import as_utc, ntz

START, END = "window_start", "window_end"
_DAY = "_day"
_ONE_DAY = "INTERVAL 1 DAY"


def _day_of(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def _by_day(windows: DataFrame, low: Column, high: Column) -> DataFrame:
    """The windows within [low, high), cut at midnight, with their day."""
    within = windows.select(F.greatest(START, low).alias(START), F.least(END, high).alias(END)).where(F.col(START) < F.col(END))
    # the last moment of a window, which is half-open, decides its last day
    last = _day_of(F.col(END) - F.expr("INTERVAL 0.000001 SECOND"))
    days = within.withColumn(_DAY, F.explode(F.sequence(_day_of(F.col(START)), last, F.expr(_ONE_DAY))))
    return days.select(
        _DAY,
        F.greatest(START, _DAY).alias(START),
        F.least(F.col(END), F.col(_DAY) + F.expr(_ONE_DAY)).alias(END),
    )


def islands(windows: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """What the windows cover of [start, end), as stretches that neither overlap nor touch."""
    low, high = ntz(as_utc(start)), ntz(as_utc(end))
    pieces = _by_day(windows, low, high).distinct()
    return _joined(_joined(pieces, [_DAY]).select(START, END), [])


def gaps(windows: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """What they leave out of [start, end)."""
    low, high = as_utc(start), as_utc(end)
    if low >= high:
        raise ValueError(f"empty span: {low} .. {high}")
    covered = islands(windows, low, high)
    spark = windows.sparkSession
    ends = spark.range(1).select(ntz(low).alias(START), ntz(low).alias(END)).union(
        spark.range(1).select(ntz(high).alias(START), ntz(high).alias(END))
    )
    order = Window.orderBy(START, END)  # stretches that do not touch: few, however many windows there were
    between = covered.union(ends).select(F.lag(END).over(order).alias(START), F.col(START).alias(END))
    return between.where(F.col(START) < F.col(END))


def _joined(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces that overlap or touch as one: a new stretch begins where a piece starts after all before it have ended."""
    order = Window.partitionBy(*keys).orderBy(START, END) if keys else Window.orderBy(START, END)
    reached = F.max(END).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = pieces.withColumn("_new", F.coalesce((F.col(START) > reached).cast("int"), F.lit(1)))
    numbered = opened.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min(START).alias(START), F.max(END).alias(END)).drop("_island")
