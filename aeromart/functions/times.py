"""Timestamps without a zone: parsing, hour windows and day predicates.

Every helper works on ``timestamp_ntz`` and never looks at the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: UTC times outside these days are taken for errors, which bounds the partitions that a load can touch.
FIRST_DAY, LAST_DAY = date(1970, 1, 1), date(2099, 12, 31)

_PLAIN = r"^[+-]?[\d-]+([T ][\d:.]*)?$"
_UTC = r"\d ?(Z|UTC|GMT)$"
_OFFSET = r"^[+-]?[\d-]+[T ][\d:.]+ ?([+-])(\d{1,2}):?(\d{2})?$"


def wall_clock(text: Column) -> Column:
    """ISO text to the wall clock it shows; an offset is dropped, bad text becomes NULL."""
    return text.try_cast("timestamp_ntz")


def utc_clock(text: Column) -> Column:
    """ISO text to the UTC wall clock; text without an offset is taken as UTC already.

    The name of a region is no offset: such text becomes NULL, rather than a wrong time.
    """
    minutes = (
        F.regexp_extract(text, _OFFSET, 2).try_cast("int") * 60
        + F.coalesce(F.regexp_extract(text, _OFFSET, 3).try_cast("int"), F.lit(0))
    )
    signed = F.when(F.regexp_extract(text, _OFFSET, 1) == "-", -minutes).otherwise(minutes)
    # "+00:00", the usual case, takes no pattern matching.
    return F.when(
        text.endswith("+00:00") | text.rlike(_UTC) | text.rlike(_PLAIN), wall_clock(text)
    ).otherwise(F.try_subtract(wall_clock(text), F.make_dt_interval(mins=signed)))


def hour_of(ts: Column) -> Column:
    """The start of the hour. ``date_trunc`` would pass through the session zone, which has no
    02:30 on one day of the year."""
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def previous_hour_of(as_of: Column) -> tuple[Column, Column]:
    """Start and (excluded) end of the last complete hour before ``as_of``."""
    end = hour_of(as_of)
    return end - F.expr("INTERVAL 1 HOUR"), end


def previous_hour(as_of: datetime) -> tuple[datetime, datetime]:
    end = as_of.replace(minute=0, second=0, microsecond=0)
    return end - timedelta(hours=1), end


def as_utc(bound: datetime | str) -> datetime:
    """A window bound as naive UTC: datetimes or ISO text, with an offset or without."""
    at = datetime.fromisoformat(bound.strip()) if isinstance(bound, str) else bound
    return at if at.tzinfo is None else at.astimezone(timezone.utc).replace(tzinfo=None)


def as_day(day: date | str) -> date:
    if isinstance(day, datetime):
        return as_utc(day).date()
    return day if isinstance(day, date) else date.fromisoformat(day.strip())


def ntz(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def in_window(ts: Column, start: datetime | str, end: datetime | str) -> Column:
    """Half-open ``[start, end)``, so that neighbouring windows neither overlap nor leave a gap."""
    low, high = as_utc(start), as_utc(end)
    if low >= high:
        raise ValueError(f"empty window: {low} .. {high}")
    return (ts >= ntz(low)) & (ts < ntz(high))


def in_days(
    df: DataFrame,
    start_day: date | str | None,
    end_day: date | str | None,
    ts: str = "date_utc",
    partition: str = "measure_date",
) -> DataFrame:
    """Rows of the days ``start_day .. end_day`` (both included).

    The bounds go on the timestamp, where Parquet statistics see them, and on the partition
    column too when the table has one: Spark does not derive one from the other.
    """
    for day, reached, shift in ((start_day, "__ge__", 0), (end_day, "__lt__", 1)):
        if day is None:
            continue
        bound = as_day(day) + timedelta(days=shift)
        df = df.where(getattr(F.col(ts), reached)(ntz(datetime.combine(bound, datetime.min.time()))))
        if partition in df.columns:
            df = df.where(getattr(F.col(partition), reached)(F.lit(bound)))
    return df
