"""The fact with its dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum, finite, mean
from ..functions.text import name_list
from ..functions.times import in_days


def _location_side(dim_location: DataFrame) -> DataFrame:
    return dim_location.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        "city",
        "country_name",
    )


def _parameter_side(dim_parameter: DataFrame) -> DataFrame:
    return dim_parameter.select(
        F.col("code").alias("parameter_code"),
        F.col("displayname").alias("parameter_name"),
        "preferredunit",
    )


def star_join(fact: DataFrame, dim_location: DataFrame, dim_parameter: DataFrame) -> DataFrame:
    """Every measurement with its location and parameter; unknown ones get NULLs.

    No broadcast is forced. Spark replicates a dimension while it is below its broadcast limit;
    beyond it, it shuffles both sides and AQE splits hot locations.
    """
    return fact.join(_location_side(dim_location), "location_id", "left").join(
        _parameter_side(dim_parameter), "parameter_code", "left"
    )


def mean_by_country_and_parameter(
    fact: DataFrame, dim_location: DataFrame, dim_parameter: DataFrame
) -> DataFrame:
    """Count and mean per country name and parameter name.

    Measurements are summed per location and parameter before they meet the dimensions, so the
    joins see one row per pair and a hot location is no longer hot.
    """
    rows = fact.select("location_id", "parameter_code", finite(F.col("value")).alias("value"))
    partials = exact_sum(
        rows.groupBy("location_id", "parameter_code"), "value", "_sum", "_count", F.count(F.lit(1)).alias("_rows")
    )
    return (
        star_join(partials, dim_location, dim_parameter)
        .groupBy("country_name", "parameter_name")
        .agg(
            F.sum("_rows").alias("measurements"),
            mean(F.sum("_sum"), F.sum("_count")).alias("avg_value"),
        )
    )


def _listed(column: str, names: str | Sequence[str] | None) -> Column:
    return F.lit(True) if names is None else F.col(column).isin(name_list(names))


def star_slice(
    fact: DataFrame,
    dim_location: DataFrame,
    dim_parameter: DataFrame,
    city: str | Sequence[str] | None = None,
    country: str | Sequence[str] | None = None,
    parameter: str | Sequence[str] | None = None,
    days: DataFrame | None = None,
    start_day: date | str | None = None,
    end_day: date | str | None = None,
) -> DataFrame:
    """The part of the star that filters on its dimensions ask for: cities, names of countries, codes of parameters, days.

    ``days`` is a frame with ``measure_date``, a filtered calendar say. Every filter reaches the scan of the fact. Days, given as bounds or
    as a frame, prune its folders (the frame when the query runs, from the rows it has then). Parameters are a filter on
    the fact's own column. Cities and countries leave some locations: the smallest and the largest of them bound the
    column in the scan, which skips row groups, and the join beyond that is Spark's choice (a broadcast, or a shuffle with a
    runtime Bloom filter where the fact is large). Locations and parameters without a dimension row are left out only by a filter on them.
    """
    rows = in_days(fact, start_day, end_day).where(_listed("parameter_code", parameter))
    if days is not None:
        rows = rows.join(days.select("measure_date").distinct(), "measure_date", "left_semi")
    locations = _location_side(dim_location)
    chosen = city is not None or country is not None
    if chosen:
        locations = locations.where(_listed("city", city) & _listed("country_name", country))
        low, high = (locations.agg(bound("location_id")).scalar() for bound in (F.min, F.max))
        rows = rows.where((F.col("location_id") >= low) & (F.col("location_id") <= high))
    joined = rows.join(locations, "location_id", "inner" if chosen else "left")
    parameters = _parameter_side(dim_parameter).where(_listed("parameter_code", parameter))
    return joined.join(parameters, "parameter_code", "left")


def calendar(days: DataFrame) -> DataFrame:
    """Days (``measure_date``) with what calendars are filtered by: weekday from 1 (Monday), ISO week, month, quarter, year."""
    day = F.col("measure_date")
    return days.select(
        day,
        (F.weekday(day) + 1).alias("weekday"),
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    )
