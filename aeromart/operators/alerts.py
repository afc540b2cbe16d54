"""Daily above-average detection and the messages that report it.

One pass finds the alerts of any number of days and parameters: rows shrink to one (sum, count) per
country, day and parameter before the first shuffle, and the overall mean is a window over those.
Sums are exact decimals and means are compared crosswise, so that neither the order of the rows nor
rounding decides: equal values never alert, and a country alone on its day is never above itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import TOTAL, exact_sum, finite, greater_mean, mean
from ..functions.text import html_escape, name_list, text_key
from ..functions.times import in_days

_DAY_AND_PARAMETER = ("measure_date", "parameter_code")

# --- Fixed values: texts of the alert message. ---------------------------------------------------
SUBJECT = "[ALERT] Abnormal values on %s"
HEADING = "Countries with %s value above the daily average for (%s):"
COLUMN_TITLES = ("country_code", "date", "parameter_code", "avg")


def select_parameters(fact: DataFrame, parameters: str | Sequence[str] | None) -> DataFrame:
    """Rows of the listed parameters (case-sensitive), in one predicate instead of a loop."""
    if parameters is None:
        return fact
    return fact.where(F.col("parameter_code").isin(name_list(parameters)))


def country_partials(
    fact: DataFrame,
    start_day: date | str | None = None,
    end_day: date | str | None = None,
    parameters: str | Sequence[str] | None = None,
) -> DataFrame:
    """Sum and count of the values per country, day and parameter; NULL is a country of its own."""
    return _partials(select_parameters(in_days(fact, start_day, end_day), parameters))


def hourly_partials(fact: DataFrame) -> DataFrame:
    """The same per hour, which is what a load can bring up to date without reading the rest of the day."""
    return _partials(fact, F.hour("date_utc").alias("measure_hour"))


def _partials(fact: DataFrame, *more: Column) -> DataFrame:
    day = F.to_date("date_utc").alias("measure_date")
    rows = fact.select("country_code", day, *more, "parameter_code", finite(F.col("value")).alias("value"))
    return exact_sum(rows.groupBy(*[c for c in rows.columns if c != "value"]), "value", "value_sum", "value_count")


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partials of parts of a day, added up; sums are exact, so the parts do not matter."""
    return partials.groupBy("country_code", *_DAY_AND_PARAMETER).agg(
        F.sum("value_sum").cast(TOTAL).alias("value_sum"), F.sum("value_count").alias("value_count")
    )


def country_means(partials: DataFrame) -> DataFrame:
    return partials.select(
        "country_code",
        *_DAY_AND_PARAMETER,
        mean(F.col("value_sum"), F.col("value_count")).alias("avg_value"),
    )


def overall_means(partials: DataFrame) -> DataFrame:
    """Mean over all rows of a day and parameter, not the mean of the country means."""
    return partials.groupBy(*_DAY_AND_PARAMETER).agg(
        mean(F.sum("value_sum"), F.sum("value_count")).alias("base_value")
    )


def above_average(
    fact: DataFrame,
    start_day: date | str | None = None,
    end_day: date | str | None = None,
    parameters: str | Sequence[str] | None = None,
) -> DataFrame:
    """Countries whose daily mean is above (strictly) the overall daily mean, with both means."""
    return above_average_of(country_partials(fact, start_day, end_day, parameters))


def above_average_of(partials: DataFrame) -> DataFrame:
    """The same from the sums and counts of the countries, freshly made or stored."""
    day = Window.partitionBy(*_DAY_AND_PARAMETER)
    both = partials.select(
        "*", F.sum("value_sum").over(day).alias("base_sum"), F.sum("value_count").over(day).alias("base_count")
    )
    return both.where(_above()).select(
        "country_code",
        *_DAY_AND_PARAMETER,
        mean(F.col("value_sum"), F.col("value_count")).alias("avg_value"),
        mean(F.col("base_sum"), F.col("base_count")).alias("base_value"),
    )


def _above() -> Column:
    return greater_mean(F.col("value_sum"), F.col("value_count"), F.col("base_sum"), F.col("base_count"))


def above_average_of_day(
    fact: DataFrame,
    day: date | str | None = None,
    parameters: str | Sequence[str] | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """The same for one day, by default the newest one, without the overall mean.

    The newest day is a scalar subquery in the plan: on a partition column it prunes the folders when the query runs, and no
    driver action comes before. ``days`` (one column) says which days there are, for a fact that knows them without
    reading itself; else they are taken from the fact.
    """
    if day is None:
        own = F.col("measure_date") if "measure_date" in fact.columns else F.to_date("date_utc")
        known = fact.select(own.alias("day")) if days is None else days.toDF("day")
        fact = fact.where(own == known.agg(F.max("day")).scalar())
    return above_average(fact, day, day, parameters).drop("base_value")


def alert_outcomes(
    fact: DataFrame,
    start_day: date | str | None = None,
    end_day: date | str | None = None,
    parameters: str | Sequence[str] | None = None,
) -> DataFrame:
    """Per day and parameter with data: countries seen, alerts found, and whether to send."""
    day = Window.partitionBy(*_DAY_AND_PARAMETER)
    partials = country_partials(fact, start_day, end_day, parameters)
    both = partials.select(
        "*", F.sum("value_sum").over(day).alias("base_sum"), F.sum("value_count").over(day).alias("base_count")
    )
    alerts = F.count_if("_above")
    return (
        both.select(*_DAY_AND_PARAMETER, F.coalesce(_above(), F.lit(False)).alias("_above"))
        .groupBy(*_DAY_AND_PARAMETER)
        .agg(
            F.count(F.lit(1)).alias("countries"),
            alerts.alias("alerts"),
            (alerts > 0).alias("send"),
        )
    )


def _cell(text: Column, tag: str = "td") -> Column:
    return F.concat(F.lit(f"      <{tag}>"), html_escape(text), F.lit(f"</{tag}>\n"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """One message per day and parameter that has alerts: subject and HTML body.

    A message lists each country once, so what is gathered for it is bounded by the number of
    countries, however many measurements there are.
    """
    head = "".join(f"      <th>{title}</th>\n" for title in COLUMN_TITLES)

    def table_row(alert: Column) -> Column:
        return F.concat(
            F.lit("    <tr>\n"),
            _cell(F.coalesce(alert["country_code"].cast("string"), F.lit("None"))),
            _cell(F.col("measure_date").cast("string")),
            _cell(F.coalesce("parameter_code", F.lit("None"))),
            _cell(F.format_string("%.6f", alert["avg_value"])),
            F.lit("    </tr>\n"),
        )

    grouped = alerts.groupBy(*_DAY_AND_PARAMETER).agg(
        F.array_sort(F.collect_list(F.struct("country_code", "avg_value"))).alias("found")
    )
    parameter = F.coalesce("parameter_code", F.lit("None"))
    heading = F.format_string(HEADING, html_escape(parameter), F.col("measure_date").cast("string"))
    return grouped.select(
        *_DAY_AND_PARAMETER,
        F.size("found").alias("countries"),
        F.array_join(
            F.transform("found", lambda alert: alert["country_code"].cast("string")), ", ", "None"
        ).alias("country_list"),
        F.format_string(SUBJECT, parameter).alias("subject"),
        F.concat(
            F.lit("<html><head></head><body>\n<p>"),
            heading,
            F.lit(
                '</p>\n<table border="1" class="dataframe">\n  <thead>\n    <tr>\n'
                + head
                + "    </tr>\n  </thead>\n  <tbody>\n"
            ),
            F.array_join(F.transform("found", table_row), ""),
            F.lit("  </tbody>\n</table>\n</body></html>"),
        ).alias("body"),
    )


def address(messages: DataFrame, recipients: str | Sequence[str]) -> DataFrame:
    """One row per message and recipient, with an id that is the same in every run.

    Empty items and repeated ones do not count; without any recipient the call is refused, as every alert would be lost.
    """
    names = [r for r in dict.fromkeys(name_list(recipients)) if r]
    if not names:
        raise ValueError("no recipients")
    people = F.explode(F.array(*[F.lit(r) for r in names]))
    return addressed_to(messages.withColumn("recipient", people))


def addressed_to(messages: DataFrame) -> DataFrame:
    """Messages that have a ``recipient``, with their ids."""
    return messages.withColumn(
        "alert_id",
        F.sha2(text_key(F.col("measure_date"), F.col("parameter_code"), F.col("recipient")), 256),
    )


def not_yet_sent(addressed: DataFrame, sent: DataFrame) -> DataFrame:
    """Drop what the log ``sent`` lists by ``alert_id``, so that a retry sends nothing twice."""
    return addressed.join(sent.select("alert_id").distinct(), "alert_id", "left_anti")
