"""The four extracts: bodies to typed staging rows.

Each returns every element and whether it is ``_ok``; ``good`` and ``quarantined`` tell them apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.times import FIRST_DAY, LAST_DAY, in_window, ntz
from ..operators.flatten import flatten
from ..operators.validate import OK, REASONS, apply_rules
from .envelope import ELEMENT, PROBLEM, RAW, elements


def extract(
    bodies: DataFrame,
    element_schema: str,
    rules: tuple[S.Rule, ...],
    in_bytes: bool = False,
    fail_fast: bool = False,
    spread: bool = False,
    keep: tuple[str, ...] = (),
    earliest: date = FIRST_DAY,
    latest: date = LAST_DAY,
) -> DataFrame:
    """Staging rows plus ``_ok`` and, for rows that are not, ``_reasons`` and the ``_raw`` text; columns of the bodies to ``keep`` come last."""
    found = elements(bodies, element_schema, fail_fast, spread, keep)
    origin = (ELEMENT, PROBLEM, RAW, *keep)
    flat = flatten(found.select(*origin, f"{ELEMENT}.*"), lower=True, keep=origin)
    checked = apply_rules(flat, rules, origin, in_bytes, earliest, latest)
    ok = F.col(PROBLEM).isNull() & F.col(OK)
    rows = checked.select(
        *[r.name for r in rules],
        ok.alias(OK),
        F.coalesce(PROBLEM, REASONS).alias(REASONS),
        F.when(~ok, F.coalesce(F.col(RAW), F.to_json(ELEMENT))).alias(RAW),
        *keep,
    )
    # A generator, which filters stay above: below, they would work out all casts and checks a second time, in one method that is
    # too long for the JVM to compile.
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def good(extracted: DataFrame) -> DataFrame:
    return extracted.where(OK).drop(OK, REASONS, RAW)


def quarantined(extracted: DataFrame) -> DataFrame:
    return extracted.where(~F.col(OK)).drop(OK)


def extract_locations(bodies: DataFrame, **options) -> DataFrame:
    return extract(bodies, S.LOCATIONS_ELEMENT, S.STG_LOCATIONS, **options)


def extract_countries(bodies: DataFrame, **options) -> DataFrame:
    return extract(bodies, S.COUNTRIES_ELEMENT, S.STG_COUNTRIES, **options)


def extract_parameters(bodies: DataFrame, **options) -> DataFrame:
    return extract(bodies, S.PARAMETERS_ELEMENT, S.STG_PARAMETERS, **options)


def extract_measurements(
    bodies: DataFrame,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    rules: tuple[S.Rule, ...] = S.STG_MEASUREMENTS,
    **options,
) -> DataFrame:
    """Measurements of ``[start, end)``; rows in quarantine stay, whatever their time."""
    rows = extract(bodies, S.MEASUREMENTS_ELEMENT, rules, **options)
    if start is None and end is None:
        return rows
    inside = in_window(F.col("date_utc"), start or datetime.min, end or datetime.max)
    return rows.where(inside | ~F.col(OK))


def within(extracted: DataFrame, windows: Sequence[tuple[datetime, datetime]]) -> DataFrame:
    """Measurements of any of the half-open windows; rows in quarantine stay. One literal list, however many windows."""
    listed = F.array(*[F.struct(ntz(low).alias("low"), ntz(high).alias("high")) for low, high in windows])
    ts = F.col("date_utc")
    first, last = min(low for low, _ in windows), max(high for _, high in windows)
    inside = in_window(ts, first, last) & F.exists(listed, lambda w: (ts >= w["low"]) & (ts < w["high"]))
    return extracted.where(inside | ~F.col(OK))
