"""Text columns to typed columns, with a reason for every value that does not fit."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import LIMIT
from ..functions.times import FIRST_DAY, LAST_DAY, utc_clock
from ..schemas import Rule

# Whether all checks passed, and the reasons as text. The flag is a column of its own because a
# filter on the text would build that text for every row.
OK = "_ok"
REASONS = "_reasons"
SEPARATOR = "; "


def typed(text: Column, rule: Rule) -> Column:
    if rule.type == "utc":
        return utc_clock(text)
    return text if rule.type == "string" else text.try_cast(rule.type)


def problems(
    text: Column, rule: Rule, in_bytes: bool = False, earliest: date = FIRST_DAY, latest: date = LAST_DAY
) -> Iterable[Column]:
    """NULL or a reason, one column per check that applies to the rule."""
    if rule.required:
        yield F.when(text.isNull(), F.lit(f"{rule.name}: missing"))
    if rule.type != "string":
        yield F.when(
            text.isNotNull() & typed(text, rule).isNull(),
            F.lit(f"{rule.name}: not a {rule.sql_type}"),
        )
    if rule.type == "double":
        value = typed(text, rule)
        finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
        yield F.when(~finite, F.lit(f"{rule.name}: not finite"))
        if rule.required:
            yield F.when(finite & (F.abs(value) >= LIMIT), F.lit(f"{rule.name}: out of range"))
    if rule.type == "utc" and rule.required:
        day = typed(text, rule).cast("date")
        outside = (day < F.lit(earliest)) | (day > F.lit(latest))
        yield F.when(outside, F.lit(f"{rule.name}: not between {earliest} and {latest}"))
    if rule.max_length is not None:
        length = F.octet_length(text) if in_bytes else F.char_length(text)
        yield F.when(
            length > rule.max_length, F.lit(f"{rule.name}: longer than {rule.max_length}")
        )


def apply_rules(
    df: DataFrame,
    rules: tuple[Rule, ...],
    keep: tuple[str, ...] = (),
    in_bytes: bool = False,
    earliest: date = FIRST_DAY,
    latest: date = LAST_DAY,
) -> DataFrame:
    """Cast every ruled column and add ``_ok`` and ``_reasons``; no row is dropped.

    Missing columns become NULL. ``in_bytes`` counts text limits in bytes instead of characters.
    UTC times outside the days ``earliest .. latest`` are bad, which bounds the partitions that a load can touch.
    """
    present = {c.lower() for c in df.columns}

    def text(rule: Rule) -> Column:
        return F.col(rule.name).cast("string") if rule.name in present else F.lit(None).cast("string")

    checks = [reason for rule in rules for reason in problems(text(rule), rule, in_bytes, earliest, latest)]
    ok = reduce(and_, [check.isNull() for check in checks], F.lit(True))
    return df.select(
        *keep,
        *[typed(text(rule), rule).cast(rule.sql_type).alias(rule.name) for rule in rules],
        ok.alias(OK),
        F.when(~ok, F.concat_ws(SEPARATOR, *checks)).alias(REASONS),
    )
