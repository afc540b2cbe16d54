"""Saved API responses: one JSON object per body, its rows in the list ``results``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BODY = "body"
ELEMENT = "_element"
PROBLEM = "_problem"
RAW = "_raw"

# Why a body or one of its elements cannot be read.
UNPARSABLE = "unparsable body"
NO_RESULTS = "no results list"
NOT_AN_OBJECT = "element is not an object"

_CORRUPT = "_corrupt_record"


def read_bodies(
    spark: SparkSession, path: str | list[str], whole_files: bool = False
) -> DataFrame:
    """One body per line (files are split across tasks), or per file for pretty-printed bodies."""
    lines = spark.read.text(path, wholetext=whole_files)
    return lines.where(F.trim("value") != "").select(F.col("value").alias(BODY))


def _parse(text: Column, schema: str) -> Column:
    return F.from_json(
        text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )


def elements(
    bodies: DataFrame, element_schema: str, fail_fast: bool = False, spread: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per element: ``_element``, ``_problem`` (NULL when readable) and ``_raw`` (its text
    when not). A body that cannot be read at all is one row of its own; an empty list is no row. The columns ``keep`` of the
    bodies stay with their elements.

    Bodies are parsed once with the element type. Only where that fails is the list parsed again
    as raw texts, so that one bad element does not take its neighbours along.

    With ``spread``, bodies are only cut into the texts of their elements where they are read. These are dealt evenly over tasks, by
    their size, and typed there: one huge body, which cannot be read in parts, is then no longer one task to the end.
    """
    if spread:
        return _checked(_spread_elements(bodies, element_schema, keep), fail_fast)
    strict = _parse(F.col(BODY), f"results array<{element_schema}>, {_CORRUPT} string")
    by_text = _parse(F.col(BODY), f"results array<string>, {_CORRUPT} string")
    item_type = f"array<struct<{ELEMENT}: {element_schema}, {PROBLEM}: string, {RAW}: string>>"

    def item(element: Column | None, problem: Column | None, raw: Column | None) -> Column:
        return F.struct(
            (F.lit(None).cast(element_schema) if element is None else element).alias(ELEMENT),
            (F.lit(None).cast("string") if problem is None else problem).alias(PROBLEM),
            (F.lit(None).cast("string") if raw is None else raw).alias(RAW),
        )

    def from_object(element: Column) -> Column:
        missing = element.isNull()
        return item(element, F.when(missing, NOT_AN_OBJECT), F.when(missing, "null"))

    def from_text(text: Column) -> Column:
        parsed = F.from_json(text, element_schema, {"mode": "PERMISSIVE"})
        is_object = F.coalesce(F.substring(F.trim(text), 1, 1) == "{", F.lit(False))
        return item(
            F.when(is_object, parsed),
            F.when(~is_object, NOT_AN_OBJECT),
            F.when(~is_object, F.coalesce(text, F.lit("null"))),
        )

    def bad_body(reason: str) -> Column:
        return F.array(item(None, F.lit(reason), F.col(BODY)))

    parsed = bodies.select(*keep, BODY, strict.alias("_strict"))
    unreadable = F.col("_strict").isNull() | F.col(f"_strict.{_CORRUPT}").isNotNull()
    items = (
        F.when(
            ~unreadable & F.col("_strict.results").isNotNull(),
            F.transform("_strict.results", from_object).cast(item_type),
        )
        .when(~unreadable, bad_body(NO_RESULTS).cast(item_type))
        .when(
            by_text.getField("results").isNotNull(),
            F.transform(by_text.getField("results"), from_text).cast(item_type),
        )
        .otherwise(bad_body(UNPARSABLE).cast(item_type))
    )
    return _checked(parsed.select(*keep, F.inline(items)), fail_fast)


def _spread_elements(bodies: DataFrame, element_schema: str, keep: tuple[str, ...]) -> DataFrame:
    text, whole = "_text", "_whole"
    parsed = bodies.select(*keep, BODY, _parse(F.col(BODY), f"results array<string>, {_CORRUPT} string").alias("_parsed"))
    unreadable = F.col("_parsed").isNull() | F.col(f"_parsed.{_CORRUPT}").isNotNull()
    listed = F.col("_parsed.results")
    item_type = f"array<struct<{text}: string, {whole}: string>>"
    cut = F.transform(listed, lambda t: F.struct(t.alias(text), F.lit(None).cast("string").alias(whole)))
    reason = F.when(unreadable, UNPARSABLE).otherwise(NO_RESULTS)
    bad = F.array(F.struct(F.col(BODY).alias(text), reason.alias(whole)))
    items = F.when(listed.isNotNull(), cut.cast(item_type)).otherwise(bad.cast(item_type))
    dealt = parsed.select(*keep, F.inline(items)).hint("rebalance")
    is_object = F.coalesce(F.substring(F.trim(text), 1, 1) == "{", F.lit(False)) & F.col(whole).isNull()
    problem = F.when(~is_object, F.coalesce(whole, F.lit(NOT_AN_OBJECT)))
    typed = F.struct(
        F.when(is_object, F.from_json(text, element_schema, {"mode": "PERMISSIVE"})).alias(ELEMENT),
        problem.alias(PROBLEM),
        F.when(~is_object, F.coalesce(F.col(text), F.lit("null"))).alias(RAW),
    )
    # A generator, not a projection: through one, each check on a field would go below the dealing, with a parse of its own.
    return dealt.select(*keep, F.inline(F.array(typed)))


def _checked(rows: DataFrame, fail_fast: bool) -> DataFrame:
    if fail_fast:
        # A filter, so that no later projection can prune the check away.
        rows = rows.where(
            F.when(
                F.col(PROBLEM).isNotNull(),
                F.raise_error(F.concat_ws(": ", F.col(PROBLEM), F.col(RAW))).cast("boolean"),
            ).otherwise(True)
        )
    return rows
