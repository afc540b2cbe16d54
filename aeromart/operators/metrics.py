"""Counts of what a merge did, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merge import INSERTED, KEPT, UPDATED
from .validate import REASONS, SEPARATOR


def action_counts(merged: DataFrame, action: str) -> DataFrame:
    """One row: kept, updated and inserted rows of a merge that was asked for its ``action``."""
    return merged.agg(
        *[
            F.coalesce(F.count_if(F.col(action) == name), F.lit(0)).alias(name)
            for name in (KEPT, UPDATED, INSERTED)
        ]
    )


def quarantine_counts(extracted: DataFrame, reasons: str = REASONS) -> DataFrame:
    """Rows per reason; good rows count under ``ok``, a row with two reasons under both."""
    listed = F.coalesce(reasons, F.lit("ok"))
    return extracted.select(F.explode(F.split(listed, SEPARATOR)).alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows")
    )
