"""Staging: the checked rows of one load, written once to a folder of their own.

The body is parsed a single time; good and quarantined rows land side by side in one write, told
apart by a column (folders for the two would sort every task's rows first). Loads never share a
folder, and repeating a load overwrites its folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.validate import OK, REASONS
from ..schemas import Rule, no_rows, staging_schema
from .envelope import RAW
from .files import changed_at, child_names, exists, remove, write_empty

STATUS = "_status"
GOOD, QUARANTINE = "good", "quarantine"
#: Name of the mark; its underscore hides it from readers.
FINISHED = "_FINISHED"


@dataclass(frozen=True)
class Staged:
    spark: SparkSession
    path: str
    rules: tuple[Rule, ...]
    counts: dict[str, int]

    def finished(self) -> None:
        """Nothing will read these rows any more."""
        write_empty(self.spark, f"{self.path}/{FINISHED}")

    def good(self, *more: str) -> DataFrame:
        """Good rows; ``more`` are text columns that were kept beside those of the rules."""
        schema = staging_schema(self.rules)
        for name in more:
            schema = schema.add(name, T.StringType())
        return self._rows(GOOD, schema)

    def quarantined(self) -> DataFrame:
        schema = staging_schema(self.rules).add(REASONS, T.StringType())
        return self._rows(QUARANTINE, schema.add(RAW, T.StringType()))

    def _rows(self, status: str, schema: T.StructType) -> DataFrame:
        if not self.counts[status]:
            return no_rows(self.spark, schema)  # known to be empty, so the optimiser drops what follows
        stored = self.spark.read.schema(T.StructType(schema.fields).add(STATUS, T.StringType()))
        return stored.parquet(self.path).where(F.col(STATUS) == status).drop(STATUS)


def clean_staging(spark: SparkSession, base: str, min_age: timedelta, now: datetime | None = None) -> list[str]:
    """Remove the staging folders below ``base`` (one for each load) whose load is over; returns their names.

    Rows are read from a staging folder until its load has merged them, so a folder without the mark that ``finished`` leaves stays for
    ``min_age`` after it was last written to, which must be longer than any load takes. Nothing else below ``base`` is touched.
    """
    at, gone = (now or datetime.now(timezone.utc)).timestamp(), []
    for name in child_names(spark, base):
        folder = f"{base}/{name}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            continue
        if exists(spark, f"{folder}/{FINISHED}") or at - changed_at(spark, f"{folder}/_SUCCESS") > min_age.total_seconds():
            remove(spark, folder)
            gone.append(name)
    return sorted(gone)


def stage(extracted: DataFrame, path: str, rules: tuple[Rule, ...]) -> Staged:
    """Truncate and write; the counts are taken on the way, without another pass."""
    seen = Observation()
    status = F.when(F.col(OK), GOOD).otherwise(QUARANTINE).alias(STATUS)
    rows = extracted.select(*[c for c in extracted.columns if c != OK], status).observe(
        seen,
        *[
            F.coalesce(F.count_if(F.col(STATUS) == name), F.lit(0)).alias(name)
            for name in (GOOD, QUARANTINE)
        ],
    )
    (
        rows.write.mode("overwrite")
        .parquet(path)
    )
    return Staged(extracted.sparkSession, path, rules, dict(seen.get))
