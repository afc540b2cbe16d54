"""The log of loads: one row per load, whatever ran it, appended once however often the load is repeated.

A load that is through stands below ``outcome=done``, under a hash of its id; one that raised stands below ``outcome=failed``, so that it may
be repeated under the same id. A row says which windows the load covered, which is what a backfill of the gaps needs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from .files import child_names, exists

DONE, FAILED = "done", "failed"
OUTCOME = "outcome"
COUNTS = ("rows_in", "good", "quarantined", "kept", "updated", "inserted")
Windows = Sequence[tuple[datetime, datetime]]

_WINDOW = T.StructType([T.StructField(n, T.TimestampNTZType()) for n in ("window_start", "window_end")])
ENTRY = T.StructType(
    [T.StructField("load_id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("windows", T.ArrayType(_WINDOW))]
    + [T.StructField(name, T.LongType()) for name in COUNTS]
    + [T.StructField("problem", T.StringType()), T.StructField("finished_at", T.TimestampNTZType())]
)


@dataclass(frozen=True)
class LoadLog:
    """``<path>/outcome=…/load=<hash>``."""

    spark: SparkSession
    path: str

    def _folder(self, outcome: str, load_id: str) -> str:
        return f"{self.path}/{OUTCOME}={outcome}/load={hashlib.sha1(load_id.encode()).hexdigest()}"

    def entries(self) -> DataFrame:
        """All rows, with their outcome."""
        folders = [f"{self.path}/{n}" for n in child_names(self.spark, self.path) if n.startswith(f"{OUTCOME}=")]
        if not folders:
            return S.no_rows(self.spark, T.StructType(list(ENTRY.fields)).add(OUTCOME, T.StringType()))
        schema = T.StructType(list(ENTRY.fields)).add(OUTCOME, T.StringType()).add("load", T.StringType())
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).drop("load")

    def counts(self, load_id: str) -> dict[str, int] | None:
        """What a load that is through has counted."""
        where = self._folder(DONE, load_id)
        if not exists(self.spark, f"{where}/_SUCCESS"):
            return None
        return self.spark.read.schema(ENTRY).parquet(where).select(*COUNTS).first().asDict()

    def done(self, load_id: str, windows: Windows, counts: dict[str, int], source: str = "", at: datetime | None = None) -> None:
        """Nothing happens if this id is through already."""
        if self.counts(load_id) is None:
            self._write(DONE, load_id, windows, counts, None, source, at)

    def failed(self, load_id: str, windows: Windows, problem: str, source: str = "", at: datetime | None = None) -> None:
        """The last failure of an id is kept."""
        self._write(FAILED, load_id, windows, {}, problem[:2000], source, at)

    def _write(self, outcome, load_id, windows, counts, problem, source, at) -> None:
        at = at or datetime.now(timezone.utc).replace(tzinfo=None)
        row = (load_id, source, list(windows), *[counts.get(c) for c in COUNTS], problem, at)
        entry = self.spark.createDataFrame([row], ENTRY).coalesce(1)
        entry.write.mode("overwrite").parquet(self._folder(outcome, load_id))

    def windows(self) -> DataFrame:
        """(window_start, window_end) of the loads that are through."""
        return self.entries().where(F.col(OUTCOME) == DONE).select(F.inline("windows"))


def new_id() -> str:
    return uuid.uuid4().hex
