"""Sums and counts of the fact, kept up by its loads: what the daily alerts need without the fact.

One row per country, day, hour and parameter, in one folder per day. A load notes the partitions that it is about to touch, merges,
and then works out just these partitions anew from the fact and replaces them in their days. The note is removed last: whatever
dies in between leaves a note, readers refuse partials with open notes, and the next load (or ``repair``) does the noted
partitions again. Doing them again gives the same rows.

Loads that touch the same days follow one another, as they must for the fact.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.times import as_day
from ..operators.alerts import hourly_partials, merged_partials, select_parameters
from .files import child_names, exists, remove

if TYPE_CHECKING:
    from .tables import FactStore

DAY, HOUR = "measure_date", "measure_hour"
_NOTES = "_notes"
_PLACE = T.StructType([T.StructField(DAY, T.DateType()), T.StructField(HOUR, T.IntegerType())])


@dataclass(frozen=True)
class PartialStore:
    """``<path>/measure_date=…``; notes of loads that are not through stand in ``<path>/_notes``."""

    spark: SparkSession
    path: str

    @property
    def schema(self) -> T.StructType:
        texts = T.StructType([T.StructField(n, T.StringType()) for n in ("country_code", "parameter_code")])
        texts = texts.add(HOUR, T.IntegerType()).add("value_sum", T.DecimalType(28, 9))
        return texts.add("value_count", T.LongType()).add(DAY, T.DateType())

    def _stored(self, days: list[date]) -> DataFrame:
        there = set(child_names(self.spark, self.path))
        folders = [f"{self.path}/{n}" for n in (f"{DAY}={day}" for day in sorted(days)) if n in there]
        if not folders:
            return S.no_rows(self.spark, self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)

    def expect(self, touched: list[tuple]) -> None:
        """Note partitions, (day,) or (day, hour), before the fact changes there."""
        rows = [(value[0], value[1] if len(value) > 1 else None) for value in touched]
        noted = self.spark.createDataFrame(rows, _PLACE)
        noted.coalesce(1).write.parquet(f"{self.path}/{_NOTES}/{uuid.uuid4().hex}")

    def _open_notes(self) -> list[str]:
        """Only whole notes: one that was never finished stands for a load that never reached the fact."""
        folder = f"{self.path}/{_NOTES}"
        return [f"{folder}/{n}" for n in child_names(self.spark, folder) if exists(self.spark, f"{folder}/{n}/_SUCCESS")]

    def repair(self, fact: FactStore) -> None:
        """Bring all noted partitions up to date: reads them and nothing else of the fact."""
        notes = self._open_notes()
        if not notes:
            return
        places = self.spark.read.schema(_PLACE).parquet(*notes).distinct().collect()
        touched = [tuple(p) if fact.hourly else (p[DAY],) for p in places]
        dated = [t for t in dict.fromkeys(touched) if t[0] is not None]  # rows without a time have no day to alert on
        if dated:
            self._refresh(fact, dated)
        for note in notes:
            remove(self.spark, note)

    def _refresh(self, fact: FactStore, touched: list[tuple]) -> None:
        days = sorted({value[0] for value in touched})
        fresh = hourly_partials(fact.read_partitions(fact.present(touched)))
        old = self._stored(days)
        if fact.hourly:
            place = F.struct(DAY, HOUR)
            done = self.spark.createDataFrame([(tuple(value),) for value in touched], T.StructType([T.StructField("place", _PLACE)]))
            old = old.join(done, place == F.col("place"), "left_anti")
        else:
            old = old.limit(0)
        rows = reduce(DataFrame.unionByName, [old.select(*fresh.columns), fresh])
        (
            rows.select(self.schema.names)
            .hint("rebalance", F.col(DAY))
            .sortWithinPartitions(DAY, "country_code", "parameter_code", HOUR)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(self.path)
        )

    def rebuild(self, fact: FactStore) -> None:
        """All of them from the stored fact: for a fact that was there before."""
        self.expect(fact.partition_list())
        self.repair(fact)

    def read(
        self, start_day: date | str | None = None, end_day: date | str | None = None, parameters: str | list[str] | None = None
    ) -> DataFrame:
        """Per country, day and parameter, as ``country_partials`` of the fact would be; reads the folders of those days only."""
        if self._open_notes():
            raise RuntimeError(f"{self.path} awaits a repair: a load did not finish")
        names = [n for n in child_names(self.spark, self.path) if n.startswith(f"{DAY}=")]
        days = [date.fromisoformat(n.split("=")[1]) for n in names]
        first = as_day(start_day) if start_day is not None else date.min
        last = as_day(end_day) if end_day is not None else date.max
        stored = self._stored([day for day in days if first <= day <= last])
        return merged_partials(select_parameters(stored, parameters))
