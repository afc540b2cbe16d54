"""The star schema as Parquet: two dimensions kept as snapshots, one fact partitioned by day.

Parquet has no MERGE. A dimension is small next to the fact, so a merge writes it anew and readers
switch to the new snapshot once its job has committed. The fact is merged day by day: the time is
part of its key, so a source row can only match rows of its own day, and only the days in the
source are read and rewritten.

Loads that touch the same day, or the same dimension, must run one after the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.times import as_day, in_days
from ..operators.merge import INSERTED, KEPT, MEASURE_KEYS, UPDATED, merge_measures
from .files import changed_at, child_names, exists, make_dir, remove, write_empty
from .partials import DAY, HOUR, PartialStore

_ACTION = "_action"
_HOLDS = "_holds"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Dimension:
    """``<path>/snapshot=<n>``; the current one is the newest whose job has committed."""

    spark: SparkSession
    path: str
    schema: T.StructType
    sort: str = "id"

    def _newest(self) -> int | None:
        """Looked for from the newest down, as old snapshots pile up until someone deletes them."""
        names = child_names(self.spark, self.path)
        numbers = (int(n.split("=")[1]) for n in names if n.startswith("snapshot="))
        for number in sorted(numbers, reverse=True):
            if exists(self.spark, f"{self.path}/snapshot={number}/_SUCCESS"):
                return number
        return None

    def create_if_absent(self) -> None:
        if self._newest() is None:
            self.publish(S.no_rows(self.spark, self.schema))

    def current(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(
            f"{self.path}/snapshot={self._newest()}"
        )

    def publish(self, rows: DataFrame) -> DataFrame:
        """Write the next snapshot; the one that is being read stays untouched."""
        number = (self._newest() or 0) + 1
        (
            rows.select(*self.schema.names)
            .hint("rebalance")
            .sortWithinPartitions(self.sort)
            .write.mode("overwrite")
            .parquet(f"{self.path}/snapshot={number}")
        )
        return self.current()

    def numbers(self) -> list[int]:
        """Committed snapshots, the newest first."""
        names = child_names(self.spark, self.path)
        found = sorted((int(n.split("=")[1]) for n in names if n.startswith("snapshot=")), reverse=True)
        return [n for n in found if exists(self.spark, f"{self.path}/snapshot={n}/_SUCCESS")]

    @contextmanager
    def reading(self) -> Iterator[DataFrame]:
        """The current snapshot, held for as long as the block runs: ``clean`` leaves it alone, however old it gets.

        The hold is written before the snapshot is looked up again, so a clean-up in between is noticed.
        """
        while True:
            number = self._newest()
            hold = f"{self.path}/{_HOLDS}/{number}-{uuid.uuid4().hex}"
            write_empty(self.spark, hold)
            if exists(self.spark, f"{self.path}/snapshot={number}/_SUCCESS"):
                break
            remove(self.spark, hold)
        try:
            yield self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshot={number}")
        finally:
            remove(self.spark, hold)

    def clean(self, min_age: timedelta = timedelta(days=1), max_hold: timedelta = timedelta(days=7), now: datetime | None = None) -> list[int]:
        """Remove snapshots that nobody can still be reading; returns their numbers.

        A snapshot stays while it is the current one, while a reader holds it, and for ``min_age`` after it was superseded, which is
        longer than any query that took ``current()`` without a hold may run. Holds older than ``max_hold`` are of
        readers that died. Snapshots of writers that died, which no reader ever sees, go with the same age.
        """
        at = (now or datetime.now(timezone.utc)).timestamp()
        holds = child_names(self.spark, f"{self.path}/{_HOLDS}")
        dead = {h for h in holds if at - changed_at(self.spark, f"{self.path}/{_HOLDS}/{h}") > max_hold.total_seconds()}
        for hold in dead:
            remove(self.spark, f"{self.path}/{_HOLDS}/{hold}")
        held = {int(h.split("-")[0]) for h in holds if h not in dead}
        committed = self.numbers()
        superseded = [changed_at(self.spark, f"{self.path}/snapshot={n}/_SUCCESS") for n in committed[:-1]]
        old = [n for n, since in zip(committed[1:], superseded) if n not in held and at - since > min_age.total_seconds()]
        gone = list(old)
        for number in old:
            remove(self.spark, f"{self.path}/snapshot={number}")
        every = {int(n.split("=")[1]) for n in child_names(self.spark, self.path) if n.startswith("snapshot=")}
        for number in every - set(committed):
            if committed and number < committed[0] and at - changed_at(self.spark, f"{self.path}/snapshot={number}") > min_age.total_seconds():
                remove(self.spark, f"{self.path}/snapshot={number}")
                gone.append(number)
        return sorted(gone)


@dataclass(frozen=True)
class FactStore:
    """``<path>/measure_date=…``, and with ``hourly`` (the default) ``measure_hour=…`` below it.

    By day, an hourly load rewrites the whole day: choose that only where loads come once a day.
    """

    spark: SparkSession
    path: str
    hourly: bool = True
    schema: T.StructType = S.FACT_MEASURE

    @property
    def partitions(self) -> list[str]:
        return [DAY, HOUR] if self.hourly else [DAY]

    def create_if_absent(self) -> None:
        """Also refuses to open stored rows by the other layout."""
        make_dir(self.spark, self.path)
        day = next((n for n in child_names(self.spark, self.path) if n.startswith(f"{DAY}=")), None)
        if day is not None:
            below = child_names(self.spark, f"{self.path}/{day}")
            if any(n.startswith(f"{HOUR}=") for n in below) != self.hourly:
                raise ValueError(f"{self.path} is stored by {'day' if self.hourly else 'hour'}")

    def _stored_schema(self) -> T.StructType:
        schema = T.StructType(list(self.schema.fields)).add(DAY, T.DateType())
        return schema.add(HOUR, T.IntegerType()) if self.hourly else schema

    def _reader(self) -> DataFrameReader:
        return self.spark.read.schema(self._stored_schema()).option("basePath", self.path)

    def read(self, start_day: date | str | None = None, end_day: date | str | None = None) -> DataFrame:
        """The fact, or only the days ``start_day .. end_day`` (both included).

        Given days, only their folders are listed; the rest of the table costs one listing of names.
        """
        if start_day is None and end_day is None:
            return self._reader().parquet(self.path)
        first = _folder(DAY, as_day(start_day)) if start_day is not None else f"{DAY}="
        last = _folder(DAY, as_day(end_day)) if end_day is not None else f"{DAY}=~"
        names = [n for n in child_names(self.spark, self.path) if n.startswith(f"{DAY}=")]
        days = sorted(n for n in names if first <= n <= last and not n.endswith(_NULL_PARTITION))
        return in_days(self._folders(days), start_day, end_day)

    def day_list(self) -> list[date]:
        """The stored days, from the folder names."""
        names = [n.split("=")[1] for n in child_names(self.spark, self.path) if n.startswith(f"{DAY}=")]
        return sorted(date.fromisoformat(n) for n in names if n != _NULL_PARTITION)

    def days(self) -> DataFrame:
        """The same as a frame of one column, for subqueries and joins that prune the fact."""
        return self.spark.createDataFrame([(day,) for day in self.day_list()], f"{DAY} date")

    def newest_day(self) -> date | None:
        return max(self.day_list(), default=None)

    def _folders(self, names: list[str]) -> DataFrame:
        """Just these folders below the root: no other is listed."""
        if not names:
            return S.no_rows(self.spark, self._stored_schema())
        return self._reader().parquet(*[f"{self.path}/{n}" for n in names])

    def read_partitions(self, values: list[tuple]) -> DataFrame:
        """Just these partitions, which must exist."""
        return self._folders(
            ["/".join(_folder(c, v) for c, v in zip(self.partitions, value)) for value in values]
        )

    def partition_list(self) -> list[tuple]:
        """All stored partitions, from the folder names."""
        days = [(day,) for day in self.day_list()]
        if not self.hourly:
            return days
        below = {day: child_names(self.spark, f"{self.path}/{_folder(DAY, day)}") for (day,) in days}
        return [(day, int(n.split("=")[1])) for (day,) in days for n in below[day] if n.startswith(f"{HOUR}=")]

    def _with_partitions(self, rows: DataFrame, ts: str = "date_utc") -> DataFrame:
        rows = rows.withColumn(DAY, F.to_date(ts))
        return rows.withColumn(HOUR, F.hour(ts)) if self.hourly else rows

    def write(self, rows: DataFrame, counts: Observation | None = None) -> None:
        """Replace exactly the partitions that occur in ``rows``.

        The rebalance gathers each partition into few files, and AQE splits a large one over many
        tasks again, so that neither small files nor a single huge writer come out of it.
        """
        placed = (
            self._with_partitions(rows)
            .hint("rebalance", *[F.col(c) for c in self.partitions])
            .sortWithinPartitions(*self.partitions, *S.FACT_SORT)
        )
        if counts is not None:
            # After the last shuffle: a retried map task must not be counted twice.
            placed = placed.observe(
                counts,
                *[
                    F.coalesce(F.count_if(F.col(_ACTION) == name), F.lit(0)).alias(name)
                    for name in (KEPT, UPDATED, INSERTED)
                ],
            ).drop(_ACTION)
        (
            placed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partitions)
            .parquet(self.path)
        )

    def _touched(self, staged: DataFrame, ts: str) -> list[tuple]:
        """The partitions a load falls into: bounded by its time range, not by its rows."""
        days = self._with_partitions(staged.select(ts), ts).select(*self.partitions).distinct()
        return [tuple(row) for row in days.collect()]

    def present(self, touched: list[tuple]) -> list[tuple]:
        """Those that exist already: one listing, or one per touched day of an hourly table."""

        days = set(child_names(self.spark, self.path))
        found = [v for v in touched if _folder(DAY, v[0]) in days]
        if not self.hourly:
            return found
        hours = {
            day: set(child_names(self.spark, f"{self.path}/{_folder(DAY, day)}"))
            for day in {v[0] for v in found}
        }
        return [v for v in found if _folder(HOUR, v[1]) in hours[v[0]]]

    def _among(self, values: list[tuple], columns: dict[str, Column]) -> Column:
        """Whether a row lies in one of the partitions; plain IN lists, which prune folders."""
        known = [v for v in values if None not in v]
        by_day: dict = {}
        for v in known:
            by_day.setdefault(v[1:], []).append(v[0])
        inside = F.lit(False)
        for rest, days in by_day.items():
            one = columns[DAY].isin(days)
            for name, value in zip(self.partitions[1:], rest):
                one = one & (columns[name] == value)
            inside = inside | one
        return inside | columns[DAY].isNull() if len(known) < len(values) else inside

    def merge(
        self,
        staged: DataFrame,
        keys: Mapping[str, str] | None = None,
        merge: Callable[..., DataFrame] = merge_measures,
        partials: PartialStore | None = None,
        **options,
    ) -> dict[str, int]:
        """Merge staged measurements and return how many rows were kept, updated and inserted.

        ``partials`` are brought up to date for the partitions that the merge touches.

        ``staged`` is read several times and must give the same rows each time, as files do.
        Partitions that do not exist yet need no join: their rows go through the same merge
        against an empty target.
        """
        keys = dict(keys or MEASURE_KEYS)
        if "date_utc" not in keys:
            raise ValueError("date_utc must be a key: only then do matches stay within one day")
        ts = keys["date_utc"]
        touched = self._touched(staged, ts)
        if not touched:
            return {KEPT: 0, UPDATED: 0, INSERTED: 0}
        present = self.present(touched)
        known = set(present)
        fresh = [v for v in touched if v not in known]
        options = {"keys": keys, "action": _ACTION, **options}
        self.create_if_absent()
        columns = {DAY: F.to_date(ts), HOUR: F.hour(ts)}
        parts = []
        if present:
            held = self.read_partitions(present)
            late = staged.where(self._among(present, columns)) if fresh else staged
            parts.append(merge(held.select(*self.schema.names), late, **options))
        if fresh:
            # Known to be empty, so the optimiser removes the joins.
            new = staged.where(self._among(fresh, columns)) if present else staged
            parts.append(merge(S.no_rows(self.spark, self.schema).limit(0), new, **options))
        rows = reduce(DataFrame.unionByName, parts)
        counts = Observation()
        if partials is not None:
            partials.expect(touched)
        self.write(rows, counts)
        if partials is not None:
            partials.repair(self)
        return dict(counts.get)


def _folder(name: str, value: object) -> str:
    return f"{name}={_NULL_PARTITION if value is None else value}"


def create_star_schema(
    spark: SparkSession, base: str, hourly: bool = True
) -> tuple[Dimension, Dimension, FactStore]:
    """The three tables under ``base``; whatever exists already is left as it is."""
    tables = (
        Dimension(spark, f"{base}/dim_location", S.DIM_LOCATION),
        Dimension(spark, f"{base}/dim_parameter", S.DIM_PARAMETER),
        FactStore(spark, f"{base}/fact_measure", hourly),
    )
    for table in tables:
        table.create_if_absent()
    return tables
