"""Where alert messages go: a Parquet folder that is outbox and log of sent messages in one.

A message counts as sent once the job that appended it has committed, so there is no moment in which one of the
two is written and the other is not: a run that failed appends its messages when it is repeated, a run that
did not finds them here.

Runs that post the same days must follow one another.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.alerts import not_yet_sent
from .files import child_names, exists, remove

DAY = "measure_date"
RUN = "run"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _span(days: Sequence[date | None]) -> str:
    known = [day for day in days if day is not None]
    return f"{min(known)}.{max(known)}" if known and len(known) == len(days) else "any"


def _overlaps(run: str, days: Sequence[date | None]) -> bool:
    span = run.split("=")[1].rpartition(".")[0]
    if span == "any" or None in days:
        return True
    first, last = map(date.fromisoformat, span.split("."))
    return any(first <= day <= last for day in days)


@dataclass(frozen=True)
class Outbox:
    """``<path>/run=<first day>.<last day>.<id>/measure_date=…``: a folder for each run that had something to send, its messages by day."""

    spark: SparkSession
    path: str

    def _folders(self, days: Sequence[date | None] | None) -> list[str]:
        """The day folders of committed runs; of runs whose span leaves the wanted days out, nothing but the name is looked at."""
        runs = [n for n in child_names(self.spark, self.path) if n.startswith(f"{RUN}=") and (days is None or _overlaps(n, days))]
        wanted = None if days is None else {f"{DAY}={_NO_DAY if day is None else day}" for day in days}
        return [
            f"{self.path}/{run}/{name}"
            for run in runs
            if exists(self.spark, f"{self.path}/{run}/_SUCCESS")
            for name in child_names(self.spark, f"{self.path}/{run}")
            if name.startswith(f"{DAY}=") and (wanted is None or name in wanted)
        ]

    def messages(self, days: Sequence[date | None] | None = None) -> DataFrame | None:
        """All messages of committed runs, or those of some days, with the column ``run``; None if there are none."""
        folders = self._folders(days)
        if not folders:
            return None
        reader = self.spark.read.option("basePath", self.path)
        kinds = {DAY: T.DateType(), RUN: T.StringType()}
        stored = reader.parquet(folders[0]).schema
        schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in stored])
        return self.spark.read.option("basePath", self.path).schema(schema).parquet(*folders)

    def post(self, addressed: DataFrame) -> DataFrame:
        """Append the messages whose ``alert_id`` is not here yet, and return them.

        The log is read for the days of these messages alone, and of it only the ids.
        """
        days = [row[0] for row in addressed.select(DAY).distinct().collect()]  # a day each, whatever the number of messages
        sent = self.messages(days) if days else None
        new = addressed if sent is None else not_yet_sent(addressed, sent)
        where = f"{self.path}/{RUN}={_span(days)}.{uuid.uuid4().hex}"
        rows = new.select(addressed.columns).dropDuplicates(["alert_id"])
        rows.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(where)
        if not any(name.startswith(f"{DAY}=") for name in child_names(self.spark, where)):
            remove(self.spark, where)  # nothing to send
            return addressed.limit(0)
        return self.spark.read.schema(addressed.schema).parquet(where).select(addressed.columns)
