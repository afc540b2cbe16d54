"""Bad elements as a table that outlives its loads, so that they can be loaded when the rules have changed.

An element is known by a hash of its text: delivered again, it is still one. Entries are appended per load; a replay reads what is open by
the rules of now, loads what has become good and closes it. What a replay closed is named by its hash, so each element
is loaded once, also if the replay is repeated after a failure: the merge finds its own rows then.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.validate import REASONS
from .envelope import BODY, NO_RESULTS, RAW, UNPARSABLE
from .files import child_names, exists

HASH = "content_hash"
_FIELDS = T.StructType([T.StructField(name, T.StringType()) for name in (HASH, REASONS, RAW)])


def content_hash(raw: Column) -> Column:
    return F.sha2(raw, 256)


@dataclass(frozen=True)
class Quarantine:
    """``<path>/entries/run=<hash>`` and ``<path>/closed/run=<hash>``: a folder for each load and each replay."""

    spark: SparkSession
    path: str

    def _folder(self, part: str, run_id: str) -> str:
        return f"{self.path}/{part}/run={hashlib.sha1(run_id.encode()).hexdigest()}"

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        base = f"{self.path}/{part}"
        runs = [f"{base}/{n}" for n in child_names(self.spark, base) if exists(self.spark, f"{base}/{n}/_SUCCESS")]
        return self.spark.read.schema(schema).parquet(*runs) if runs else S.no_rows(self.spark, schema)

    def add(self, quarantined: DataFrame, load_id: str) -> None:
        """Bad rows of a load (reasons and text), each text once. Repeating a load replaces its entries."""
        rows = quarantined.where(F.col(RAW).isNotNull()).select(content_hash(F.col(RAW)).alias(HASH), REASONS, RAW)
        one = rows.groupBy(HASH).agg(F.min(REASONS).alias(REASONS), F.min(RAW).alias(RAW))
        one.write.mode("overwrite").parquet(self._folder("entries", load_id))

    def entries(self) -> DataFrame:
        """Every bad element there has been, once, whichever loads it came with."""
        rows = self._read("entries", _FIELDS)
        return rows.groupBy(HASH).agg(F.min(REASONS).alias(REASONS), F.min(RAW).alias(RAW))

    def closed(self) -> DataFrame:
        return self._read("closed", T.StructType(_FIELDS.fields[:1])).distinct()

    def open(self) -> DataFrame:
        return self.entries().join(self.closed(), HASH, "left_anti")

    def bodies(self) -> DataFrame:
        """What is open as bodies again: whole ones as they came, single elements each in a list of its own."""
        whole = F.col(REASONS).isin(UNPARSABLE, NO_RESULTS)
        wrapped = F.concat(F.lit('{"results":['), F.col(RAW), F.lit("]}"))
        return self.open().select(HASH, F.when(whole, F.col(RAW)).otherwise(wrapped).alias(BODY))

    def close(self, hashes: DataFrame, replay_id: str) -> None:
        hashes.select(HASH).distinct().write.mode("overwrite").parquet(self._folder("closed", replay_id))
