"""Measurements as a file stream.

Each new file of saved responses is merged once. The state lives in the fact table, where a merge
is right at any lateness, so there is no watermark. A batch that is replayed after a failure finds
its own rows and inserts none again.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.loads import Ledger, LoadReport, load_bodies
from ..sources.envelope import BODY
from ..sources.tables import FactStore


#: Older than any file: nothing is left out for its age.
ANY_AGE = "36500d"


def stream_bodies(
    spark: SparkSession,
    path: str,
    max_files_per_batch: int | None = None,
    whole_files: bool = False,
    max_file_age: str = ANY_AGE,
    archive_dir: str | None = None,
) -> DataFrame:
    """Bodies of new files, one per line or one per file.

    Spark forgets files whose change time is ``max_file_age`` older than the newest one, and never reads such a
    file if it comes late (a copy that kept its time, say). By default no file is that old, at the cost of
    a list of all files seen, in memory and in the checkpoint. ``archive_dir`` bounds that list: files that
    are done are moved there.
    """
    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if whole_files:
        reader = reader.option("wholetext", True)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(path).where(F.trim("value") != "").select(F.col("value").alias(BODY))


def start_measurement_stream(
    spark: SparkSession,
    path: str,
    store: FactStore,
    checkpoint: str,
    stage_dir: str,
    as_of: datetime | Column | None = None,
    available_now: bool = True,
    interval: str = "1 hour",
    max_files_per_batch: int | None = None,
    reports: list[LoadReport] | None = None,
    ledger: Ledger = Ledger(),
    name: str | None = None,
    max_age_days: int | None = None,
    max_ahead_days: int | None = None,
    **source_options,
) -> StreamingQuery:
    """Start the stream: over the files that are there, or every ``interval`` for good.

    ``source_options`` go to ``stream_bodies`` (``whole_files``, ``max_file_age``, ``archive_dir``).

    With a log in the ``ledger``, each batch is one load under the id ``<name>/<batch number>``: a batch that is replayed after it was logged
    is not loaded again. ``name`` says which stream it is, over all its restarts; by default it is the checkpoint's path.

    ``max_age_days`` and ``max_ahead_days`` bound the times of a batch around the day it is loaded: what is outside goes to
    quarantine, so one odd file cannot touch the partitions of a century.

    ``checkpoint`` and ``stage_dir`` must be on storage that all executors share.
    """

    whole_files = bool(source_options.get("whole_files"))

    def load(batch: DataFrame, number: int) -> None:
        today = (as_of if isinstance(as_of, datetime) else datetime.now(timezone.utc)).date()
        bounds = {}
        if max_age_days is not None:
            bounds["earliest"] = today - timedelta(days=max_age_days)
        if max_ahead_days is not None:
            bounds["latest"] = today + timedelta(days=max_ahead_days)
        report = load_bodies(
            batch, store, f"{stage_dir}/batch={number}", as_of=as_of, ledger=ledger, load_id=f"{name or checkpoint}/{number}",
            spread=whole_files, **bounds,
        )
        if reports is not None:
            reports.append(report)

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        stream_bodies(spark, path, max_files_per_batch, **source_options)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
