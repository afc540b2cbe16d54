"""Where shared files go."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="run-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the one the cluster shares (``spark.checkpoint.dir``).

    Without that setting only a local session gets a folder: on a cluster, a folder of one machine
    would be lost to the others.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/aeromart-{uuid.uuid4().hex}/{name}"
