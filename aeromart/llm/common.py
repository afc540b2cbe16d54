"""What the text operators share: reading tables, folds, passes over whole texts, tables written to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_fold(doc_id: str, parts: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id counts as in the fold, so it is never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == fold, F.lit(True))


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; only a local session without that setting gets one of its own."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = _own_dir()
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, and a lost executor costs no recomputation."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Lets Spark cut Arrow batches at ``BATCH_BYTES``, if the session's bound is larger.

    Two tasks of an executor hold several copies of a batch, on both sides of the pipe; there is no setting for one query alone.
    """
    now = spark.conf.get(BATCH_LIMIT).strip().lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    if int(now.rstrip("kmg")) * unit > BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def map_texts(
    df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str
) -> DataFrame:
    """One result batch per Arrow batch of ``df``. Spark bounds a batch by rows and by bytes."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = per_batch(batch)
                if isinstance(made, pa.Table):
                    yield from made.to_batches()
                else:
                    yield made

    return df.mapInArrow(run, schema)


def most_frequent(counted: DataFrame, n: Column, bound: int, group: str | None = None) -> DataFrame:
    """The rows with the largest counts ``n``, ``bound`` of them at most (per value of ``group``).

    Rows are cut at a count, found from a histogram with sixteen steps for each doubling: rows of equal counts stay or go
    together, and only what stays is ever sent on, whatever the number of tasks.
    """
    step = F.floor(F.log2(n.cast("double")) * 16).cast("int")
    keys = [F.col(group).alias("g") if group else F.lit("").alias("g"), step.alias("step")]
    steps = counted.groupBy(*keys).agg(F.count("*").alias("rows")).collect()
    cuts = {}
    for g in {r.g for r in steps}:
        total = 0
        for r in sorted((r for r in steps if r.g == g), key=lambda r: -r.step):
            total += r.rows
            if total > bound:
                break
            cuts[g] = r.step
    keep = F.lit(False)
    for g, cut in cuts.items():
        keep = keep | ((F.col(group) == g if group else F.lit(True)) & (step >= cut))
    return counted.where(keep)


def checked_bytes(size: int, limit: int, what: str) -> None:
    """Refuse to send executors more than the documented bound."""
    if size > limit:
        raise ValueError(f"{what} takes {size} bytes; its bound is {limit}")


def local_path(path: str) -> str | None:
    """The plain path of a ``file:`` URI or of a path without a scheme; None for any other store."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return None if "://" in path else os.path.abspath(path)


def opened(path: str) -> pa.NativeFile:
    """A file that Spark has named, for reading in a task: in a local folder that is shared, or in any store that pyarrow knows."""
    if path.startswith("file:"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    fs, inner = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return fs.open_input_file(inner)


Blocks = list[tuple[int, list[str]]]


def in_blocks(df: DataFrame, group: str, rows: int, name: str, weight: Column | None = None) -> Blocks:
    """``df``, a written table, as files in blocks of about ``rows`` rows (or of that ``weight``) that tasks read one after another.

    Rows of one ``group`` (a column of at most 2^16 numbers, in whose order they are dealt) stand in one block. Of each block: the
    first group that it may hold, up to that of the next one, and its files.
    """
    counts = df.groupBy(group).agg(F.sum(F.lit(1) if weight is None else weight)).orderBy(group).collect()
    firsts, held, dealt = [0], 0, []
    for value, count in counts:
        if held and held + count > rows:
            firsts.append(value)
            held = 0
        held += count
        dealt.append((value, len(firsts) - 1))
    if len(firsts) == 1:
        return [(0, df.inputFiles())] if dealt else []
    path, spark = shared_dir(df.sparkSession, name), df.sparkSession
    places = spark.createDataFrame(dealt, f"{group} long, block int")
    df.join(F.broadcast(places), group).write.partitionBy("block").parquet(path)
    return [(first, spark.read.parquet(f"{path}/block={b}").inputFiles()) for b, first in enumerate(firsts)]


def block_of(blocks: Blocks, groups: np.ndarray) -> np.ndarray:
    """The block that would hold each group."""
    return np.searchsorted(np.array([first for first, _ in blocks[1:]], np.int64), groups, side="right")


def read_files(paths: list[str], columns: list[str]) -> pa.Table:
    """Files that Spark has written, in a task."""
    tables = []
    for path in paths:
        with opened(path) as source:
            tables.append(pq.read_table(source, columns=columns))
    return pa.concat_tables(tables)


_HELD: dict[str, dict[str, tuple[list[str], object]]] = {}


def held(owner: str, kind: str, paths: list[str], load: Callable[[list[str]], object]) -> object:
    """What ``load`` makes of some files, kept in the Python worker: one block of each kind, and of the last operator alone."""
    if owner not in _HELD:
        _HELD.clear()
        _HELD[owner] = {}
    own = _HELD[owner]
    if kind not in own or own[kind][0] != paths:
        own.pop(kind, None)
        own[kind] = (paths, load(paths))
    return own[kind][1]


def map_chunks(
    df: DataFrame, per_chunk: Callable[[pa.Table], pa.Table], schema: str, chunk_bytes: int = BATCH_BYTES
) -> DataFrame:
    """One result for each ``chunk_bytes`` or so of rows of a task, for work that reads files for every chunk."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                size += batch.nbytes
            if size >= chunk_bytes:
                yield from per_chunk(pa.Table.from_batches(kept)).to_batches()
                kept, size = [], 0
        if kept:
            yield from per_chunk(pa.Table.from_batches(kept)).to_batches()
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
