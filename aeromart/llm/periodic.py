"""Runs of words that repeat with a period, found online by a sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q that no neighbour extends, ``LEAST`` words long and ``TIMES``
periods long at least. On the diagonal of lag q (word i against word i - q) it is an unbroken match of length - q words. The DP
walks the words once for each doubling of the period and keeps the one active diagonal with its match length: a
word whose earlier occurrence lies at the active lag lengthens it, any other ends it, and a diagonal that ends long enough
emits its run there and then.

Which earlier occurrence counts is what keeps the diagonals sparse: a word said n times has n²/2 of them. For periods from p to
2p - 1 a word stands for the 2p words that begin with it. Inside a run with a period in that range these are longer than the
period, so their nearest earlier occurrence is exactly one period back (a smallest period is a primitive word, which does
not occur inside its own square except at its ends), and three periods of matches are longer than they are, so no run is missed.
Numbers for 2p words are made of those for p words, a text in which nothing of that length occurs twice is done, and
the cost is the number of words times the logarithm of the longest period.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words, no runs and an empty collapsed text. Texts are whole, however long;
every row stands for itself, so repeated rows and rows with null ids each give a row. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from itertools import compress

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import map_texts

LEAST = 6
TIMES = 4
Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def runs_of(words: Sequence) -> list[Run]:
    """All (start, length, period), by start and then period."""
    names: dict = {}
    grams = [names.setdefault(w, len(names)) for w in words]
    found: list[Run] = []
    low = 1
    while TIMES * low <= len(words):
        names = {}
        grams = [names.setdefault(pair, len(names)) for pair in zip(grams, grams[low:])]  # now of 2 * low words
        if len(names) == len(grams):
            break  # nothing of this length is said twice
        _diagonals(grams, len(names), low, found)
        low *= 2
    found.sort(key=lambda run: (run[0], run[2]))
    return found


def _diagonals(grams: list[int], kinds: int, low: int, found: list[Run]) -> None:
    """Adds the runs with periods from ``low`` to twice that; ``grams`` are numbers for 2 * low words each."""
    never = -4 * len(grams)
    latest = [never] * kinds
    active, since = 0, 0
    for i, gram in enumerate(grams):
        lag = i - latest[gram]
        latest[gram] = i
        if lag != active:
            if active:
                _emit(since, i, low, active, found)
            active, since = (lag, i) if low <= lag < 2 * low else (0, i)
    if active:
        _emit(since, len(grams), low, active, found)


def _emit(since: int, until: int, low: int, period: int, found: list[Run]) -> None:
    start = since - period
    length = until - 1 + 2 * low - start
    if length >= max(LEAST, TIMES * period):
        found.append((start, length, period))


def collapse(words: list[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without the repeats: of each run the first period stays, unless another run drops it."""
    if not runs:
        return words
    keep = bytearray(b"\x01") * len(words)
    for start, length, period in runs:
        keep[start + period : start + length] = bytes(length - period)
    return list(compress(words, keep))


def loop_some(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Ends every tenth document, by hash of its id, in a loop of its own words: known runs in any table."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) per row of ``docs`` (doc_id, text): all runs in order, and the words that are left, joined by spaces."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_pylist()
        upto, flat, left = [0], [], []
        for doc_id, text in zip(ids, batch.column(1).to_pylist()):
            words = text.encode().split() if text else []  # bytes are split at just these six signs
            if rewrite is not None:
                words = rewrite(doc_id, words)
            runs = runs_of(words)
            flat += runs
            upto.append(len(flat))
            left.append(b" ".join(collapse(words, runs)).decode())
        parts = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
        runs = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
        return pa.RecordBatch.from_arrays([batch.column(0), runs, pa.array(left, pa.string())], names=["doc_id", "runs", "collapsed"])

    schema = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return map_texts(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), per_batch, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared crosswise; the first of equal ones. NULL without any."""
    higher = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(higher(run, best), run).otherwise(best))


def digests(found: DataFrame) -> DataFrame:
    """One row of numbers and digests for each row of ``find_runs``."""
    best = strongest(F.col("runs"))
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    lines = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("bigint").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
