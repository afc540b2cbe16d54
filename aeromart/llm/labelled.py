"""Documents with their labels, for the two classifiers that learn from them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import checked_bytes, in_fold, written
from aeromart.llm.logistic import Logistic

#: Rows of labels that the weights of a classifier are fitted on at most, about; beyond it a sample by hash of the id is taken.
LABEL_ROWS = 200_000
#: What labels that are broadcast may take, and one of them.
SAMPLE_BYTES, LABEL_BYTES = 16 << 20, 24


def fit(rows: DataFrame, width: int) -> Logistic:
    """The score from (doc_id, x, label): one row per id, so the sample of labels bounds what is collected."""
    one = rows.groupBy("doc_id").agg(F.min("x").alias("x"), F.max("label").alias("label")).select("x", "label").toArrow()
    return Logistic(one["x"].to_pylist(), one["label"].to_pylist(), width)


def share(rows: int, bound: int, seed: int) -> Column:
    """About ``bound`` of ``rows`` rows, by hash of the id; all of them if there are no more."""
    if rows <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < math.ceil(1_000_000 * bound / rows)


def known_labels(labels: DataFrame, target: str, parts: int, held: int, bound: int | None = LABEL_ROWS) -> DataFrame:
    """(doc_id, label) outside the held-out fold whose ``target`` is 0 or 1. Several labels of one id: the larger counts. No ``bound``: all."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(target).cast("int").alias("label"))
    known = known.where(~in_fold("doc_id", parts, held) & F.col("label").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return known if bound is None else known.where(share(known.count(), bound, 0))


def all_labels(labels: DataFrame, target: str, parts: int, held: int) -> DataFrame:
    """``known_labels`` without a bound, written."""
    return written(known_labels(labels, target, parts, held, None), "labels")


def texts_of(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the documents in ``known``.

    The sample of labels (an id and a flag each) is broadcast, its size checked, so that texts are filtered where they
    are read and never shuffled.
    """
    checked_bytes(known.count() * LABEL_BYTES, SAMPLE_BYTES, "the sample of labels")
    return all_texts_of(docs, known)


def all_texts_of(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The same of any number of labels. Beyond ``SAMPLE_BYTES`` of them, texts meet their labels by a shuffled join."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    few = known.count() * LABEL_BYTES <= SAMPLE_BYTES
    return texts.join(F.broadcast(known) if few else known, "doc_id")
