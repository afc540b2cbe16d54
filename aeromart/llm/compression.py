"""Quality by compression: a text is like the labelled texts whose dictionary packs it better.

zstandard dictionaries are trained from good and from bad labelled texts, ``PAIRS`` of each from different texts. A
whole text is compressed with each; the difference between the mean sizes, divided by the length of the text and by the
larger size, and the size itself per byte, become a score by logistic regression on labelled rows that no dictionary has seen.

Dictionaries learn from a bounded sample of the labelled rows (about ``TEXTS`` of each class and pair). Each text of it is cut
over its whole length into pieces of ``TEXT_BYTES``; of more pieces than ``TEXTS`` of each class and pair, about so many are taken by hash
of the id and the number of the piece, which bounds what the driver holds. Scoring compresses whole texts. Nothing but the text enters a score. Null texts count as empty.
Where a class has too few texts for dictionaries, the score is a constant. Repeated rows each give a row. Rows with a null id
count as held out.
"""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import in_fold, map_texts, written
from aeromart.llm.labelled import fit, known_labels, share, texts_of
from aeromart.llm.logistic import Logistic

PARTS, HELD = 5, 0
THRESHOLD = 0.3
PAIRS = 3
LEVEL = 3
DICT_BYTES = 110 << 10
TEXTS, TEXT_BYTES = 1500, 8000
WIDTH = 3


class Codecs:
    """The compressors of all dictionaries, made once per Python worker."""

    def __init__(self, dictionaries: list[tuple[bytes, bytes]]):
        self.pairs = [tuple(self._codec(d) for d in pair) for pair in dictionaries]

    @staticmethod
    def _codec(data: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(data)
        held.precompute_compress(LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def features(self, text: str | None) -> tuple[float, float, float]:
        data = (text or "").encode()
        if not data or not self.pairs:
            return 0.0, 0.0, 0.0
        good = sum(len(g.compress(data)) for g, _ in self.pairs) / len(self.pairs)
        bad = sum(len(b.compress(data)) for _, b in self.pairs) / len(self.pairs)
        return (bad - good) / len(data), (bad - good) / max(good, bad), float(np.log(max(good, bad) / len(data)))


class Classifier:
    def __init__(self, dictionaries: list[tuple[bytes, bytes]], score: Logistic):
        self.dictionaries, self.score = dictionaries, score


def _dictionary(texts: list[bytes]) -> bytes | None:
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts).as_bytes() if len(texts) >= 8 else None
    except zstandard.ZstdError:  # too little text for a dictionary
        return None


def pieces(texts: DataFrame, bound: int = TEXTS * PAIRS) -> DataFrame:
    """(doc_id, label, piece, t) from (doc_id, label, text): the texts in pieces, about ``bound`` of each label at most, by hash."""
    n = F.greatest(F.ceil(F.octet_length("text") / TEXT_BYTES), F.lit(1))
    share_of = {r.label: bound / r.n for r in texts.groupBy("label").agg(F.sum(n).alias("n")).collect()}

    def cut(batch: pa.RecordBatch) -> pa.Table:
        made = []
        for doc_id, label, text in zip(*(c.to_pylist() for c in batch.columns)):
            data, below = text.encode(), math.ceil(min(share_of[label], 1) * 1_000_000)
            for k, at in enumerate(range(0, max(len(data), 1), TEXT_BYTES)):
                if xxhash.xxh64_intdigest(f"{doc_id} {k}") % 1_000_000 < below:
                    made.append((doc_id, label, k, data[at : at + TEXT_BYTES]))
        columns = list(zip(*made)) or [()] * 4
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "label", "piece", "t"])

    return map_texts(texts.select("doc_id", "label", "text"), cut, "doc_id bigint, label int, piece int, t binary")


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Dictionaries from three quarters of the labelled rows (bounded), the score from the other quarter (bounded)."""
    known = known_labels(labels, "quality", PARTS, HELD)
    fits = F.crc32(F.col("doc_id").cast("string")) % PARTS == 1
    sizes = {r["label"]: r["count"] for r in known.where(~fits).groupBy("label").count().collect()}
    chosen = F.lit(False)
    for label, rows in sizes.items():
        chosen = chosen | ((F.col("label") == label) & share(rows, TEXTS * PAIRS, 1))
    texts = texts_of(docs, known.where(~fits & chosen))
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))  # repeated ids count once
    rows = pieces(written(texts, "texts")).orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id", "piece").collect()
    samples = []
    for label in (1, 0):
        own = [[bytes(r.t) for r in of] for _, of in groupby((r for r in rows if r.label == label), key=lambda r: r.doc_id)]
        samples.append([[t for of in own[i::PAIRS] for t in of] for i in range(PAIRS)])
    pairs = [(g, b) for g, b in zip(*([_dictionary(x) for x in s] for s in samples)) if g and b]
    held = docs.sparkSession.sparkContext.broadcast(pairs)  # 2 x PAIRS x DICT_BYTES

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        codecs = _codecs(held)
        made = pa.array([codecs.features(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), made, batch.column(2)], names=["doc_id", "x", "label"])

    rows = texts_of(docs, known.where(fits)).select("doc_id", "text", "label")
    return Classifier(pairs, fit(map_texts(rows, features, "doc_id bigint, x array<double>, label int"), WIDTH))


_CODECS: dict[int, Codecs] = {}


def _codecs(held) -> Codecs:
    pairs = held.value
    if id(pairs) not in _CODECS:
        _CODECS.clear()
        _CODECS[id(pairs)] = Codecs(pairs)
    return _CODECS[id(pairs)]


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text)."""
    held = docs.sparkSession.sparkContext.broadcast(classifier.dictionaries)
    logistic = classifier.score

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        codecs = _codecs(held)
        scores = logistic.scores(np.array([codecs.features(t) for t in batch.column(1).to_pylist()]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    made = map_texts(docs.select(F.col("doc_id").cast("bigint"), "text"), per_batch, "doc_id bigint, score double")
    return made.select(
        "doc_id", in_fold("doc_id", PARTS, HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
