"""Hard negatives: for each anchor and each of its nearest rows of the same label, the nearest rows of other labels in a band of scores.

Components become floor(``SCALE`` * x), and a score is the whole-number inner product with the anchor. Higher scores come first, ties by
smaller vec_id. An anchor's positives are its first ``POSITIVES`` other rows of the same label; a positive of score p accepts
negatives whose score n satisfies ``LOW`` * p <= 100 * n <= ``HIGH`` * p, of which the first ``NEGATIVES`` are returned.

Angular triangle filtering. A bounded sample of rows gives up to ``DIRECTIONS`` reference directions, far from one another. Every row of the index
stores its norm, the direction nearest to it and its angle to that direction. For an anchor at angle a to a direction, a row at angle
x to it lies at an angle between |a - x| and a + x from the anchor, so its score lies between norms * cos(a + x) and norms * cos(|a - x|). Rows
of one direction are sorted by angle: those whose bounds, widened by more than any rounding, meet the scores that are wanted are one window
of them, and only windows are scored. The bound that rows must beat is the last place of the ranking so far, which starts with the rows of
the anchor's own direction. Directions from a sample make the filter sharper or weaker, but never change a result.

Anchors are a stated set of queries: they and the rows' tasks meet in blocks. Anchors are written as files in the shared folder, and each task
reads one file after another and keeps its best few rows for each anchor; the best of all tasks follow from a ranking that Spark cuts
before the shuffle as well. Neither anchors nor rows pass through the driver.

Rows with a null label, vec_id or vector, or any null or non-finite component take no part. Vectors of different lengths meet as if the shorter
ones ended in zeros, so an empty vector scores 0. Rows with the anchor's vec_id are never its positives; rows that repeat a vec_id with the same
score count once in a ranking, and equal anchors are one anchor. Scores are exact in 64 bits: scaled components of ``LARGEST`` or more in size are an error. Empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeromart.llm.common import bounded_batches, opened, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
DIRECTIONS = 64
#: Rows that directions are chosen from, about; by hash of the id.
SAMPLE = 20_000
LARGEST = 1 << 24
#: Rows of a task that are held at once, and scores that are.
ROWS, SCORES = 1 << 16, 1 << 20
#: More than the rounding of any angle or bound.
ANGLE, RELATIVE = 1e-6, 1e-6
EXACT = float(1 << 53)
NOTHING = np.iinfo(np.int64).min


def scaled(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """(vec_id, label, vector of whole numbers) of the rows that take part."""
    label = F.col("label") if label is None else label
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), "embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fits = ~F.exists("embedding", lambda x: bad(x.cast("double")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fits)
    whole = lambda x: F.floor(x.cast("double") * SCALE)
    too_large = F.exists("embedding", lambda x: F.abs(x.cast("double")) * SCALE >= LARGEST)
    vector = F.when(too_large, F.raise_error(F.lit("a component is too large for exact scores")).cast("array<bigint>"))
    return rows.select("vec_id", "label", vector.otherwise(F.transform("embedding", whole)).alias("vector"))


def _matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Rows of numbers, the shorter ones filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(float)
    made = np.zeros((len(sizes), width))
    made[np.arange(width) < sizes[:, None]] = flat
    return made


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))


def scores_of(a: np.ndarray, x: np.ndarray, norm: float) -> np.ndarray:
    """Exact inner products of whole numbers; ``norm`` is the largest product of two norms, which no partial sum exceeds."""
    if norm < EXACT:
        return (a @ x.T).astype(np.int64)
    return a.astype(np.int64) @ x.T.astype(np.int64)


def directions(index: DataFrame, most: int = DIRECTIONS, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors far from one another, from about ``sample`` rows: each next one is the row farthest from those before it."""
    rows = index.count()
    some = index if rows <= sample else index.where(F.pmod(F.xxhash64("vec_id"), F.lit(rows)) < sample)
    found = some.select("vec_id", "vector").orderBy("vec_id").limit(2 * sample).toArrow()
    x = _matrix(found.column("vector"))
    norm = np.linalg.norm(x, axis=1)
    x = x[norm > 0] / norm[norm > 0, None]
    if not len(x):
        return np.zeros((1, max(x.shape[1], 1)))
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(most, len(x)):
        at = int(nearest.argmin())
        if nearest[at] > 1 - 1e-9:
            break
        chosen.append(at)
        nearest = np.maximum(nearest, x @ x[at])
    return x[chosen]


def angles(x: np.ndarray, norm: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """To each direction; a vector of zeros stands at a right angle to all, which its norm of zero makes harmless."""
    x, refs = _same_width(x, refs)
    return np.arccos(np.clip(x @ refs.T / np.maximum(norm, 1e-300)[:, None], -1, 1))


def indexed(rows: DataFrame, refs: np.ndarray) -> DataFrame:
    """``rows`` with norm, direction and angle, written: the stored angles."""
    held = rows.sparkSession.sparkContext.broadcast(refs)  # DIRECTIONS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(2))
                norm = np.linalg.norm(x, axis=1)
                theta = angles(x, norm, held.value)
                cell = theta.argmin(axis=1)
                more = [pa.array(norm), pa.array(cell.astype(np.int32)), pa.array(theta[np.arange(len(cell)), cell])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "norm", "cell", "angle"])

    bounded_batches(rows.sparkSession)
    return written(rows.mapInArrow(run, "vec_id bigint, label bigint, vector array<bigint>, norm double, cell int, angle double"), "angles")


class Block:
    """Rows of a task: sorted by direction and angle, with the smallest and largest norm of each direction."""

    def __init__(self, table: pa.Table):
        cell, angle = table["cell"].to_numpy(), table["angle"].to_numpy()
        order = np.lexsort((angle, cell))
        self.x = _matrix(table["vector"])[order]
        self.cell, self.angle, self.norm = cell[order], angle[order], table["norm"].to_numpy()[order]
        self.id, self.label = table["vec_id"].to_numpy()[order], table["label"].to_numpy()[order]
        self.cells, first = np.unique(self.cell, return_index=True)
        self.spans = list(zip(first.tolist(), [*first[1:].tolist(), len(order)]))

    def windows(self, number: int, norm: np.ndarray, theta: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Per anchor the first and last row of a direction whose score bounds meet [least, most]."""
        a, z = self.spans[number]
        small, large = self.norm[a:z].min() * norm, self.norm[a:z].max() * norm
        least, most = least - RELATIVE * large - 1, most + RELATIVE * large + 1
        with np.errstate(divide="ignore", invalid="ignore"):
            # angles at which the cosine alone already decides: with the norm that allows most
            widest = np.arccos(np.clip(np.nan_to_num(least / np.where(least > 0, large, small), nan=-1.0, posinf=2.0, neginf=-2.0), -1, 1))
            closest = np.arccos(np.clip(np.nan_to_num(most / np.where(most > 0, small, large), nan=1.0, posinf=2.0, neginf=-2.0), -1, 1))
        none = (least > large) | (most < -large)
        from_angle = np.maximum(theta - widest, closest - theta) - ANGLE
        low = a + np.searchsorted(self.angle[a:z], from_angle, "left")
        high = a + np.searchsorted(self.angle[a:z], theta + widest + ANGLE, "right")
        high = np.where(none, low, high)
        return np.stack([low, np.maximum(low, high)])


class Ranking:
    """The first few (score, vec_id) of each of a number of keys so far; ``last`` is the score to beat or to tie with."""

    def __init__(self, keys: int, places: int):
        self.score, self.id = np.zeros((keys, places), np.int64), np.zeros((keys, places), np.int64)
        self.count, self.last = np.zeros(keys, np.int64), np.full(keys, NOTHING)

    def add(self, key: np.ndarray, score: np.ndarray, number: np.ndarray) -> None:
        if not len(key):
            return
        places = self.score.shape[1]
        touched = np.unique(key)
        held = np.arange(places) < self.count[touched, None]
        key = np.concatenate((np.repeat(touched, self.count[touched]), key))
        score = np.concatenate((self.score[touched][held], score))
        number = np.concatenate((self.id[touched][held], number))
        order = np.lexsort((number, -score, key))
        key, score, number = key[order], score[order], number[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (number[1:] != number[:-1])
        key, score, number = key[new], score[new], number[new]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        top = rank < places
        self.score[key[top], rank[top]], self.id[key[top], rank[top]] = score[top], number[top]
        np.maximum.at(self.count, key[top], rank[top] + 1)
        full = rank == places - 1
        self.last[key[full]] = score[full]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, score and vec_id of all that are held."""
        held = np.arange(self.score.shape[1]) < self.count[:, None]
        return np.repeat(np.arange(len(self.count)), self.count), self.score[held], self.id[held]


class Anchors:
    """A file of anchors with their angles to all directions and, for negatives, the bands of their positives."""

    def __init__(self, table: pa.Table, refs: np.ndarray):
        self.row, self.id = table["anchor"].to_numpy(), table["vec_id"].to_numpy()
        self.label, self.norm = table["label"].to_numpy(), table["norm"].to_numpy()
        self.x, self.cell = _matrix(table["vector"]), table["cell"].to_numpy()
        self.theta = angles(self.x, self.norm, refs)
        if "positives" in table.column_names:
            lists = table["positives"].combine_chunks()
            self.count = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            self.first = np.cumsum(self.count) - self.count
            flat = lists.flatten()
            self.positive, self.score = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "score"))
            self.low, self.high = -_share(-self.score, LOW), _share(self.score, HIGH)


def _share(score: np.ndarray, percent: int) -> np.ndarray:
    """floor(percent * score / 100) without overflow."""
    return score // 100 * percent + score % 100 * percent // 100


def _pieces(rows: Block, anchors: Anchors, bounds) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """The windows of all anchors, scored: anchors, first row, scores, and which of these are inside an anchor's own window.

    ``bounds`` gives the least and the most score that anchors look for now. Each anchor meets the rows of its own direction first.
    """
    for own in (True, False):
        for number, cell in enumerate(rows.cells.tolist()):
            some = np.flatnonzero((anchors.cell == cell) == own)
            least, most = bounds(some)
            low, high = rows.windows(number, anchors.norm[some], anchors.theta[some, cell], least, most)
            some, low, high = (v[high > low] for v in (some, low, high))
            order = np.argsort(low, kind="stable")
            some, low, high = some[order], low[order], high[order]
            at = 0
            while at < len(some):
                upto = at + max(1, SCORES // int(high[at:].max() - low[at]))
                a, z = int(low[at]), int(high[at:upto].max())
                x, y = _same_width(anchors.x[some[at:upto]], rows.x[a:z])
                scores = scores_of(x, y, anchors.norm[some[at:upto]].max() * rows.norm[a:z].max())
                place = np.arange(a, z)
                yield some[at:upto], a, scores, (place >= low[at:upto, None]) & (place < high[at:upto, None])
                at = upto


def best_positives(rows: Block, anchors: Anchors) -> tuple[np.ndarray, ...]:
    """(anchor, score, vec_id): for each anchor its first rows of the same label in the block."""
    best = Ranking(len(anchors.id), POSITIVES)

    def bounds(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = best.last[some]
        return np.where(last == NOTHING, -np.inf, last), np.full(len(some), np.inf)

    for some, first, scores, inside in _pieces(rows, anchors, bounds):
        here = slice(first, first + scores.shape[1])
        inside &= (scores >= best.last[some, None]) & (anchors.label[some, None] == rows.label[here])
        i, j = np.nonzero(inside & (anchors.id[some, None] != rows.id[here]))
        best.add(some[i], scores[i, j], rows.id[first + j])
    key, score, number = best.found()
    return anchors.row[key], score, number


def best_negatives(rows: Block, anchors: Anchors) -> tuple[np.ndarray, ...]:
    """(anchor, place of the positive, score, vec_id): for each positive its first rows of other labels in the block."""
    best = Ranking(len(anchors.positive), NEGATIVES)

    def bounds(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least, most = np.full(len(some), np.inf), np.full(len(some), -np.inf)
        for place in range(int(anchors.count.max(initial=0))):
            has = anchors.count[some] > place
            key = anchors.first[some[has]] + place
            least[has] = np.minimum(least[has], np.maximum(anchors.low[key], best.last[key]))
            most[has] = np.maximum(most[has], anchors.high[key])
        return least, most

    for some, first, scores, inside in _pieces(rows, anchors, bounds):
        inside &= anchors.label[some, None] != rows.label[first : first + scores.shape[1]]
        for place in range(int(anchors.count[some].max(initial=0))):
            has = np.flatnonzero(anchors.count[some] > place)
            key = anchors.first[some[has]] + place
            least = np.maximum(anchors.low[key], best.last[key])
            i, j = np.nonzero(inside[has] & (scores[has] >= least[:, None]) & (scores[has] <= anchors.high[key, None]))
            best.add(key[i], scores[has][i, j], rows.id[first + j])
    key, score, number = best.found()
    owner = np.repeat(np.arange(len(anchors.count)), anchors.count)[key]
    return anchors.row[owner], key - anchors.first[owner], score, number


def _against(index: DataFrame, anchors: DataFrame, refs: np.ndarray, best, names: list[str]) -> DataFrame:
    """``best`` of every block of rows of the index and every file of ``anchors``, a written table."""
    files = anchors.inputFiles()
    held = index.sparkSession.sparkContext.broadcast((files, refs))

    def meet(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, (paths, directions) = Block(pa.Table.from_batches(batches)), held.value
        for path in paths:
            with opened(path) as source:
                asked = Anchors(pq.read_table(source), directions)
            if len(asked.id):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in best(rows, asked)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_rows, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held_rows.append(batch)
                n += batch.num_rows
            if n >= ROWS:
                yield from meet(held_rows)
                held_rows, n = [], 0
        if held_rows:
            yield from meet(held_rows)

    bounded_batches(index.sparkSession)
    return index.mapInArrow(run, ", ".join(f"{name} bigint" for name in names))


def _first(rows: DataFrame, keys: list[str], places: int) -> DataFrame:
    """The first ``places`` different (score, vec_id) of each key, with their ``rank``; cut in the tasks and once more after the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= places)
    return ranked.dropDuplicates([*keys, "rank"])


def mine(embeddings: DataFrame, is_anchor: Column, label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``embeddings`` (vec_id, embedding,
    label) where ``is_anchor`` holds; ``label`` replaces the column of that name."""
    rows = scaled(embeddings, label)
    refs = directions(rows)
    index = indexed(rows, refs)
    anchors = index.where(is_anchor).dropDuplicates(["vec_id", "label", "vector"])
    anchors = written(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    positives = _first(_against(index, anchors, refs, best_positives, ["anchor", "score", "vec_id"]), ["anchor"], POSITIVES)
    listed = positives.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    asked = written(anchors.join(listed, "anchor"), "positives")  # POSITIVES structs at most in a list
    negatives = _against(index, asked, refs, best_negatives, ["anchor", "place", "score", "vec_id"])
    positive = asked.select("anchor", F.col("vec_id").alias("anchor_id"), F.posexplode("positives").alias("place", "positive"))
    return (
        _first(negatives, ["anchor", "place"], NEGATIVES)
        .join(positive, ["anchor", "place"])
        .select(
            "anchor_id",
            F.col("positive.vec_id").alias("positive_id"),
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("positive.score").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )
