"""Language by prediction by partial matching: exact code lengths under one byte context tree per language.

A tree counts which byte follows each context of up to ``ORDER`` bytes. The probability of a byte is its share of the longest context
that was seen; a byte that is new there costs an escape (share: distinct followers over their number plus the total) and is looked
up in the context one byte shorter, down to a uniform choice of 256. Counts are frozen after learning, so the code length
of a byte follows from the ``ORDER`` bytes before it alone, and whole texts are scored by table lookups.

Grams are counted over all texts that may be learnt from, in the tasks that read them, and every gram of every language is in its tree. Trees are
sorted arrays of the grams that exist, for each order, with their code lengths. They are files in the shared folder, in blocks of whole
languages with about ``BLOCK`` grams: a task holds one block, and texts go through one block after another, keeping the best
language and the sum of the weights of all. The number of languages has no bound; one tree is as large as its language's grams.

Nothing but the text enters a prediction. ``und`` with score 0: a null text, one without letters, or nothing learnt. The score
is the posterior of the language found, from code lengths per byte. Ties go to the smallest value. Repeated rows each give a row. Rows
with a null id are held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import BATCH_BYTES, Blocks, held, in_blocks, in_fold, map_chunks, map_texts, read_files, written

PARTS, HELD = 4, 2
ORDER = 3
#: Grams of the languages that are held at once; a language with more is a block of its own.
BLOCK = 4 << 20
#: Bytes of text that are worked on at once, and those that go through the blocks together where there are several.
PIECE, CHUNK = 1 << 20, 16 << 20
#: How far a posterior trusts a text: bytes that count as independent evidence at most.
EVIDENCE = 40.0
#: A text of which no language is this likely is of none.
LEAST = 0.5
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def _grams(data: bytes, before: bytes = b" " * ORDER) -> np.ndarray:
    """For each byte the ORDER bytes before it and itself as a number; spaces stand before a text."""
    b = np.frombuffer(before + data, np.uint8).astype(np.uint32)
    n = len(data)
    key = b[:n].copy()
    for k in range(1, ORDER + 1):
        key = (key << np.uint32(8)) | b[k : k + n]
    return key


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The grams of texts, ``PIECE`` bytes or so at a time: which texts, where each begins, all grams. A long text is in several."""
    rows, starts, made, size = [], [], [], 0
    for row, data in enumerate(texts):
        for at in range(0, len(data), PIECE):
            part = data[at : at + PIECE]
            rows.append(row)
            starts.append(size)
            made.append(_grams(part, data[at - ORDER : at] if at else b" " * ORDER))
            size += len(part)
            if size >= PIECE:
                yield np.array(rows), np.array(starts), np.concatenate(made)
                rows, starts, made, size = [], [], [], 0
    if made:
        yield np.array(rows), np.array(starts), np.concatenate(made)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): grams of ORDER + 1 bytes of all texts that may be learnt from. Tasks hand on sums."""

    def count(batch: pa.RecordBatch) -> pa.Table:
        texts: dict[str, list[bytes]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts.setdefault(lang, []).append((text or "").encode())
        made = []
        for lang, own in texts.items():
            for _, _, grams in _pieces(own):
                found, n = np.unique(grams, return_counts=True)
                names = pa.DictionaryArray.from_arrays(np.zeros(len(found), np.int32), pa.array([lang])).cast(pa.string())
                made.append(pa.table({"lang": names, "gram": found.astype(np.int64), "n": n}))
        return pa.concat_tables(made) if made else pa.table({"lang": pa.array([], pa.string()), "gram": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})

    known = docs.where(~in_fold("doc_id", PARTS, HELD) & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN))
    known = known.where("text is not null and text != ''").select("text", F.col("lang").cast("string"))
    counted = map_texts(known, count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Tree:
    """One language: for every order the grams that exist and their code lengths, the contexts and those of an escape."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.grams, self.bits, self.contexts, self.escapes = [], [], [], []
        for k in range(ORDER + 1):  # a context of k bytes and the byte after it
            kinds, which = np.unique(grams & np.uint32((1 << (8 * (k + 1))) - 1), return_inverse=True)
            counts = np.bincount(which, n)
            contexts, owner, distinct = np.unique(kinds >> np.uint32(8), return_inverse=True, return_counts=True)
            total = np.bincount(owner, counts) + distinct
            self.grams.append(kinds)
            self.bits.append(np.log2(total[owner]) - np.log2(counts))
            self.contexts.append(contexts)
            self.escapes.append(np.log2(total) - np.log2(distinct))

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits that each gram's last byte costs after the others."""
        cost, live = np.zeros(len(grams)), np.arange(len(grams))
        for k in range(ORDER, -1, -1):
            wanted = grams[live] & np.uint32((1 << (8 * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], wanted), len(self.grams[k]) - 1)
            known = self.grams[k][at] == wanted
            cost[live[known]] += self.bits[k][at[known]]
            live, wanted = live[~known], wanted[~known] >> np.uint32(8)
            at = np.minimum(np.searchsorted(self.contexts[k], wanted), len(self.contexts[k]) - 1)
            seen = self.contexts[k][at] == wanted
            cost[live[seen]] += self.escapes[k][at[seen]]
        cost[live] += 8
        return cost


def read_trees(paths: list[str]) -> dict[int, Tree]:
    """The trees of a block, by the number of their language."""
    table = read_files(paths, ["number", "gram", "n"])
    number, gram, n = (table[c].to_numpy() for c in ("number", "gram", "n"))
    return {int(k): Tree(gram[number == k].astype(np.uint32), n[number == k]) for k in np.unique(number)}


class Trees:
    """The languages, in order, and the blocks that hold their trees."""

    def __init__(self, langs: list[str], blocks: Blocks):
        self.langs, self.blocks = langs, blocks

    @property
    def chunk(self) -> int:
        return CHUNK if len(self.blocks) > 1 else BATCH_BYTES

    def code_lengths(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """Language by language, the bits that its frozen tree needs for each text."""
        pieces = None
        for _, paths in self.blocks:
            block = held("language", "trees", paths, read_trees)
            totals = {number: np.zeros(len(texts)) for number in block}
            if pieces is None or len(self.blocks) > 1:
                pieces = _pieces(texts)
            for row, start, grams in pieces:
                kinds, which = np.unique(grams, return_inverse=True)
                for number, tree in block.items():
                    np.add.at(totals[number], row, np.add.reduceat(tree.code_lengths(kinds)[which], start))
            yield from totals.items()

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text."""
        asked = [i for i, t in enumerate(texts) if t and self.langs and LETTER.search(t)]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not asked:
            return names, scores
        data = [texts[i].encode() for i in asked]
        length = np.array([len(d) for d in data], float)
        trust = np.minimum(length, EVIDENCE) / length
        best, chosen, weights = np.full(len(data), np.inf), np.zeros(len(data), int), np.zeros(len(data))
        for number, bits in self.code_lengths(data):  # in order of the languages, so ties stay with the first
            gain = np.exp2(-np.abs(bits - best) * trust)  # 0 against nothing
            better = bits < best
            weights = np.where(better, weights * gain + 1, weights + gain)
            best, chosen = np.where(better, bits, best), np.where(better, number, chosen)
        for i, number, weight in zip(asked, chosen.tolist(), weights):
            names[i], scores[i] = self.langs[number], 1 / weight
        return names, scores


def learn(docs: DataFrame) -> Trees:
    """The trees of all languages, as files."""
    counted = written(gram_counts(docs), "grams")
    langs = sorted(row.lang for row in counted.select("lang").distinct().collect())  # a name for each language
    if not langs:
        return Trees([], [])
    numbers = docs.sparkSession.createDataFrame(list(enumerate(langs)), "number long, lang string")
    numbered = written(counted.join(numbers, "lang").select("number", "gram", "n"), "numbered")
    return Trees(langs, in_blocks(numbered, "number", BLOCK, "trees"))


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs`` (doc_id, text)."""

    def per_chunk(chunk: pa.Table) -> pa.Table:
        names, scores = trees.predict(chunk["text"].to_pylist())
        return pa.table({"doc_id": chunk["doc_id"], "lang_pred": pa.array(names, pa.string()), "score": scores})

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = map_chunks(texts, per_chunk, "doc_id bigint, lang_pred string, score double", trees.chunk)
    return made.select("doc_id", in_fold("doc_id", PARTS, HELD).alias("held_out"), "lang_pred", "score")


def drop_unknown(docs: DataFrame, trees: Trees, least: float = LEAST, wanted: set[str] | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is found with a posterior of ``least`` or more and is ``wanted``, with all their columns."""
    at = docs.columns.index("text")

    def per_chunk(chunk: pa.Table) -> pa.Table:
        names, scores = trees.predict(chunk.column(at).to_pylist())
        return chunk.filter(pa.array([n != UNKNOWN and p >= least and (wanted is None or n in wanted) for n, p in zip(names, scores)]))

    return map_chunks(docs, per_chunk, docs.schema, trees.chunk)
