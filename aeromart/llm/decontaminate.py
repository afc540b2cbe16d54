"""Benchmark decontamination: one Aho-Corasick automaton over the windows of the benchmark, each text scanned once.

Texts are lower-cased (A-Z) and cut into words: ASCII letters and digits, and everything beyond ASCII. A pattern is a window of
``WINDOW`` words (all words of a shorter item) between spaces, so it matches whole words only. Match ends give word
positions, and word positions give offsets in the original text.

Windows are cut in the tasks that read the benchmark and written as files, in blocks of about ``BLOCK_BYTES`` of patterns, by a hash
of the pattern. A task builds the automaton of one block at a time; a benchmark of ordinary size is one block, built once by each
Python worker, and of a larger one every block goes over ``CHUNK`` bytes of texts before the next is built. Nothing of it
passes through the driver.

Null and empty texts have no words and are never contaminated. Items without words have no window. Items without id hit words like
others, but nothing can name them, so they are not among the items; items that share an id are one item. Repeated
document rows each give a row.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import BATCH_BYTES, Blocks, held, in_blocks, map_chunks, map_texts, read_files, written

WINDOW = 10
BLOCK_BYTES, CHUNK = 32 << 20, 64 << 20
#: What a pattern costs beside its bytes.
OVERHEAD = 64
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: Byte by byte: A-Z to a-z, bytes of words to themselves, all others to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def windows_of(text: str | None, window: int = WINDOW) -> set[bytes]:
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def patterns(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(pattern, item_id, part): the different windows of all items, and the number that blocks are made of."""

    def cut(batch: pa.RecordBatch) -> pa.Table:
        ids, found = [], []
        for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = windows_of(text, window)
            ids += [item_id] * len(own)
            found += own
        return pa.table({"pattern": pa.array(found, pa.binary()), "item_id": pa.array(ids, pa.int64())})

    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string"))
    made = map_texts(items, cut, "pattern binary, item_id bigint").distinct()
    return made.withColumn("part", F.pmod(F.xxhash64("pattern"), F.lit(1 << 16)))


class Scanner:
    """The automaton of one block."""

    def __init__(self, patterns: dict[bytes, list[int]]):
        self.automaton = ahocorasick.Automaton()
        for pattern, ids in patterns.items():
            self.automaton.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, ids))
        if patterns:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, np.ndarray, set[int]]:
        """Number of words, the positions of hit words, the items found."""
        words = words_of(text)
        items: set[int] = set()
        ends, lengths = [], []
        if not len(self.automaton):
            return len(words), np.empty(0, np.int64), items
        joined = f" {b' '.join(words).decode('latin-1')} "
        for end, (length, ids) in self.automaton.iter(joined):
            ends.append(end)
            lengths.append(length)
            items.update(ids)
        if not ends:
            return len(words), np.empty(0, np.int64), items
        # the spaces before and after each word; the one that ends a match follows the match's last word
        spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
        last = np.searchsorted(spaces, np.asarray(ends))
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, last - np.asarray(lengths), 1)
        np.add.at(change, last, -1)
        return len(words), np.flatnonzero(np.cumsum(change[:-1]) > 0), items


def spans_of(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as (start, end) offsets, in code points of the original text."""
    at = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
    if not len(hit):
        return []
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return [(at[r[0]][0], at[r[-1]][1]) for r in runs]


_LOWER = {c: c + 32 for c in range(65, 91)}
def _read(paths: list[str]) -> Scanner:
    table = read_files(paths, ["pattern", "item_id"])
    block: dict[bytes, list[int]] = {}
    for pattern, item_id in zip(table["pattern"].to_pylist(), table["item_id"].to_pylist()):
        ids = block.setdefault(pattern, [])
        if item_id is not None:
            ids.append(item_id)
    return Scanner(block)


def _scanner(paths: list[str]) -> Scanner:
    """One automaton per Python worker, of one block at a time."""
    return held("benchmark", "scanner", paths, _read)


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Blocks:
    made = written(patterns(benchmark, window), "patterns")
    return in_blocks(made, "part", block_bytes, "blocks", F.octet_length("pattern") + OVERHEAD)


def _chunk(blocks: Blocks) -> int:
    return CHUNK if len(blocks) > 1 else BATCH_BYTES


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, spans: bool = False
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated; with ``spans`` also the hit offsets."""
    blocks = _blocks(benchmark, window, block_bytes)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"] + ["spans"] * spans

    def per_chunk(chunk: pa.Table) -> pa.Table:
        texts = chunk["text"].to_pylist()
        found = [(len(words_of(t)), np.empty(0, np.int64), set()) for t in texts] if not blocks else []
        found = found or [(0, np.empty(0, np.int64), set())] * len(texts)
        for _, paths in blocks:
            scanner = _scanner(paths)
            found = [
                (n, np.union1d(hit, more) if len(more) else hit, items | new if new else items)
                for (_, hit, items), (n, more, new) in zip(found, map(scanner.scan, texts))
            ]
        digest = [hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest() for _, _, items in found]
        columns = [
            chunk["doc_id"], pa.array([f[0] for f in found], pa.int64()), pa.array([len(f[1]) for f in found], pa.int64()),
            pa.array([len(f[2]) for f in found], pa.int64()), pa.array(digest, pa.string()),
            pa.array([len(f[1]) > 0 for f in found], pa.bool_()),
        ]
        if spans:
            pairs = [[list(s) for s in spans_of(t or "", f[1])] for t, f in zip(texts, found)]
            columns.append(pa.array(pairs, pa.list_(pa.list_(pa.int64()))))
        return pa.table(columns, names=names)

    schema = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_chunks(rows, per_chunk, schema + ", spans array<array<bigint>>" * spans, _chunk(blocks))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, with all their columns; one pass, no shuffle."""
    blocks = _blocks(benchmark, WINDOW, BLOCK_BYTES)
    at = docs.columns.index("text")

    def per_chunk(chunk: pa.Table) -> pa.Table:
        texts = chunk.column(at).to_pylist()
        clean = np.ones(len(texts), bool)
        for _, paths in blocks:
            scanner = _scanner(paths)
            clean &= [not len(scanner.scan(t)[1]) for t in texts]
        return chunk.filter(pa.array(clean))

    return map_chunks(docs, per_chunk, docs.schema, _chunk(blocks))
