"""SimHash near duplicates: fingerprints of word shingles, linked by a self-join of binary tries.

Fingerprint: words are runs without ASCII white space of the text with A-Z lowered; shingles are ``SHINGLE`` words; a bit is 1 if it is
set in over half of the shingles' XXH64 values (seed 42).

Join: two fingerprints at most ``MAX_BITS`` bits apart agree wholly on one of ``MAX_BITS + 1`` blocks of bits. So each
distinct fingerprint is put, once per block, at the root of a trie that holds the fingerprints with the same value of
that block (from ``WIDE`` distinct fingerprints on: the same value of two of ``MAX_BITS + 2`` blocks, which keeps the
tries small). The pairs of a trie are then found by walking pairs of its nodes together, bit by bit, adding one for
every differing bit and leaving the pair once the sum exceeds the budget. A trie of over ``TRIE`` fingerprints is dealt
into chunks by hash, and each pair of chunks is walked as one task, so no task holds an unbounded trie. A task hands on a
spanning forest of the links it found, never all pairs.

Components: equal fingerprints are one node; links are joined into components, and component_id is the smallest
document id in it. Null texts count as empty; texts without words have fingerprint zero and are linked like any other. Rows with a null id
take part and get the component_id of their group, null if no row of the group has an id. Repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import map_texts, written
from aeromart.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of a trie that one task walks, distinct fingerprints from which roots take two blocks, node pairs in memory.
TRIE = 16_384
WIDE = 1 << 21
PAIRS = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-1]]
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :])]
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, np.uint64)
    for at in range(0, len(values), 65_536):  # the bits of a very long text are counted piece by piece
        piece = values[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(counts * 2 > len(values)).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp: long, the 64 bits as a signed number) and the ``extra`` columns, which are long."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(made, np.uint64).view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *extra]
        )

    schema = ", ".join(f"{c} bigint" for c in ("doc_id", "fp", *extra))
    return map_texts(docs.select(F.col("doc_id").cast("bigint"), "text", *extra), per_batch, schema)


def blocks_of(bits: int, wide: bool) -> list[int]:
    """Masks of the bits that two fingerprints must share: one block of bits + 1, or two of bits + 2."""
    n = bits + 1 + wide
    edges = np.linspace(0, 64, n + 1).astype(int).tolist()
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [x | y for i, x in enumerate(single) for y in single[i + 1 :]] if wide else single


def _children(fps: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """For sorted fingerprints: where, within each node [lo, hi), the ones with ``bit`` set begin."""
    ones = np.concatenate(([0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))
    return hi - (ones[hi] - ones[lo])


def trie_links(groups: np.ndarray, side: np.ndarray, fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of one group, at most ``max_bits`` apart, in pieces of bounded size.

    Rows are sorted by (group, side, fp). A group with one side is joined with itself; in one with two sides (0 and 1),
    only pairs across are found. A node is a range of rows that share a prefix.
    """
    cuts = np.flatnonzero(np.concatenate(([True], (groups[1:] != groups[:-1]) | (side[1:] != side[:-1]), [True])))
    lo, hi = cuts[:-1], cuts[1:]
    two = np.flatnonzero((side[lo] == 0) & np.concatenate((groups[lo][1:] == groups[lo][:-1], [False])))
    crossed = np.zeros(len(lo), bool)
    crossed[two] = crossed[two + 1] = True
    own = np.flatnonzero(~crossed)
    first, second = np.concatenate((own, two)), np.concatenate((own, two + 1))
    stack = [(63, lo[first], hi[first], lo[second], hi[second], np.zeros(len(first), np.int64))]
    while stack:
        bit, a0, a1, b0, b1, apart = stack.pop()
        same = a0 == b0
        size = (a1 - a0) * (b1 - b0)
        live = (size > 0) & ~(same & (a1 - a0 < 2))
        leaf = live & ((size <= 16) | (bit < 0))
        if leaf.any():
            yield from _leaves(fps, a0[leaf], a1[leaf], b0[leaf], b1[leaf], max_bits)
        rest = live & ~leaf
        if not rest.any():
            continue
        a0, a1, b0, b1, apart, same = (x[rest] for x in (a0, a1, b0, b1, apart, same))
        am, bm = _children(fps, a0, a1, bit), _children(fps, b0, b1, bit)
        cross, twice = apart < max_bits, (apart < max_bits) & ~same
        parts = [
            (a0, am, b0, bm, apart), (am, a1, bm, b1, apart),
            tuple(x[cross] for x in (a0, am, bm, b1, apart + 1)), tuple(x[twice] for x in (am, a1, b0, bm, apart + 1)),
        ]
        made = [np.concatenate(x) for x in zip(*parts)]
        keep = (made[1] > made[0]) & (made[3] > made[2])
        made = [x[keep] for x in made]
        for at in range(0, len(made[0]), PAIRS):
            stack.append((bit - 1, *(x[at : at + PAIRS] for x in made)))


def _leaves(fps, a0, a1, b0, b1, max_bits):
    """All pairs of small nodes (or of nodes of equal fingerprints), compared whole."""
    size = (a1 - a0) * (b1 - b0)
    at = 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), PAIRS)) + at)
        n = size[at:upto]
        which = np.repeat(np.arange(at, upto), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        width = (b1 - b0)[which]
        i, j = a0[which] + k // width, b0[which] + k % width
        near = (np.bitwise_count(fps[i] ^ fps[j]) <= max_bits) & ((a0[which] != b0[which]) | (i < j))
        yield i[near], j[near]
        at = upto


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row reachable from each of n rows."""
    root = np.arange(n)
    for i, j in links:
        while len(i):
            a, b = root[i], root[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(above := root[root], root):
                root = above
    return root


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, trie: int = TRIE, wide: int = WIDE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join all that are ``max_bits`` or fewer apart."""
    if not 0 <= max_bits < 16:
        raise ValueError("max_bits must be from 0 to 15")
    masks = blocks_of(max_bits, distinct.count() >= wide)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    roots = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("way", "root"))
    sizes = roots.groupBy("way", "root").count().where("count > 1")
    # chunks of a trie: one, or so many that each has about ``trie`` fingerprints
    sizes = sizes.select("way", "root", F.ceil(F.col("count") / trie).cast("int").alias("chunks"))
    placed = roots.join(sizes, ["way", "root"])
    chunk = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks")).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda other: F.struct(
        F.least(chunk, other).alias("x"), F.greatest(chunk, other).alias("y"), (chunk > other).cast("int").alias("side")
    ))
    dealt = placed.select("fp", F.inline(F.when(F.col("chunks") == 1, F.array(F.struct(
        F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("side")))).otherwise(every)), "way", "root")
    dealt = dealt.select(F.xxhash64("way", "root", "x", "y").alias("node"), "side", "fp")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, side, fps in _whole_groups(batches, max(4 * trie, 200_000)):
            bits = fps.view(np.uint64)
            order = np.lexsort((bits, side, node))
            node, side, bits = node[order], side[order], bits[order]
            root = forest(len(bits), trie_links(node, side, bits, max_bits))
            linked = np.flatnonzero(root != np.arange(len(bits)))
            values = bits.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values[linked]), pa.array(values[root[linked]])], names=["a", "b"])

    return dealt.repartition("node").sortWithinPartitions("node").mapInArrow(walk, "a bigint, b bigint")


def _whole_groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns (node, side, fp) in pieces of ``least`` rows or more that never cut a node; rows come sorted by node."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        rows += batch.num_rows
        if rows >= least:
            columns = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut:
                yield tuple(c[:cut] for c in columns)
            held, rows = [[c[cut:] for c in columns]], len(columns[0]) - cut
    if rows:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first, root) from (fp, first), one row per fingerprint: the root is the same in a component."""
    roots = connected_components(near_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text)."""
    marked = written(fingerprints(docs, shingle), "fingerprints")
    rooted = _rooted(written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes"), max_bits)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(named, "root").select("fp", "component_id")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(named, "fp", "left").select("doc_id", text.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: of the smallest id in it, and of its texts the one with the smallest hash.

    An id with several texts is a document for each. Rows that repeat both id and text are copies like any others: one of them
    stays (if other columns differ, any). Of a group without any id, one row stays.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keys = ["_row_none", "_row_id", "_row_a", "_row_b"]
    keyed = docs.withColumns({
        "_row_none": F.col("doc_id").cast("bigint").isNull(), "_row_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)),
        "_row_a": F.xxhash64(text, F.lit(3)), "_row_b": F.xxhash64(F.lit(4), text),
    })
    marked = fingerprints(keyed, shingle, ("_row_id", "_row_a", "_row_b"))
    row = F.struct(F.col("doc_id").isNull().alias("_row_none"), *keys[1:])
    rooted = _rooted(written(marked.groupBy("fp").agg(F.min(row).alias("first")), "nodes"), max_bits)
    kept = written(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.*"), "kept")
    # repeated rows of one task become one before they are shuffled, so a row that is there many times is no hot key
    return keyed.dropDuplicates(keys).join(kept, keys, "left_semi").select(docs.columns)
