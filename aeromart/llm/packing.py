"""Packing into sequences of fixed length, with the sources of the documents mixed by deficit round-robin.

Each source is a queue of tokens: its documents in the order of the stored rows, each with its closing id. A round gives every
queue a quantum of tokens, its target share of a part of one window; what a queue may send but has not sent yet is its deficit, which it
keeps for the next rounds and windows. A queue sends packets of ``PACKET`` tokens, as many as its deficit covers, so a rare source
sends one packet every few rounds instead of single tokens in each. The rounds, queue after queue, are one long
stream, and window k, which is sequence k, takes its tokens from k * ``SEQUENCE`` on; inside a window those of each queue stand together. Every
sequence is full but the last one, and every window keeps to the targets up to about two packets per source, however long
the stream, until queues run dry.

The state of the round-robin need not be passed along: after r rounds a queue has sent min(size, packets covered by r quanta), in
whole numbers, so its deficit at any round, and with it the part of any window that it fills, follows from the sizes of all
queues. Tasks write their ids with the tokens of the same queue before each row in the same task; the sum over
(queue, task) gives the place in the queue where each task starts. Any task then places its rows alone.

Targets are the sources' shares of the corpus, or weights that are given; then a source without a weight keeps its share, and when a
queue runs dry the others share its part. Ids come from tiktoken, built from the tokenizer file itself, if the file lists its merges in
the order of their ids, else (and for texts that it refuses) from the tokenizers library; tests hold them equal.

Null texts are empty: they are their closing id. A null source is the source ''. Repeated rows and ids each get their own pieces. Beyond
``QUEUES`` sources the smaller ones share one queue. An empty table has no pieces. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aeromart.llm.bpe import byte_of_char
from aeromart.llm.common import bounded_batches, written

SEQUENCE = 2048
PACKET = 16
#: Rounds for one window.
TURNS = 32
CLOSING = 1
#: Sources that get a queue of their own; what is sent to the tasks are three numbers for each.
QUEUES = 4096
REST = "\0rest"
#: Quanta are whole numbers of 2^-16 tokens.
POINT = 16
#: Queues times windows that are worked on at once.
CELLS = 1 << 20

# Fixed value: the word pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[Callable[[str], np.ndarray], int]:
    """Text to ids as the tokenizers library gives them without special tokens, and the number of ids."""
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()

    def slow(text: str) -> np.ndarray:
        return np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    size = library.get_vocab_size()
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    vocab = spec["model"].get("vocab")
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"].get("merges", [])]
    byte_level = (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and isinstance(vocab, dict)
    if not byte_level or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
        return slow, size
    made = [vocab[a + b] for a, b in merges]
    if made != sorted(set(made)):
        return slow, size
    to_byte = byte_of_char()
    ranks = {bytes(to_byte[c] for c in text): n for text, n in vocab.items() if text not in added}
    quick = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def ids(text: str) -> np.ndarray:
        try:
            return quick.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its pattern gives up on millions of blanks in a row
            return slow(text)

    return ids, size


def tokenise(docs: DataFrame, path: str, closing: int = CLOSING) -> DataFrame:
    """(doc_id, queue, part, before, n, ids), written: per row its ids and the tokens of the same queue before it in its task."""
    bounded_batches(docs.sparkSession)
    width = np.uint16 if max(encoder(path)[1], closing + 1) <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, _ = encoder(path)
        part = TaskContext.get().partitionId()
        sent: dict[str, int] = {}
        for batch in batches:
            queues = batch.column(2).to_pylist()
            data, before, counts = [], [], []
            for text, queue in zip(batch.column(1).to_pylist(), queues):
                found = ids(text) if text else np.zeros(0, width)
                data.append(found.astype(width).tobytes() + width(closing).tobytes())
                counts.append(len(found) + 1)
                before.append(sent.get(queue, 0))
                sent[queue] = before[-1] + counts[-1]
            parts = pa.array([part] * len(queues), pa.int32())
            columns = [batch.column(0), batch.column(2), parts, pa.array(before, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(data, pa.binary())], names=NAMES)

    source = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", source.alias("queue"))
    schema = "doc_id bigint, queue string, part int, before bigint, n bigint, ids binary"
    return written(rows.mapInArrow(run, schema), "ids")


NAMES = ["doc_id", "queue", "part", "before", "n", "ids"]


class Rounds:
    """The whole round-robin in two numbers per queue, its size and its quantum; queues follow one another by name."""

    def __init__(
        self, sizes: Mapping[str, int], targets: Mapping[str, float] | None = None, window: int = SEQUENCE, packet: int = PACKET
    ):
        self.names = sorted(sizes)
        self.number = {name: i for i, name in enumerate(self.names)}
        self.size = np.array([sizes[name] for name in self.names], np.int64)
        self.total, self.window = int(self.size.sum()), window
        self.packet, self.unit = packet, packet << POINT
        shares = self.size / max(self.total, 1)
        if targets:
            shares = np.array([float(targets.get(name, share)) for name, share in zip(self.names, shares)])
        shares = shares / max(shares.sum(), 1e-300)
        self.quantum = np.maximum(np.rint(shares * (window << POINT) / TURNS), 1).astype(np.int64)
        self.rounds = int(self.round_of(np.arange(len(sizes)), (self.size - 1) // packet).max(initial=0)) + 1

    def sent(self, queue: int | np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Tokens of a queue in the first ``rounds`` rounds: whole packets, the last one as long as it is."""
        return np.minimum(rounds * self.quantum[queue] // self.unit * self.packet, self.size[queue])

    def round_of(self, queue: np.ndarray, packet: np.ndarray) -> np.ndarray:
        """The round that sends a packet: the first one whose quanta cover it, counted from 0."""
        return -(-(packet + 1) * self.unit // self.quantum[queue]) - 1

    def place(self, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Where in the stream the ``token``-th token of a queue stands: behind what the other queues have sent before."""
        number, at = self.round_of(queue, token // self.packet), token.copy()
        for other in range(len(self.names)):
            # those before it in the round have had their turn in this one
            at += np.where(queue == other, 0, self.sent(other, number + (queue > other)))
        return at

    def filled(self, windows: np.ndarray) -> np.ndarray:
        """Per queue and window, the tokens of the queue in all windows before it."""
        ends = np.minimum(windows * self.window, self.total)
        every = np.arange(len(self.names))[:, None]
        # the last round that starts before the end of the window: a guess as if no queue were dry, and halves in turn
        low, high, step = np.zeros(len(ends), np.int64), np.full(len(ends), self.rounds, np.int64), 0
        begun = np.zeros(len(ends), np.int64)
        while (low < high).any():
            ahead = (ends - begun) * TURNS // self.window + 1 if step % 2 == 0 else (high - low + 1) // 2
            guess, step = np.minimum(low + np.maximum(ahead, low < high), high), step + 1
            sums = self.sent(every, guess[None]).sum(axis=0)
            over = sums > ends
            low, high, begun = np.where(over, low, guess), np.where(over, guess - 1, high), np.where(over, begun, sums)
        before, after = self.sent(every, low[None]), self.sent(every, low[None] + 1)
        room = ends - before.sum(axis=0) - (np.cumsum(after - before, axis=0) - (after - before))
        return before + np.clip(room, 0, after - before)


def cut(rounds: Rounds, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """The pieces of rows of ``n`` tokens from ``first`` on in their queues: row, start in the row, window, offset there, length."""
    low = rounds.place(queue, first) // rounds.window
    high = rounds.place(queue, first + n - 1) // rounds.window
    spans = high - low + 1
    row = np.repeat(np.arange(len(n)), spans)
    window = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(spans) - spans, spans)
    kinds, which = np.unique(window, return_inverse=True)
    begin, end, offset = (np.zeros(len(row), np.int64) for _ in range(3))
    step = max(1, CELLS // max(len(rounds.names), 1))
    order = np.argsort(which, kind="stable")
    edges = np.searchsorted(which[order], np.arange(0, len(kinds) + step, step))
    for at, (a, z) in enumerate(zip(edges, edges[1:])):
        mine = order[a:z]
        if not len(mine):
            continue
        some, q = kinds[at * step : (at + 1) * step], queue[row[mine]]
        mark, next_mark = rounds.filled(some), rounds.filled(some + 1)
        ahead = np.cumsum(next_mark - mark, axis=0) - (next_mark - mark)
        column = which[mine] - at * step
        begin[mine] = np.maximum(mark[q, column], first[row[mine]])
        end[mine] = np.minimum(next_mark[q, column], (first + n)[row[mine]])
        offset[mine] = ahead[q, column] + begin[mine] - mark[q, column]
    some = np.flatnonzero(end > begin)
    row = row[some]
    return row, begin[some] - first[row], window[some], offset[some], (end - begin)[some]


def pack(
    docs: DataFrame, path: str, targets: Mapping[str, float] | None = None, sequence: int = SEQUENCE, packet: int = PACKET
) -> DataFrame:
    """The pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset, source) of all rows of ``docs`` (doc_id, text, source).

    ``ids`` are unsigned little-endian numbers of 32 bits. Sequences are ``sequence`` long but for the last one.
    """
    spark = docs.sparkSession
    stored = tokenise(docs, path)
    sent = stored.groupBy("queue", "part").agg(F.max(F.col("before") + F.col("n")).alias("sent"))
    sent = written(sent, "sent")  # one row for each queue and task
    largest = sent.groupBy("queue").agg(F.sum("sent").alias("size")).orderBy(F.desc("size"), "queue").limit(QUEUES)
    sizes = {row.queue: row.size for row in largest.collect()}
    if len(sizes) == QUEUES:
        known = spark.createDataFrame([(name,) for name in sizes], "queue string")
        small = sent.join(known, "queue", "left_anti").agg(F.sum("sent").alias("size")).first().size
        sizes |= {REST: small} if small else {}
    # rows of one queue and task follow one another; several queues that share one follow by name
    order = Window.partitionBy("shared").orderBy("part", "queue").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("queue").isin(list(sizes)) if REST in sizes else F.lit(True)
    starts = sent.withColumn("shared", F.when(own, F.col("queue")).otherwise(REST))
    starts = starts.select("queue", "part", "shared", F.coalesce(F.sum("sent").over(order), F.lit(0)).alias("ahead"))
    starts = written(starts, "starts")  # of a known size, so Spark broadcasts it only if that is small
    rows = stored.join(starts, ["queue", "part"])
    rows = rows.select("doc_id", "shared", (F.col("before") + F.col("ahead")).alias("first"), "n", "ids")
    rounds = spark.sparkContext.broadcast(Rounds(sizes, targets, sequence, packet))  # QUEUES + 1 queues at most
    width = np.uint16 if max(encoder(path)[1], CLOSING + 1) <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = rounds.value
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(1).dictionary_encode()
            queue = np.array([made.number[name] for name in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy()]
            first, n = (batch.column(i).to_numpy() for i in (2, 3))
            row, start, window, offset, length = cut(made, queue, first, n)
            raw = [np.frombuffer(b, width).astype("<u4") for b in batch.column(4).to_pylist()]
            ids = [raw[r][s : s + m].tobytes() for r, s, m in zip(row.tolist(), start.tolist(), length.tolist())]
            took = pa.array(row)
            columns = [batch.column(0).take(took), pa.array(start), pa.array(length), pa.array(ids, pa.binary())]
            columns += [pa.array(n[row]), pa.array(window), pa.array(offset), batch.column(1).take(took)]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "source"]
            yield from pa.Table.from_arrays(columns, names=names).to_batches(max_chunksize=20_000)

    schema = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, source string"
    return rows.mapInArrow(run, schema)


def sequences(pieces: DataFrame, sequence: int = SEQUENCE, padding: int = 0) -> DataFrame:
    """(sequence_id, tokens, ids): the packed sequences themselves, padded to ``sequence`` unless they hold a power of two."""
    parts = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("tokens"))
    text = F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")
    lone = F.expr("bit_count(tokens) = 1")
    gap = F.when(lone, 0).otherwise(sequence - F.col("tokens")).cast("int")
    filled = F.concat(text, F.repeat(F.lit(int(padding).to_bytes(4, "little").hex().upper()), gap))
    return parts.select("sequence_id", "tokens", F.unhex(filled).alias("ids"))


def digests(pieces: DataFrame) -> DataFrame:
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "source")
