"""Byte-level BPE: encoding and decoding whole texts with a public vocabulary file.

A text is cut at the added tokens and then into words by the tokenizer's pattern. The bytes of a word start as one part
each; one contiguous array holds the part boundaries and the rank of every adjacent pair. The smallest rank is found by
scanning, its boundary deleted and the two neighbouring ranks refreshed, until no pair has a rank. A scan costs the
length of the word, so words of over ``SHORT`` bytes keep the same boundaries in a linked list with a heap; results are
equal. Words are memoised per Python worker, in a table that is emptied at ``MEMO`` words.

Null texts count as empty; empty texts have no ids. Repeated rows each give a row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import map_texts

SHORT = 256
MEMO = 400_000
NONE = 1 << 60

# Fixed values of byte-level BPE: the word pattern, and the printable characters that stand for themselves. It writes
# white space as the Unicode property, because the regex module's \s also has the separators U+001C to U+001F.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]


def byte_of_char() -> dict[str, int]:
    """The byte that each character of the vocabulary file stands for."""
    shifted = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Codec:
    """A vocabulary with its merges: words to ids, ids to bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = byte_of_char()
        plain = lambda text: bytes(to_byte[c] for c in text)
        self.id_of = {plain(text): number for text, number in spec["model"]["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(plain(a), plain(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {n: b for b, n in self.id_of.items()}
        self.bytes_of |= {n: text.encode() for text, n in self.added.items()}
        self.words = regex.compile(PATTERN)
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.memo: dict[str, tuple[int, str, str]] = {}

    def merge(self, word: bytes) -> list[int]:
        ends = self._scanned(word) if len(word) <= SHORT else self._heaped(word)
        return [self.id_of[word[a:b]] for a, b in zip(ends, ends[1:])]

    def _scanned(self, word: bytes) -> list[int]:
        """Part boundaries, by scanning the contiguous ranks for the smallest."""
        rank = self.rank
        at = list(range(len(word) + 1))
        ranks = [rank.get((word[i : i + 1], word[i + 1 : i + 2]), NONE) for i in range(len(word) - 1)]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            del at[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((word[at[i] : at[i + 1]], word[at[i + 1] : at[i + 2]]), NONE)
            if i:
                ranks[i - 1] = rank.get((word[at[i - 1] : at[i]], word[at[i] : at[i + 1]]), NONE)
        return at

    def _heaped(self, word: bytes) -> list[int]:
        """The same boundaries for long words: a heap of (rank, left part), stale entries skipped."""
        n, rank = len(word), self.rank
        after, before = list(range(1, n + 2)), list(range(-1, n))
        alive = [True] * (n + 1)

        def pair(i: int) -> int:
            j = after[i]
            return rank.get((word[i:j], word[j : after[j]]), NONE) if j < n else NONE

        heap = [(r, i) for i in range(n) if (r := pair(i)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or pair(i) != r:
                continue
            j = after[i]
            alive[j] = False
            after[i] = after[j]
            if after[i] <= n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (r := pair(k)) != NONE:
                    heapq.heappush(heap, (r, k))
        return [i for i in range(n) if alive[i]] + [n]

    def word(self, word: str) -> tuple[int, str, bytes]:
        """Of one word: how many ids, the ids as text with a comma after each, and the bytes that the ids decode to."""
        if (known := self.memo.get(word)) is None:
            ids = self.merge(word.encode())
            if len(self.memo) >= MEMO:
                self.memo.clear()
            known = len(ids), "".join(f"{n}," for n in ids), b"".join(self.bytes_of[n] for n in ids)
            if len(word) <= SHORT:
                self.memo[word] = known
        return known

    def pieces(self, text: str) -> list[tuple[int, str, bytes]]:
        found, word = [], self.word
        memo, words = self.memo, self.words
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                n = self.added[part]
                found.append((1, f"{n},", self.bytes_of[n]))
            elif part:
                found += [memo.get(w) or word(w) for w in words.findall(part)]
        return found

    def encode(self, text: str) -> list[int]:
        return [int(n) for p in self.pieces(text) for n in p[1].split(",")[:-1]]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[n] for n in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker: the file is installed on every machine and read once."""
    return Codec(path)


def encode_decode(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, ids_sha256, decoded_sha256, and the ids themselves if asked for."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        counts, hashes, back, all_ids = [], [], [], []
        for text in batch.column(1).to_pylist():
            pieces = c.pieces(text or "")
            ids = "".join([p[1] for p in pieces])[:-1]
            decoded = b"".join([p[2] for p in pieces]).decode("utf-8", "replace")
            counts.append(sum([p[0] for p in pieces]))
            hashes.append(hashlib.sha256(ids.encode()).hexdigest())
            back.append(hashlib.sha256(decoded.encode()).hexdigest())
            if keep_ids:
                all_ids.append([int(n) for n in ids.split(",")] if ids else [])
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string())]
        columns += [pa.array(back, pa.string())] + [pa.array(all_ids, pa.list_(pa.int32()))] * keep_ids
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return map_texts(docs.select(F.col("doc_id").cast("bigint"), "text"), per_batch, schema)
