import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from aeromart.llm import packing
from aeromart.llm.queries import op12_packing, vocabulary
from tests.conftest import rows
from tests.llm.data import DOCS, odd_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(vocabulary())
    made.no_padding()
    made.no_truncation()
    return made


def token_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def slow_rounds(sizes, quanta, window, packet):
    """The deficit round-robin itself: (queue, token) in windows, those of a queue together."""
    names, sent, deficit, stream = sorted(sizes), dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0), []
    while any(sent[q] < sizes[q] for q in names):
        for q in names:
            deficit[q] += quanta[q]
            while deficit[q] >= packet << packing.POINT and sent[q] < sizes[q]:
                deficit[q] -= packet << packing.POINT
                more = min(packet, sizes[q] - sent[q])
                stream += [(q, sent[q] + i) for i in range(more)]
                sent[q] += more
    return [sorted(stream[a : a + window]) for a in range(0, len(stream), window)]


@pytest.mark.parametrize("seed", range(6))
def test_pieces_equal_a_plain_round_robin(seed):
    rng = random.Random(seed)
    lengths = {f"q{i}": [rng.randrange(1, 400) for _ in range(rng.randrange(1, 30))] for i in range(rng.randrange(1, 7))}
    lengths["rare"] = [3]
    sizes = {q: sum(n) for q, n in lengths.items()}
    targets = {"q0": 0.5, "rare": 0.1, "other": 1.0} if seed % 2 else None
    made = packing.Rounds(sizes, targets, 128, 8)
    want = slow_rounds(sizes, dict(zip(made.names, made.quantum.tolist())), 128, 8)
    found = defaultdict(list)
    for q, own in lengths.items():
        n = np.array(own)
        first = np.cumsum(n) - n
        for r, start, window, offset, length in zip(*packing.cut(made, np.full(len(n), made.number[q]), first, n)):
            found[int(window)] += [(int(offset) + i, (q, int(first[r] + start) + i)) for i in range(length)]
    assert [[x for _, x in sorted(found[w])] for w in range(len(want))] == want
    assert all([at for at, _ in sorted(found[w])] == list(range(len(want[w]))) for w in found)


def test_windows_in_blocks_are_the_same(monkeypatch):
    sizes = {f"q{i}": 500 * (i + 1) for i in range(9)}
    made = packing.Rounds(sizes)
    ask = (made, np.arange(9), np.zeros(9, np.int64), made.size)
    whole = packing.cut(*ask)
    monkeypatch.setattr(packing, "CELLS", 20)
    assert all((a == b).all() for a, b in zip(whole, packing.cut(*ask)))


def check_pieces(library, found, texts):
    """Every id of every row in exactly one place, sequences without gaps, as (doc_id, text) says."""
    want = sorted((d, tuple(token_ids(library, t))) for d, t in texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length
        by_doc[r.doc_id].append((r.start, r.doc_tokens, ids.tolist()))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert sorted((d, sum((p[2] for p in sorted(own)), [])) for d, own in by_doc.items()) == [(d, list(t)) for d, t in want]
    lengths = []
    for k in range(len(by_sequence)):
        at = 0
        for offset, length in sorted(by_sequence[k]):
            assert offset == at
            at += length
        lengths.append(at)
    assert all(n == 2048 for n in lengths[:-1]) and sum(lengths) == sum(len(t) for _, t in want)


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    pieces = packing.pack(docs, vocabulary()).cache()
    found = pieces.collect()
    check_pieces(library, found, texts)
    made = rows(packing.digests(pieces))
    crc = {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in found}
    assert all(crc[r[0], r[1]] == r[3] for r in made)
    assert {r[:7] for r in made} == {tuple(r)[:7] for r in op12_packing(spark, FOLDER).collect()}
    # the mixture of every full window but the last ones, when queues run dry
    share, total = defaultdict(int), sum(r.length for r in found)
    for r in found:
        share[r.source] += r.length / total
    windows = defaultdict(lambda: defaultdict(int))
    for r in found:
        windows[r.sequence_id][r.source] += r.length
    for k in range(max(windows) - 2):
        assert all(abs(windows[k][s] - 2048 * share[s]) <= 3 * packing.PACKET for s in share)
    pieces.unpersist()


def test_targets(spark):
    texts = [(i, "a b c d e f g h " * 200, None, "x" if i % 4 else "y", 1, 1, 1, 1, 1) for i in range(40)]
    docs = spark.createDataFrame(texts, DOCS)
    pieces = packing.pack(docs, vocabulary(), {"x": 1.0, "y": 1.0}).groupBy("sequence_id", "source").sum("length").collect()
    mixed = {(k, s): n for k, s, n in pieces}
    dry = max(k for k, s in mixed if s == "y")
    assert dry > 3 and all(abs(mixed[k, "y"] - 1024) <= 48 for k in range(dry))
    assert {k for k, s in mixed} == set(range(max(k for k, _ in mixed) + 1))


def test_odd_rows_and_shared_queues(spark, library, monkeypatch):
    odd = [r for r in odd_rows() if r[0] is not None and r[0] != 12] + [(40, "<|endoftext|> " * 5), (41, " " * 400_000)]
    full = [(d, t, None, None if i == 3 else f"s{i % 5}", 1, 1, 1, 1, 1) for i, (d, t) in enumerate(odd)]
    for queues in (4096, 2):
        monkeypatch.setattr(packing, "QUEUES", queues)
        found = packing.pack(spark.createDataFrame(full, DOCS).repartition(3), vocabulary()).collect()
        check_pieces(library, found, odd)
        queues_found = {r.source for r in found}
        assert queues_found == {"", "s0", "s1", "s2", "s3", "s4"} if queues > 2 else len(queues_found) == 3 and packing.REST in queues_found
    twice = [(7, "same row", None, "s", 1, 1, 1, 1, 1)] * 3 + [(None, None, None, "s", 1, 1, 1, 1, 1)]
    found = packing.pack(spark.createDataFrame(twice, DOCS).repartition(2), vocabulary()).collect()
    assert sorted((str(r.doc_id), r.length) for r in found) == [("7", 3)] * 3 + [("None", 1)]
    assert packing.pack(spark.createDataFrame([], DOCS), vocabulary()).count() == 0


def test_sequences(spark, library):
    texts = [(i, f"word {i} " * (i % 50), None, f"s{i % 3}", 1, 1, 1, 1, 1) for i in range(60)]
    pieces = packing.pack(spark.createDataFrame(texts, DOCS), vocabulary()).cache()
    made = packing.sequences(pieces).collect()
    want = defaultdict(list)
    for r in sorted(pieces.collect(), key=lambda r: r.offset):
        want[r.sequence_id] += np.frombuffer(bytes(r.ids), "<u4").tolist()
    for r in made:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        n = len(want[r.sequence_id])
        assert r.tokens == n and ids[:n] == want[r.sequence_id] and not any(ids[n:])
        assert len(ids) == (n if n & (n - 1) == 0 else 2048)
    pieces.unpersist()


def test_ids_equal_the_library(library):
    ids, size = packing.encoder(vocabulary())
    assert size == 50257
    rng = random.Random(5)
    signs = ["a", " ", "\n", "\t", "'s", "'", "é", "日", "1", "\x1c", "\x85", "\xa0", "　", "!", "<|endoftext|>", "<|", "‍", "😀", "́", "B", "ſ", "\x00"]
    for _ in range(2000):
        text = "".join(rng.choices(signs, k=rng.randrange(14)))
        assert ids(text).tolist() == token_ids(library, text)[:-1], repr(text)
    for text in (" " * 3_000_000 + "x", "a" * 200_000, "日" * 50_000, "!\n" * 50_000):
        assert ids(text).tolist() == token_ids(library, text)[:-1]
