import random

import numpy as np
import pytest
import xxhash

from aeromart.llm import simhash as S
from aeromart.llm.components import connected_components
from aeromart.llm.queries import op2_simhash
from tests.conftest import rows
from tests.llm.data import frame, odd_rows

FOLDER = "/root/testdata/sf0.001"


def slow_fingerprint(text, k=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", lowered) if x]
    shingles = [w[i : i + k] for i in range(len(w) - k + 1)] if len(w) >= k else ([w] if w else [])
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(pairs, bits=4):
    """(id, fingerprint) rows to their smallest reachable id, by comparing all."""
    n, root = len(pairs), list(range(len(pairs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= bits:
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [least.get(top(i)) for i in range(n)]


def expected(docs):
    pairs = [(d, slow_fingerprint(t)) for d, t in docs]
    return sorted(((d, f"{f:016x}", c) for (d, f), c in zip(pairs, slow_components(pairs))), key=repr)


def test_whole_table_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op2_simhash(spark, FOLDER)) == expected(docs)


def test_odd_rows_equal_brute_force(spark):
    assert rows(S.near_duplicates(frame(spark, odd_rows()))) == expected(odd_rows())


@pytest.mark.parametrize("trie,wide", [(16_384, 1 << 25), (16_384, 1), (25, 1 << 25), (7, 1)])
@pytest.mark.parametrize("bits", [0, 1, 4])
def test_links_join_what_brute_force_joins(spark, trie, wide, bits):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 1 << 63}
    for seed in list(fps)[:12]:  # chains and dense groups
        for _ in range(25):
            near = seed
            for _ in range(rng.randrange(6)):
                near ^= 1 << rng.randrange(64)
            fps.add(near)
    values = sorted(fps)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = S.near_links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), bits, trie, wide)
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links.collect()]
    assert all(bin(a ^ b).count("1") <= 64 for a, b in found)
    want = slow_components(list(enumerate(values)), bits)
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in found:
        root[top(a)] = top(b)
    groups = {}
    for i, v in enumerate(values):
        groups.setdefault(top(v), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_trie_pairs_equal_all_pairs():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 5, dtype=np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 80, dtype=np.uint64)) for c in centre]))
    group, side = np.zeros(len(fps), np.int64), np.zeros(len(fps), np.int64)
    found = {(int(a), int(b)) for i, j in S.trie_links(group, side, fps, 4) for a, b in zip(i, j)}
    want = {(a, b) for b in range(len(fps)) for a in range(b) if bin(int(fps[a] ^ fps[b])).count("1") <= 4}
    assert {tuple(sorted(x)) for x in found} == want


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(-5, 7), (9, 9)]
    found = dict(rows(connected_components(spark.createDataFrame(links, "a bigint, b bigint"))))
    assert {found[i] for i in range(41)} == {-5} and {found[i] for i in range(100, 160)} == {100}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_stays(spark):
    docs = frame(spark, odd_rows())
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    # an id that is there twice with one text stays once
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        {d for d, _, c in expected(odd_rows()) if d is not None and d == c}
    )


def test_a_row_that_is_there_many_times_stays_once(spark):
    x, y = (" ".join(f"{c}{i * i % 97}" for i in range(60)) for c in "xy")
    kept = S.keep_one(frame(spark, [(1, x)] * 300 + [(2, y)] * 2 + [(2, x), (None, "z z z"), (None, "z z z"), (3, None), (3, None)]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, x), (2, y), (None, "z z z"), (3, None)], key=repr)


def test_repeated_ids_lose_no_text_and_null_ids_keep_one_row(spark):
    x, y, z = (" ".join(f"{c}{i * i % 97}" for i in range(60)) for c in "xyz")
    kept = S.keep_one(frame(spark, [(3, x), (5, x), (5, y), (9, y), (None, y), (None, z), (None, z), (None, z), (7, None), (8, "")]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(3, x), (5, y), (None, z), (7, None)], key=repr)


def test_empty_table(spark):
    assert S.near_duplicates(frame(spark, [])).count() == 0
