import zlib
from collections import Counter
from random import Random

import pytest
from pyspark.sql import functions as F

from aeromart.llm import sharding as S
from aeromart.llm.queries import op5_sharding
from tests.conftest import plan, rows
from tests.llm.data import frame, odd_rows

FOLDER = "/root/testdata/sf0.001"


def assert_law(made, docs, shards):
    size = lambda t: len((t or "").encode()) + 1
    want = Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in made) == want
    slots = {}
    for r in made:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    made = op5_sharding(spark, FOLDER)
    assert_law(made.collect(), docs, 16)
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan(made)
    assert rows(op5_sharding(spark, FOLDER)) == rows(made)


@pytest.mark.parametrize("shards", [1, 3, 16, 40])
def test_odd_rows(spark, shards):
    assert_law(S.shuffle_into_shards(frame(spark, odd_rows()), shards).collect(), odd_rows(), shards)


def test_copies_are_spread_over_blocks_and_ranges(spark, tmp_path, monkeypatch):
    """Nine rows of ten are one row: no block, and no range of a shard, is above twice the mean."""
    written, seen = S.written, {}

    def keep(df, name="step"):
        seen[name] = written(df, name)
        return seen[name]

    monkeypatch.setattr(S, "written", keep)
    docs = spark.range(0, 64_000, numPartitions=5).selectExpr("if(id % 10 = 0, id, 7) as doc_id", "if(id % 10 = 0, cast(id as string), 'same') as text")
    made = S.shuffle_into_shards(docs)
    blocks = seen["sized"].groupBy(F.pmod(F.xxhash64(F.lit(S.SEED), "nth"), F.lit(S.FEWEST))).count().collect()
    assert len(blocks) == S.FEWEST and max(r["count"] for r in blocks) < 1.2 * 1000
    ranges = seen["dealt"].groupBy("shard", F.pmod(F.shiftright(F.xxhash64(F.lit(S.SEED + 2), "nth"), 32), F.lit(4))).count().collect()
    assert len(ranges) == 64 and max(r["count"] for r in ranges) < 1.3 * 1000
    counts = Counter((r.shard, r.text_crc32 == zlib.crc32(b"same")) for r in made.collect())
    assert all(abs(counts[s, True] - 3600) < 6 * 20 and counts[s, True] + counts[s, False] == 4000 for s in range(16))


def test_empty_table(spark):
    assert S.shuffle_into_shards(frame(spark, [])).count() == 0


def test_matrix_sums():
    blocks, shards = [5, 0, 1_000_003, 17], S.shard_sizes(1_000_025, 16)
    matrix = S.communication_matrix(blocks, shards, 1)
    assert [sum(r) for r in matrix] == blocks and [sum(c) for c in zip(*matrix)] == shards
    huge = S.communication_matrix([10**9] * 3, S.shard_sizes(3 * 10**9, 2), 2)
    assert [sum(r) for r in huge] == [10**9] * 3


def test_draws_follow_the_law():
    rng = Random(4)
    draws = [S.hypergeometric(rng, 6, 14, 8) for _ in range(20_000)]
    from math import comb

    for k in range(7):
        p = comb(6, k) * comb(14, 8 - k) / comb(20, 8)
        assert abs(draws.count(k) / 20_000 - p) < 5 * (p * (1 - p) / 20_000) ** 0.5 + 1e-3
    assert S.hypergeometric(rng, 0, 5, 3) == 0 and S.hypergeometric(rng, 5, 0, 3) == 3


def test_places_are_uniform(spark):
    """Where each of 20 rows lands, over many seeds: shard by chi-square, and no order is kept."""
    docs = frame(spark, [(i, f"t{i}") for i in range(20)])
    first = Counter()
    for seed in range(25):
        for r in S.shuffle_into_shards(docs, 4, seed).select("doc_id", "shard").collect():
            first[r.doc_id < 10, r.shard] += 1
    expected = 25 * 20 / 8
    assert sum((first[a, s] - expected) ** 2 / expected for a in (True, False) for s in range(4)) < 24.3
