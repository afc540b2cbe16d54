import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aeromart.llm import negatives as N
from aeromart.llm.queries import op13_hard_negatives
from check import connect, row_set
from tests.conftest import rows

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, cell int, anchor string, rank int"


def frame(spark, found):
    return spark.createDataFrame([(i, v, label, 0.5, 1, "a", 2) for i, v, label in found], SCHEMA).repartition(4)


def slow(found, every):
    """The definition, row by row."""
    use = set()
    for i, v, label in found:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for i, label, v in use:
        if i % every:
            continue
        scored = [(-dot(v, w), j, other) for j, other, w in use]
        positives = sorted({(s, j) for s, j, other in scored if other == label and j != i})[: N.POSITIVES]
        for p, j in positives:
            near = sorted({(s, k) for s, k, other in scored if other != label and 50 * -p <= 100 * -s <= 95 * -p})
            out |= {(i, j, rank, k, -p, -s) for rank, (s, k) in enumerate(near[: N.NEGATIVES], 1)}
    return sorted(out, key=repr)


def clustered(seed, n, width=6, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    found = []
    for i in range(n):
        c = rng.choice(centres)
        found.append((rng.randrange(-3, 2 * n), [x + rng.gauss(0, spread) for x in c], rng.randrange(3)))
    return found


@pytest.mark.parametrize("seed, spread", [(1, 0.02), (2, 0.3), (3, 2.0)])
def test_equals_the_definition(spark, seed, spread, monkeypatch):
    found = clustered(seed, 260, spread=spread)
    hot = found[0][1]
    found += [(1000 + i, hot, i % 3) for i in range(90)] + found[:20]  # a third of the rows are one vector, some rows repeat
    want = slow(found, 10)
    assert want
    for size, scores in ((1 << 16, 1 << 20), (50, 100)):
        monkeypatch.setattr(N, "ROWS", size)
        monkeypatch.setattr(N, "SCORES", scores)
        assert rows(N.mine(frame(spark, found), F.col("vec_id") % 10 == 0)) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    found = [
        (0, [1.0, 0.5], 1), (10, [1.0, 0.5], 1), (20, [0.0, 0.0], 1), (30, [], 1), (40, [1.0], 2), (50, [1.0, 0.5, 7.0], 2),
        (60, [-1.0, -0.5], 2), (70, None, 1), (80, [1.0, None], 1), (90, [nan, 1.0], 1), (100, [inf, 1.0], 2), (None, [1.0, 0.5], 1),
        (110, [1.0, 0.5], None), (1, [0.6, 0.3], 2), (2, [0.6, 0.3], 2), (3, [0.6, 0.3], 2), (4, [0.6, 0.3], 2), (5, [0.002, 0.0], 2),
        (6, [300.0, -2.0], 1), (7, [299.0, -2.0], 3), (10, [1.0, 0.5], 1), (10, [0.4, 0.5], 2), (-10, [1.0, 0.6], 1),
    ]
    made = rows(N.mine(frame(spark, found), F.col("vec_id") % 10 == 0))
    assert made == slow(found, 10) and made
    assert N.mine(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert N.mine(frame(spark, found[:1]), F.col("vec_id") % 10 == 0).count() == 0
    with pytest.raises(Exception, match="too large"):
        N.mine(frame(spark, [(0, [1e6], 1)]), F.col("vec_id") % 10 == 0).count()


def test_large_scores_are_exact(spark):
    found = [(i, [6e4 + i / 256, 6e4, -6e4 + i] * 3, i % 2) for i in range(40)]
    assert rows(N.mine(frame(spark, found), F.col("vec_id") % 10 == 0)) == slow(found, 10)
    a = np.array([[2**24 - 1.0] * 300, [-(2**24) + 3.0] * 300])
    assert N.scores_of(a, a, 300 * 2.0**48).tolist() == [[300 * (2**24 - 1) ** 2, -300 * (2**24 - 1) * (2**24 - 3)],
                                                         [-300 * (2**24 - 1) * (2**24 - 3), 300 * (2**24 - 3) ** 2]]


def test_bands_are_exact():
    score = np.array([0, 1, 2, 3, 19, 20, 21, 99, 100, 101, -1, -7, 2**60 + 1, 2**62 + 37])
    assert N._share(score, 95).tolist() == [95 * int(s) // 100 for s in score]
    assert (-N._share(-score, 50)).tolist() == [-(-int(s) // 2) for s in score]


def block(index, x, refs):
    norm = np.linalg.norm(x, axis=1)
    theta = N.angles(x, norm, refs)
    cell = theta.argmin(axis=1).astype(np.int32)
    columns = {"vec_id": index, "label": index % 3, "vector": pa.array(x.astype(np.int64).tolist(), pa.list_(pa.int64())), "norm": norm,
               "cell": cell, "angle": theta[np.arange(len(x)), cell], "anchor": index}
    return pa.table(columns)


def test_windows_hold_every_row_that_counts_and_leave_out_others():
    """The bounds never lose a score, and on separated groups few rows are scored."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    x = np.floor(256 * (centres[rng.integers(12, size=4000)] * rng.uniform(0.2, 3, size=(4000, 1)) + rng.normal(size=(4000, 8)) * 0.02))
    x[:5] = 0
    refs = np.eye(8)[:3]
    refs = np.concatenate([centres / np.linalg.norm(centres, axis=1, keepdims=True), refs])
    made, asked = N.Block(block(np.arange(4000), x, refs)), N.Anchors(block(np.arange(50) * 7, x[:350:7], refs), refs)
    scores, seen, total = asked.x @ made.x.T, 0, 0
    for least, most in ((50_000, 60_000), (-80_000, -20_000), (0, 0), (200_000, 10**9), (-(10**9), 10**9)):
        for number, cell in enumerate(made.cells):
            a, z = made.spans[number]
            low, high = made.windows(number, asked.norm, asked.theta[:, cell], np.full(50, least), np.full(50, most))
            place = np.arange(a, z)
            inside = (place >= low[:, None]) & (place < high[:, None])
            wanted = (scores[:, a:z] >= least) & (scores[:, a:z] <= most)
            assert not (wanted & ~inside).any()
            if most < 10**9 or least > 0:
                seen, total = seen + inside.sum(), total + inside.size
    assert seen < 0.5 * total


def test_whole_table_equals_sql(spark):
    from aeromart.llm.queries import SQL

    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        made = op13_hard_negatives(spark, folder)
        want = connect(folder).sql(SQL["op13_hard_negatives"])
        assert row_set([tuple(r) for r in made.collect()], made.columns) == row_set(want.fetchall(), want.columns)
