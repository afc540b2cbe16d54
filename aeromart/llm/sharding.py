"""Uniform shuffle into shards of exact size, on DataFrame functions only.

The counts come first: rows get a number of their own in the task that reads them, which is stored with them, and are dealt by a hash of
it into input blocks, so copies are spread like any other rows. The block sizes are counted, and a matrix of blocks by
shards is drawn row by row from the multivariate hypergeometric law, which is the law of these counts under a uniform
permutation. Then rows are permuted within their block (by a seeded hash), cut into shards by the block's row of the matrix, exchanged,
and permuted again within their shard. Law ``rows``: shard sizes differ by one row at most.

Sorts are over bounded parts: input blocks, and within a shard ranges of a second hash, whose counts give the offset of
each range. A block has about ``BLOCK_ROWS`` rows at any size of the table. Only counts reach the driver: blocks x shards numbers.

Null texts have 0 bytes (size 1) and the checksum of the empty text. Null ids and repeated rows are rows like any other;
the number of a row depends on how the input is cut into tasks, so another layout of the same table is another uniform shuffle.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate
from random import Random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeromart.llm.common import written

SHARDS = 16
SEED = 20_240
BLOCK_ROWS = 1 << 22
FEWEST = 64


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def hypergeometric(random: Random, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` rows are good, by inversion around the mode; exact at any number of rows.

    The probabilities follow from their ratios; a tail ends where no double can tell it from zero.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    up, down = [1.0], []
    for k in range(mode, high):
        p = up[-1] * ((good - k) * (drawn - k) / ((k + 1) * (bad - drawn + k + 1)))
        if p < 1e-18:
            break
        up.append(p)
    p = 1.0
    for k in range(mode, low, -1):
        p *= k * (bad - drawn + k) / ((good - k + 1) * (drawn - k + 1))
        if p < 1e-18:
            break
        down.append(p)
    sums = list(accumulate(down[::-1] + up))
    at = bisect_right(sums, random.random() * sums[-1])
    return mode - len(down) + min(at, len(sums) - 1)


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """How many rows each block sends to each shard: rows sum to ``blocks``, columns to ``shards``."""
    random, left, matrix = Random(seed), list(shards), []
    for size in blocks:
        row, need, pool = [], size, sum(left)
        for j, free in enumerate(left):
            pool -= free
            row.append(need if j == len(left) - 1 else hypergeometric(random, free, pool, need))
            need -= row[-1]
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    if shards < 1:
        raise ValueError("at least one shard")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
    )
    slim = written(slim.withColumn("nth", F.monotonically_increasing_id()), "sized")
    n_blocks = max(FEWEST, math.ceil(slim.count() / BLOCK_ROWS))
    keys = ["doc_id", "size", "text_crc32"]
    blocked = slim.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "nth"), F.lit(n_blocks)).cast("int"))
    counted = {r["block"]: r["count"] for r in blocked.groupBy("block").count().collect()}
    sizes = [counted.get(i, 0) for i in range(n_blocks)]
    matrix = communication_matrix(sizes, shard_sizes(sum(sizes), shards), seed)
    cuts = spark.createDataFrame(
        [(i, list(accumulate(row))) for i, row in enumerate(matrix)], "block int, cuts array<bigint>"
    )

    # permute within the block; the row's rank says which column of the matrix it falls in
    order = [F.xxhash64(F.lit(seed + 1), "nth"), F.col("nth")]
    ranked = blocked.withColumn("rank", F.row_number().over(Window.partitionBy("block").orderBy(*order)).cast("bigint") - 1)
    dealt = ranked.join(F.broadcast(cuts), "block")  # blocks x shards numbers
    dealt = dealt.withColumn("shard", F.size(F.filter("cuts", lambda c: c <= F.col("rank"))))
    dealt = written(dealt.select(*keys, "nth", "shard"), "dealt")

    # permute within the shard, in ranges of another hash
    parts = max(1, math.ceil(n_blocks / shards))
    second = F.xxhash64(F.lit(seed + 2), "nth")
    dealt = dealt.withColumn("part", F.pmod(F.shiftright(second, 32), F.lit(parts)).cast("int"))
    counts = dealt.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "part").orderBy(second, "nth")
    placed = dealt.withColumn("rank", F.row_number().over(within))
    placed = placed.join(F.broadcast(offsets), ["shard", "part"])  # blocks + shards rows at most
    return placed.select(
        *keys, F.lit("rows").alias("law"), "shard", (F.col("before") + F.col("rank") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
