"""Small rows with every odd case: nulls, empty and long texts, ties, repeated rows, columns that clash."""

import random
import zlib

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, root bigint, count bigint, shard int"


def frame(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang), with columns whose names the operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", 7, 1, 2, 3, 4) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def words(seed, n, pool=400):
    rng = random.Random(seed)
    made = [f"w{rng.randrange(pool)}" for _ in range(n)]
    return " ".join(made)


def odd_rows():
    base = words(1, 60)
    return [
        (1, base), (2, base), (3, base.upper()), (4, base.replace(" ", "\n\t")), (5, ""), (6, None), (7, "   \n "),
        (8, "one"), (9, "Déjà vu, ça va? 日本語 — ok 😀"), (None, base), (10, words(2, 20_000, 5000)), (11, words(3, 60)),
        (12, words(4, 60)), (12, words(4, 60)), (13, "x" * 5000), (14, "a\x1cb   c d  <|endoftext|>e")
    ]


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts
