"""Quality by weak supervision: rules vote, their accuracies are estimated without labels, the posterior decides.

Each rule looks at one measure of a text and votes good, bad or abstains. A text's votes form a pattern; only
the counts of patterns (3 ** rules at most, whatever the number of texts) reach the driver, where
expectation-maximisation fits a two-class model in which the rules vote independently given the class. The posterior of each
pattern is looked up for its texts: a join with as many rows as there are patterns.

Measures are taken over whole texts. Null and empty texts have no words: zero measures, base_failed, not kept. Repeated rows
each give a row and count each in the estimate. Extra columns are ignored.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import map_texts, written

REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
UPPER = regex.compile(r"\p{Lu}")
LETTER = regex.compile(r"\p{L}")
ROUNDS = 200
GOOD, ABSTAIN, BAD = 1, 0, -1


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < window + 1:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == n:
        return 0
    key, base = ids[: n - window + 1].copy(), len(number)
    for k in range(1, window):  # ranks keep the key exact: rank * words fits 64 bits for any text in memory
        key = key * base + ids[k : n - window + 1 + k]
        if k < window - 1 and base ** (k + 2) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    _, rank, count = np.unique(key, return_inverse=True, return_counts=True)
    change = np.zeros(n + 1, np.int64)
    again = np.flatnonzero(count[rank] > 1)
    np.add.at(change, again, 1)
    np.add.at(change, again + window, -1)
    return int(np.count_nonzero(np.cumsum(change[:-1])))


def measure(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``MEASURES``."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    spaces = sum(data.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    marked = sum(w.endswith((b"!!", b"??", b"***", b"$$$", b"###", b"%%%", b"&&&")) or w in (b"|", b"-", b"*") for w in words)
    return (
        len(words), len(text) - spaces, sum(data.count(bytes([c])) for c in SYMBOLS), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), len(UPPER.findall(text)), len(LETTER.findall(text)), marked, len(set(words)),
        sum(map(eq, words, words[1:])),
    )


MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marked",
    "n_kinds", "n_stutter",
]


def measures(docs: DataFrame) -> DataFrame:
    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [measure(t) for t in batch.column(1).to_pylist()]
        columns = [pa.array([m[i] for m in made], pa.int64()) for i in range(len(MEASURES))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *MEASURES])

    schema = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
    return map_texts(docs.select(F.col("doc_id").cast("bigint"), "text"), per_batch, schema)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def votes() -> dict[str, Column]:
    """Name of each rule and its vote: -1 bad, 0 abstains, 1 good."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    word, symbols = share("word_chars", "n_words"), share("n_symbols", "n_words")
    dup, repeat = share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")
    upper, marked, kinds = share("n_upper", "n_letters"), share("n_marked", "n_words"), share("n_kinds", "n_words")
    stutter = share("n_stutter", "n_words")
    return {
        "length": _vote(F.col("n_words") >= 20, F.col("n_words") < 10),
        "word_length": _vote(word.between(3, 9), (word < 2) | (word > 15)),
        "symbols": _vote(symbols < 0.02, symbols > 0.1),
        # one line of three may repeat by chance
        "lines": _vote(dup < 0.1, (dup > 0.3) & (F.col("n_dup_lines") > 2)),
        "repeats": _vote(repeat < 0.05, repeat > 0.2),
        "capitals": _vote(upper < 0.1, upper > 0.3),
        "marks": _vote(marked < 0.02, marked > 0.1),
        "stutter": _vote(stutter < 0.02, stutter > 0.2),
        "variety": _vote((kinds > 0.3) | (F.col("n_words") > 2000), (kinds < 0.2) & (F.col("n_words") <= 2000)),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good texts, table[class, rule, vote + 1], and each pattern's posterior of good, by expectation-maximisation.

    It starts from the majority of votes. Tables get one pseudo-vote each, weighted to the side of the rule's intent, so a rule that never votes bad
    stays harmless and classes cannot swap.
    """
    n_rules = patterns.shape[1] if patterns.size else 0
    bad_votes, good_votes = (patterns == BAD).sum(axis=1), (patterns == GOOD).sum(axis=1)
    posterior = np.where(bad_votes >= 2, 0.1, np.where(bad_votes == 1, 0.4, np.where(good_votes > 0, 0.95, 0.5)))
    prior, table = 0.5, np.full((2, n_rules, 3), 1 / 3)
    pseudo = np.array([[1.5, 1.0, 0.5], [0.1, 1.0, 1.9]])  # class bad, class good: votes bad, abstain, good
    for _ in range(ROUNDS):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        for rule in range(n_rules):
            for vote in range(3):
                table[:, rule, vote] = weight[:, patterns[:, rule] == vote - 1].sum(axis=1) + pseudo[:, vote]
        table /= table.sum(axis=2, keepdims=True)
        log = np.stack([np.log(table[c, np.arange(n_rules), patterns + 1]).sum(axis=1) for c in (0, 1)])
        odds = np.clip(log[1] - log[0] + np.log(prior / (1 - prior)), -700, 700)
        before, posterior = posterior, 1 / (1 + np.exp(-odds))
        if np.abs(before - posterior).max(initial=0) < 1e-10:
            break
    return prior, table, posterior


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Measures, base_failed, the posterior of good (``quality``) and kept, per row of ``docs`` (doc_id, text)."""
    rules = votes()
    code = sum(((vote + 1) * F.lit(3**i) for i, vote in enumerate(rules.values())), F.lit(0)).cast("int")
    measured = written(measures(docs).withColumn("pattern", code), "measures")  # a dozen numbers a text, measured once
    found = sorted((r["pattern"], r["count"]) for r in measured.groupBy("pattern").count().collect())
    codes = np.array([c for c, _ in found], np.int64)
    patterns = (codes[:, None] // 3 ** np.arange(len(rules))) % 3 - 1
    posterior = estimate(patterns, np.array([n for _, n in found], float))[2] if found else []
    table = docs.sparkSession.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, posterior)], "pattern int, quality double"
    )
    judged = measured.join(F.broadcast(table), "pattern", "left")  # 3 ** rules rows at most
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = judged.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
