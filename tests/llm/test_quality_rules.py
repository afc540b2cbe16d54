import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from aeromart.llm import quality_rules as Q
from aeromart.llm.queries import op3_quality_rules
from tests.llm.data import frame, odd_rows

FOLDER = "/root/testdata/sf0.01"


def slow_counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    hit = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(hit),
    )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x1c\x0b#é|日 ", max_size=80))
def test_measures_equal_brute_force(text):
    assert Q.measure(text)[:5] == slow_counts(text)


def test_repeats_in_a_text_of_many_words():
    many = [f"w{i}".encode() for i in range(9000)]
    words = many + many[100:108] + [b"z"] + many[:5000]
    want = slow_counts(b" ".join(words).decode())[4]
    assert Q.repeated_words(words) == want


def test_whole_table(spark):
    made = {r.doc_id: r for r in op3_quality_rules(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(made) == len(docs)
    for d, t in docs:
        r, want = made[d], slow_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    good = [made[x.doc_id] for x in labels if x.quality == 1 and not made[x.doc_id].base_failed]
    bad = [made[x.doc_id] for x in labels if x.quality == 0 and not made[x.doc_id].base_failed]
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_posteriors_equal_a_plain_loop():
    """The same model, text by text and without pattern counts."""
    rng = np.random.default_rng(3)
    truth = rng.random(600) < 0.7
    votes = np.where(rng.random((600, 4)) < 0.2, 0, np.where(rng.random((600, 4)) < 0.85, 1, -1) * np.where(truth, 1, -1)[:, None])
    patterns, where, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    prior, table, posterior = Q.estimate(patterns, counts.astype(float))
    plain = []
    for row in votes:
        good = prior * np.prod([table[1, i, v + 1] for i, v in enumerate(row)])
        bad = (1 - prior) * np.prod([table[0, i, v + 1] for i, v in enumerate(row)])
        plain.append(good / (good + bad))
    assert np.allclose(posterior[where.ravel()], plain, atol=1e-6)
    assert abs(prior - truth.mean()) < 0.08 and ((posterior[where.ravel()] > 0.5) == truth).mean() > 0.93
    assert table[1, :, 2].min() > table[1, :, 0].max()


def test_odd_rows(spark):
    made = Q.judge(frame(spark, odd_rows())).collect()
    assert len(made) == len(odd_rows())
    for r in made:
        if r.n_words < 10:
            assert r.base_failed and r.kept is False
        assert r.kept is not None and r.base_failed is not None
    assert Q.judge(frame(spark, [])).count() == 0
