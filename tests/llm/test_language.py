import random

import numpy as np
import pytest

from aeromart.llm import language as L
from aeromart.llm.queries import op6_language
from tests.llm.data import fold, frame

FOLDER = "/root/testdata/sf0.01"


def slow_bits(grams, data):
    """Code length under one tree, byte by byte, with escapes to ever shorter contexts."""
    follows = {}
    for g, n in grams.items():
        d = g.to_bytes(4, "big")
        for k in range(4):
            f = follows.setdefault(d[k:3], {})
            f[d[3]] = f.get(d[3], 0) + n
    data, total = b"   " + data, 0.0
    for i in range(3, len(data)):
        p = 1.0
        for k in range(4):
            f = follows.get(data[i - 3 + k : i])
            if not f:
                continue
            whole = sum(f.values()) + len(f)
            if data[i] in f:
                p *= f[data[i]] / whole
                break
            p *= len(f) / whole
        else:
            p /= 256
        total -= np.log2(p)
    return total


def counted(text):
    g, n = np.unique(L._grams(text.encode()), return_counts=True)
    return g, n, dict(zip(g.tolist(), n.tolist()))


def bits(trees, text):
    return {trees.langs[k]: b[0] for k, b in trees.code_lengths([text.encode()])}


def test_code_lengths_equal_brute_force(monkeypatch):
    texts = ["the cat and the hat, then that", "der hut und die katze, über öl", "日本語のテキスト"]
    for learnt in texts:
        g, n, counts = counted(learnt)
        tree = L.Tree(g, n)
        for t in [*texts, "that über 語 ??", "q", "\x00\x01", "the\n" * 5000]:
            found = tree.code_lengths(L._grams(t.encode()))
            assert found.sum() == pytest.approx(slow_bits(counts, t.encode()))
    monkeypatch.setattr(L, "PIECE", 7)  # pieces of a text know the bytes before them
    whole = L._grams(texts[1].encode())
    pieces = list(L._pieces([b"", texts[1].encode(), b"x"]))
    assert np.concatenate([p[2] for p in pieces])[:-1].tolist() == whole.tolist() and len(pieces) > 3


def many_languages(n, rows=3):
    """Each language has words of its own, made of letters that all share, and some common words."""
    found = []
    for k in range(n):
        rng = random.Random(k)
        words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(30)] + ["and", "the"]
        for r in range(rows + 1):
            found.append((k, r, " ".join(rng.choice(words) for _ in range(120))))
    return found


def test_seventy_languages_with_all_their_grams(spark, monkeypatch):
    found = many_languages(70)
    ids = [i for i in range(2000) if fold(i, 4) != 2]
    learnt = [(ids[i], t, f"l{k:02}") for i, (k, r, t) in enumerate(found) if r]
    asked = [(5000 + k, t) for k, r, t in found if not r]
    trees = L.learn(frame(spark, learnt))
    assert len(trees.langs) == 70 and len(trees.blocks) == 1
    made = {r.doc_id: r.lang_pred for r in L.predict(frame(spark, asked), trees).collect()}
    assert made == {5000 + k: f"l{k:02}" for k in range(70)}
    by_lang = {}
    for _, t, lang in learnt:
        for g, n in counted(t)[2].items():
            own = by_lang.setdefault(lang, {})
            own[g] = own.get(g, 0) + n
    text = asked[3][1] + " über"
    whole = bits(trees, text)
    for lang in sorted(by_lang)[:30]:
        assert whole[lang] == pytest.approx(slow_bits(by_lang[lang], text.encode()))
    monkeypatch.setattr(L, "BLOCK", 1000)  # many blocks: the same code lengths and predictions
    parts = L.learn(frame(spark, learnt))
    assert len(parts.blocks) > 10 and bits(parts, text) == pytest.approx(whole)
    again = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(frame(spark, asked), parts).collect()}
    assert {k: v[0] for k, v in again.items()} == made
    assert all(again[r.doc_id][1] == pytest.approx(r.score) for r in L.predict(frame(spark, asked), trees).collect())


def test_posteriors_sum_to_one(spark):
    learnt = [(i, t, lang) for i, (t, lang) in enumerate([("abab abba", "x"), ("abac abca", "y"), ("zz top zz", "z")] * 8)]
    trees = L.learn(frame(spark, learnt))
    for text in ("ab", "abab zz", "qq", "a" * 100):
        cost = bits(trees, text)
        n = len(text)
        best = min(cost.values())
        want = 1 / sum(2 ** (-(b - best) / n * min(n, L.EVIDENCE)) for b in cost.values())
        (name,), (score,) = trees.predict([text])
        assert score == pytest.approx(want) and cost[name] == best


def test_a_stage_keeps_wanted_languages_above_a_posterior(spark):
    learnt = [(i, t, lang) for i in range(12) for t, lang in (("the cat and the hat", "en"), ("die Katze und der Hut", "de"), ("le chat et le chapeau", "fr"))]
    trees = L.learn(frame(spark, learnt))
    docs = frame(spark, [(1, "the hat"), (2, "der Hut"), (3, "le chat"), (4, "W"), (5, "12"), (6, None)])
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(L.drop_unknown(docs, trees)) == [1, 2, 3]  # of one strange letter no language is likelier than the others
    assert ids(L.drop_unknown(docs, trees, 0.0)) == [1, 2, 3, 4]
    assert ids(L.drop_unknown(docs, trees, wanted={"en", "fr"})) == [1, 3]
    assert L.drop_unknown(docs, trees).columns == docs.columns


def test_held_out_on_the_sample(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    made = op6_language(spark, FOLDER).join(docs, "doc_id").collect()
    assert len(made) == docs.count()
    held = [r for r in made if r.held_out]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in made)


def test_counts_equal_brute_force_and_leave_the_fold_out(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("abab", "x"), ("ab", "y"), (None, "x"), ("", "x"), ("abc", None)] * 6)]
    made = {(r.lang, r.gram): r.n for r in L.gram_counts(frame(spark, [*rows, (None, "abab", "x")])).collect()}
    want = {}
    for i, t, lang in rows:
        if t and lang and fold(i, 4) != 2:
            for g in L._grams(t.encode()).tolist():
                want[lang, g] = want.get((lang, g), 0) + 1
    assert made == want


def test_odd_rows(spark):
    learnt = [(i, t, lang) for i in range(8) for t, lang in (("the cat and the hat", "en"), ("die Katze und der Hut", "de"))]
    odd = [(100, None), (101, ""), (102, "12 34 !!"), (103, "the hat"), (None, "der Hut"), (104, "日本"), (105, "the hat and " * 40_000)]
    grams = L.learn(frame(spark, learnt))
    made = {r.doc_id: (r.lang_pred, r.held_out) for r in L.predict(frame(spark, odd), grams).collect()}
    assert {k: v[0] for k, v in made.items() if k != 104} == {100: "und", 101: "und", 102: "und", 103: "en", None: "de", 105: "en"}
    assert made[None][1] and made[104][0] in ("de", "en")
    kept = L.drop_unknown(frame(spark, odd), grams, 0.0)
    assert kept.columns == frame(spark, odd).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 103, 104, 105]


def test_nothing_learnt(spark):
    grams = L.learn(frame(spark, [(1, "text", None)]))
    made = L.predict(frame(spark, [(1, "text")]), grams).first()
    assert (made.lang_pred, made.score) == ("und", 0.0)
    assert L.predict(frame(spark, []), grams).count() == 0
