"""Toxicity and quality: held-out accuracy on the sample, and the odd cases."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from aeromart.llm import compression as C
from aeromart.llm import labelled as L
from aeromart.llm import toxicity as T
from aeromart.llm.logistic import Logistic
from aeromart.llm.queries import op1_toxicity, op4_compression
from tests.llm.data import fold, frame, odd_rows

FOLDER = "/root/testdata/sf0.1"


def held_out(spark, made, target):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    return [tuple(r) for r in made.where("held_out").join(labels, "doc_id").select(target, "predicted", "score").collect()]


def test_toxicity_held_out(spark):
    found = held_out(spark, op1_toxicity(spark, FOLDER), "toxic")
    caught = [p for y, p, _ in found if y == 1]
    wrong = [p for y, p, _ in found if y == 0]
    assert len(caught) > 80 and sum(caught) >= 0.9 * len(caught) and sum(wrong) <= 0.02 * len(wrong)
    assert all(0 <= s <= 1 and p == (s >= 0.3) for _, p, s in found)


def test_quality_held_out(spark):
    found = held_out(spark, op4_compression(spark, FOLDER), "quality")
    good, bad = [p for y, p, _ in found if y == 1], [p for y, p, _ in found if y == 0]
    assert len(bad) > 80 and sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def labels(spark, rows):
    return spark.createDataFrame([(d, y, y, 9) for d, y in rows], "doc_id bigint, toxic int, quality int, text int")


def corpus(n=400):
    rng = random.Random(2)
    docs, marks = [], []
    for i in range(n):
        w = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(60)]
        y = int(i % 4 == 0)
        if y:
            for k in rng.sample(range(60), 4):
                w[k] = "zorbl" + rng.choice("aeiou") * rng.randrange(1, 4)
        docs.append((i, " ".join(w)))
        marks.append((i, y))
    return docs, marks


def test_rare_endings_of_a_known_stem_are_caught(spark):
    docs, marks = corpus()
    new = [(1000, docs[1][1] + " zorblq zorblxx zorblyy zorbltt"), (1001, docs[2][1]), (1002, docs[1][1] + " qqqq vvvv xxxx")]
    model = T.train(frame(spark, docs), labels(spark, marks))
    made = {r.doc_id: r.predicted for r in T.score(frame(spark, new), model).collect()}
    assert made == {1000: 1, 1001: 0, 1002: 0}


def test_odd_rows_score(spark):
    docs, marks = corpus(200)
    docs += [(d + 5000 if d else d, t) for d, t in odd_rows()]
    marks += [(5001, 0), (5001, 1), (None, 1), (5006, 1), (99_999, 1), (5002, None)]
    for module in (T, C):
        model = module.train(frame(spark, docs), labels(spark, marks))
        made = module.score(frame(spark, docs), model).collect()
        assert len(made) == len(docs)
        for r in made:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
            assert r.held_out == (r.doc_id is None or fold(r.doc_id, module.PARTS) == module.HELD)


def test_dictionaries_learn_from_whole_texts(spark):
    rng = random.Random(5)
    noise = lambda: " ".join(f"{rng.getrandbits(40):x}" for _ in range(900))
    tail = " ".join(f"junk{k * k % 89}tail" for k in range(120))
    docs = [(i, noise() + ("" if i % 2 else tail)) for i in range(160)]
    model = C.train(frame(spark, docs), labels(spark, [(i, i % 2) for i, _ in docs]))
    assert model.dictionaries and all(b"junk64tail junk81tail" in bad and b"junk" not in good for good, bad in model.dictionaries)


def test_quality_scores_equal_brute_force(spark):
    """Sizes from plain calls of the library, folds by hand, and weights at which the penalised likelihood has no slope."""
    import zstandard

    docs, marks = corpus(600)
    docs = [(d, t if y else t.upper() + " spam offer" * (d % 7)) for (d, t), (_, y) in zip(docs, marks)]
    model = C.train(frame(spark, docs), labels(spark, marks))
    assert len(model.dictionaries) == C.PAIRS

    def size(dictionary, data):
        held = zstandard.ZstdCompressionDict(dictionary)
        held.precompute_compress(C.LEVEL)
        plain = zstandard.ZstdCompressor(level=C.LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(plain.compress(data))

    def features(text):
        data = text.encode()
        good, bad = (sum(size(p[k], data) for p in model.dictionaries) / C.PAIRS for k in (0, 1))
        return [(bad - good) / len(data), (bad - good) / max(good, bad), math.log(max(good, bad) / len(data))]

    label = dict(marks)
    fits = [(features(t), label[d]) for d, t in docs if fold(d, 5) == 1]
    x, y = np.array([f for f, _ in fits]), np.array([v for _, v in fits], float)
    z = np.c_[np.ones(len(x)), (x - x.mean(axis=0)) / x.std(axis=0)]
    w = model.score.weights
    slope = z.T @ (y - 1 / (1 + np.exp(-z @ w))) - np.r_[1e-6, [1e-2] * 3] * w
    assert np.abs(slope).max() < 1e-4
    made = {r.doc_id: r for r in C.score(frame(spark, docs), model).collect()}
    for d, t in docs[::7]:
        f = (np.array(features(t)) - x.mean(axis=0)) / x.std(axis=0)
        assert made[d].score == pytest.approx(1 / (1 + math.exp(-(w[0] + f @ w[1:]))), rel=1e-6)
        assert made[d].held_out == (fold(d, 5) == 0) and made[d].predicted == int(made[d].score >= 0.3)


def test_pieces_are_the_whole_text_or_a_sample_by_hash(spark):
    texts = spark.createDataFrame([(1, 0, "é" * 10_000), (2, 0, ""), (3, 1, "b" * 8_000)], "doc_id bigint, label int, text string")
    made = sorted(tuple(r) for r in C.pieces(texts).collect())
    assert b"".join(bytes(t) for d, _, _, t in made if d == 1).decode() == "é" * 10_000
    assert [(d, k, len(t)) for d, _, k, t in made] == [(1, 0, 8000), (1, 1, 8000), (1, 2, 4000), (2, 0, 0), (3, 0, 8000)]
    long = spark.createDataFrame([(1, 0, "x" * 8_000_000)], "doc_id bigint, label int, text string")
    found = sorted(r.piece for r in C.pieces(long, 100).collect())
    assert 60 <= len(found) <= 140 and found[-1] > 900


@pytest.mark.parametrize("module", [T, C])
def test_without_labels_or_rows(spark, module):
    docs = frame(spark, [(1, "a b"), (2, None)])
    model = module.train(docs, labels(spark, []))
    assert len({r.score for r in module.score(docs, model).collect()}) == 1
    one = module.train(docs, labels(spark, [(1, 1)]))
    assert all(0 <= r.score <= 1 for r in module.score(docs, one).collect())
    assert module.score(frame(spark, []), model).count() == 0


def pieces(word):
    """The first bytes of a word, then a mark, three bytes before and four new ones at a time; a shorter last piece ends in zero."""
    w = word if isinstance(word, bytes) else word.encode()
    found = [w[: T.ORDER]]
    if len(w) >= T.ORDER:
        found += [b"\1" + w[k - 3 : k + 4] for k in range(T.ORDER, len(w) + 1, 4)]
    return found


def slow_counts(labelled_words):
    """(left, word) pairs by class, counted by the different pieces before them, and the stems of their words."""
    triples = set()
    for words, y in labelled_words:
        left, said = 0, []  # of each piece, the one before it, mixed with the one before its word if it is an inner one
        for w in words:
            found = pieces(w)
            numbers = [int.from_bytes(c.ljust(8, b"\0"), "big") for c in found]
            said += [(left, found[0])]
            said += [(n ^ left * 0xC2B2AE3D27D4EB4F % (1 << 64), c) for n, c in zip(numbers, found[1:])]
            left = numbers[-1]
        before = 0
        for b, c in said:
            triples.add((0 if c[:1] == b"\1" else before, b, c, y))
            before = b
    pairs, stems = {}, {}
    for _, b, c, y in triples:
        pairs.setdefault((b, c), [0, 0])[y] += 1
    for (_, w), (o, t) in pairs.items():
        for k in range(min(len(w) + 1, T.ORDER) + 1):
            n = stems.setdefault((k, w[:k].ljust(8, b"\0")), [0, 0])
            n[0] += o > 0
            n[1] += t > 0
    return pairs, stems


@pytest.mark.parametrize("hot", [1, 300, 1 << 20])
def test_continuation_counts_equal_brute_force(spark, monkeypatch, hot):
    """The same counts with no pair dealt in parts, with some and with all."""
    monkeypatch.setattr(T, "HOT", hot)
    monkeypatch.setattr(T, "SORTED", 5_000)
    docs, marks = corpus(60)
    docs = [(d, t + " été longerword exactly8 ninebytes unspacedtextofmanybytes" * 2) for d, t in docs]
    known = spark.createDataFrame([(t, y) for (_, t), (_, y) in zip(docs + docs, marks + marks)], "text string, label int")
    pairs, stems = slow_counts([(t.split(), y) for (_, t), (_, y) in zip(docs, marks)])
    assert (len(T.hot_pairs(known, 0)) > 0) == (hot > 1)
    made = T.phrase_counts(known.repartition(4)).cache()
    key = lambda n: (n % (1 << 64)).to_bytes(8, "big")
    found = {(r.left % (1 << 32), key(r.word)): (r.ordinary, r.toxic) for r in made.collect()}
    left = lambda b: int(T.short_hash(np.array([b], np.uint64), 32)[0])
    assert found == {(left(b), c.ljust(8, b"\0")): tuple(n) for (b, c), n in pairs.items()}
    counted = {(r.length, key(r.stem)): (r.ordinary, r.toxic) for r in T.stem_counts(T.word_counts(made)).collect()}
    assert counted == {k: tuple(n) for k, n in stems.items()}
    made.unpersist()


def test_a_hot_pair_is_counted_in_parts(spark):
    """A third of all triples are one pair of words after different words."""
    texts = [" ".join(f"a{i * 97 + k} hot pair" for k in range(97)) for i in range(40)]
    known = spark.createDataFrame([(t, 0) for t in texts], "text string, label int")
    number = lambda w: next(T.words(pa.array([w])))[2]
    assert int(T.phrase_hash(T.short_hash(number("hot"), 32), number("pair"))[0]) in set(T.hot_pairs(known, 0).tolist())
    made = T.phrase_counts(known)
    assert made.where("ordinary > 3000").count() == 1 and made.agg({"ordinary": "sum"}).first()[0] >= 3 * 3000
    assert made.groupBy("left", "word").count().where("count > 1").count() == 0


def all_counts(stems):
    """Models that hold every stem there is."""
    keys = list(stems)
    numbers = np.array([int.from_bytes(s, "big") for _, s in keys], np.uint64)
    return T.Models(np.array([k for k, _ in keys]), numbers, np.array([stems[k] for k in keys]))


def test_stored_models_score_as_all_counts_do(spark, monkeypatch):
    docs, marks = corpus(300)
    docs = [(d, t + (" poisonousmixture endofline" if y and d % 8 else " peacefulmixture") + f" once{d * d}never") for (d, t), (_, y) in zip(docs, marks)]
    known = spark.createDataFrame([(t, y) for (_, t), (_, y) in zip(docs, marks)], "text string, label int")
    _, stems = slow_counts([(t.split(), y) for (_, t), (_, y) in zip(docs, marks)])
    texts = pa.array([t for _, t in docs[:50]] + ["zorblq unheard poisonousmixtures peacefulmix", "日本語の長い文章"])
    keys = np.unique(np.concatenate([k for _, _, k, _ in T.words(texts)]))
    want = all_counts(stems).differences(keys)
    assert np.abs(want).max() > 1
    whole = T.learn(known)
    assert len(whole.stems) == 1 and T._over_blocks(T.Models, whole.stems, keys) == pytest.approx(want)
    stored = sum(len(x) for x in T.Models.read(whole.stems[0][1]).stems)
    assert stored == sum(o + t >= 3 for o, t in stems.values()) < 0.7 * len(stems)
    monkeypatch.setattr(T, "BLOCK", 40)  # what does not fit one block goes to others, and nothing changes
    parts = T.learn(known)
    assert len(parts.stems) > 3
    assert T._over_blocks(T.Models, parts.stems, keys) == pytest.approx(want)
    assert parts.features(texts) == pytest.approx(whole.features(texts))


def test_counts_grow_with_the_labels_beyond_the_sample_for_the_weights(spark, monkeypatch):
    docs, marks = corpus(400)
    asked, fitted = [], []
    learn, fit = T.learn, T.fit
    monkeypatch.setattr(T, "LABEL_ROWS", 20)
    monkeypatch.setattr(T, "learn", lambda rows, known: (asked.append((rows.count(), known)), learn(rows, known))[1])
    monkeypatch.setattr(T, "fit", lambda rows, width: (fitted.append(rows.count()), fit(rows, width))[1])
    T.train(frame(spark, docs), labels(spark, marks))
    assert asked == [(sum(fold(d, T.PARTS) in (0, 3) for d, _ in docs),) * 2]
    assert 5 < fitted[0] < 45 < sum(fold(d, T.PARTS) == 1 for d, _ in docs)


def test_many_labels_meet_their_texts_by_a_shuffled_join(spark, monkeypatch):
    docs, marks = corpus(50)
    docs += [(3, None), (None, "x y"), (4, "again")]
    known = L.all_labels(labels(spark, [*marks, (None, 1)]), "toxic", T.PARTS, T.HELD)
    rows = lambda: sorted(tuple(r) for r in L.all_texts_of(frame(spark, docs), known).collect())
    want = rows()
    label = dict(marks)
    assert want == sorted((d, t, label[d]) for d, t in docs if d is not None and t is not None and fold(d, T.PARTS) != T.HELD)
    monkeypatch.setattr(L, "SAMPLE_BYTES", 0)
    assert rows() == want
    with pytest.raises(ValueError):
        L.texts_of(frame(spark, docs), known)


def caught(spark, docs, marks, new):
    model = T.train(frame(spark, docs), labels(spark, marks))
    return {r.doc_id: r.predicted for r in T.score(frame(spark, new), model).collect()}


def test_bytes_beyond_the_first_eight_decide(spark):
    docs, marks = corpus()
    docs = [(d, t.replace("zorbl", "abcdefgh" + "zorbl") + " abcdefghpleasant" * 3) for d, t in docs]
    new = [(1000, docs[1][1] + "".join(f" w{k} abcdefghzorbl{k}" for k in "aeio")), (1001, docs[2][1] + "".join(f" w{k} abcdefghpleasant" for k in "aeio"))]
    assert caught(spark, docs, marks, new) == {1000: 1, 1001: 0}


def test_the_end_of_an_unspaced_line_decides(spark):
    docs, marks = corpus()
    rng = random.Random(4)
    line = lambda end: "".join(rng.choice("日本語長文章書読山川人大小上下") for _ in range(25)) + end
    docs = [(d, " ".join(line("毒悪" if y else "花空") for _ in range(4)) + " " + " ".join(w for w in t.split() if "zorbl" not in w)) for (d, t), (_, y) in zip(docs, marks)]
    new = [(1000 + k, " ".join([*(line(end) for _ in range(4)), *docs[k + 1][1].split()[4:]])) for k, end in enumerate(("毒悪", "花空"))]
    assert caught(spark, docs, marks, new) == {1000: 1, 1001: 0}


def test_a_toxic_phrase_of_ordinary_words_is_caught(spark):
    rng = random.Random(9)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    docs, marks = [], []
    for i in range(600):
        y, w = int(i % 3 == 0), []
        for _ in range(6):  # both words are as frequent in either class; only their neighbours differ
            apart = ["drop", rng.choice(words), rng.choice(words), "dead"]
            w += [rng.choice(words) for _ in range(8)] + (["drop", "dead", rng.choice(words), rng.choice(words)] if y else apart)
        docs.append((i, " ".join(w)))
        marks.append((i, y))
    base = " ".join(rng.choice(words) for _ in range(40))
    new = [(1000, f"{base} drop dead waa wbb drop dead wcc"), (1001, f"{base} drop waa dead wbb drop wcc dead")]
    assert caught(spark, docs, marks, new) == {1000: 1, 1001: 0}


def number(stem):
    return int.from_bytes(stem.encode().ljust(8, b"\0"), "big")


def slow_difference(stems, word):
    """The models' rule for one word, with dictionaries."""
    give = lambda n: (0, 1, 2, 2.5)[min(n, 3)]
    total, word = 0.0, word + "\0"
    for k in range(1, min(len(word), 8) + 1):
        above, here = stems.get(word[: k - 1]), stems.get(word[:k], (0, 0))
        if not above or not min(above):
            break
        below = [c for s, c in stems.items() if len(s) == k and s[:-1] == word[: k - 1]]
        mass = [max(1, sum(give(c[i]) for c in below)) for i in (0, 1)]
        pooled = max(1, sum(give(sum(c)) for c in below))
        shared = (sum(here) - give(sum(here)) + pooled / 64) / sum(above)
        p = [(here[i] - give(here[i]) + mass[i] * shared) / above[i] for i in (0, 1)]
        total += math.log(p[1] / p[0])
    return total


def test_differences_equal_brute_force():
    rng = random.Random(8)
    counts = {}
    for _ in range(300):
        word, c = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))), (rng.randrange(3), rng.randrange(4))
        ended = word + "\0" if len(word) < 8 else word
        for k in range(len(ended) + 1):
            a = counts.get(ended[:k], (0, 0))
            counts[ended[:k]] = (a[0] + c[0], a[1] + c[1])
    stems = list(counts)
    models = T.Models(np.array([len(s) for s in stems]), np.array([number(s) for s in stems], np.uint64), np.array([counts[s] for s in stems]))
    asked = ["a", "ab", "zz", "abcabcab", "c" * 8, *["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(200)]]
    made = models.differences(np.array([number(w) for w in asked], np.uint64))
    assert np.allclose(made, [slow_difference(counts, w) for w in asked])


def test_what_is_rare_in_both_classes_says_nothing():
    counts = {"": (100, 100), "a": (50, 50), "a\0": (50, 50), "b": (50, 50), "bq": (1, 0), "bx": (49, 50)}
    models = T.Models(np.array([len(s) for s in counts]), np.array([number(s) for s in counts], np.uint64), np.array(list(counts.values())))
    made = models.differences(np.array([number(w) for w in ("a", "zzz", "bq")], np.uint64))
    assert np.abs(made).max() < 0.5  # seen once in one class of equal size; log 50 without the shared backoff


def test_words_are_cut_as_described():
    texts = ["Ab c9d, ÉÀ_été “Quote”—x", None, "", "no\u00a0break «q»", "日本 語", "  ", "A" * 20, "end"]
    want = [["ab", "c9d", "éà", "été", "quote", "x"], [], [], ["no", "break", "q"], ["日本", "語"], [], ["a" * 20], ["end"]]
    made = [[] for _ in texts]
    for at, _, keys, row in T.words(pa.array(texts)):
        for k, r in zip(keys.tolist(), row.tolist()):
            made[at + r].append(k.to_bytes(8, "big").rstrip(b"\0"))
    assert made == [[x for w in ws for x in pieces(w)] for ws in want]
    assert pieces("exactly8") == [b"exactly8", b"\1ly8"] and pieces("a" * 11) == [b"a" * 8, b"\1" + b"a" * 6]
    assert list(T.words(pa.array([None], pa.string())))[0][2].size == 0
    assert [k.size for _, _, k, _ in T.words(pa.array(["a b", "c", "d e f"]).slice(1, 2))] == [4]


def test_dropping_toxic_rows_keeps_columns(spark):
    docs, marks = corpus()
    given = frame(spark, docs + [(5000, None), (None, "")])
    model = T.train(given, labels(spark, marks))
    kept = T.drop_toxic(given, model)
    gone = {d for d, _ in docs} - {r.doc_id for r in kept.collect()}
    assert kept.columns == given.columns and gone and all(d % 4 == 0 for d in gone) and len(gone) >= 95


def test_logistic_fits_and_survives_one_class():
    x = [[float(i)] for i in range(100)]
    model = Logistic(x, [int(i > 50) for i in range(100)], 1)
    assert model.scores(np.array([[0.0], [99.0]])).round().tolist() == [0, 1]
    assert Logistic([], [], 1).scores(np.array([[3.0]]))[0] == pytest.approx(0.5, abs=0.01)
    assert Logistic(x, [1] * 100, 1).scores(np.array([[3.0]]))[0] > 0.9
