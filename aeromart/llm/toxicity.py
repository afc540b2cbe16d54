"""Toxicity by class-conditional Kneser-Ney models.

Two models, toxic and ordinary, give the probability of a word byte by byte, each byte given those before it in the word. A word
of ``ORDER`` bytes and more goes on in inner pieces: a mark, the three bytes before, and four new bytes (an ended word continues with
zero), so every byte of a word of any length, and of a text that is written without spaces, is counted and scored. Counts are
Kneser-Ney continuation counts: a piece counts once for every different piece to its left, so a passage that is copied a thousand
times counts once. Discounting hands the discounted mass of each class to a backoff that both classes share, made of their
pooled counts: an expression that is rare in both has the same probability in both and says nothing, while a rare ending of a known
toxic stem still says what the stem says. Phrases are a level above: a piece given the one to its left, counted once for every
different piece before the two, backing off to pooled counts of the phrase and from there to the share of the piece.

The log-likelihoods of a text are compared per piece, so length plays no part: the mean difference over the text, the
differences of its ``STRONGEST`` strongest pieces, since a few words make a long text toxic, the mean of what exceeds ``STRONG``, and the same
for phrases. A logistic function of these, fitted on labelled rows that gave no counts, is the score.

Both models count all labelled rows outside the held-out fold but those that the weights are fitted on. Stems that occur with two different left pieces at most, in both
classes together, are not stored: their whole counts are discounted, so they and all that they begin have the probability of a
stem that was never seen, and what they hand to the backoff is part of the stems that they end. Phrases seen less than three times in
each class say nothing either. Stems and phrases are files in the shared folder, in blocks of ``BLOCK`` rows; a task holds one block of each and
texts go through one block after another, so their number has no bound.

A word is a run of ASCII letters and digits and of characters beyond U+00BF other than general punctuation; A-Z and
À-Þ are lowered. Pieces are held as numbers, and texts are scored batch by batch on arrays.

Nothing but the text enters a score. Null and empty texts, and texts without words, score as a text without evidence. Without labels of
both classes, the score is a constant. Repeated rows each give a row. Rows with a null id count as held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import Blocks, block_of, held, in_blocks, in_fold, map_chunks, map_texts, read_files, written
from aeromart.llm.labelled import LABEL_ROWS, all_labels, all_texts_of, fit, share, texts_of
from aeromart.llm.logistic import Logistic

PARTS, HELD = 4, 2
ORDER = 8
#: Discount of the counts 0, 1, 2 and more.
DISCOUNTS = np.array([0.0, 1.0, 2.0, 2.5])
STRONGEST = 4
WEAKEST, STRONG = 0.5, 1.5
#: The same for phrases: how many, and from where on.
PHRASES, PHRASE = 2, 1.0
WIDTH = STRONGEST + 2 + PHRASES + 1
THRESHOLD = 0.3
#: Rows of a block of stems or phrases, and the texts that go through the blocks together where there are several.
BLOCK, CHUNK = 1 << 20, 64 << 20
ALPHABET = 64
#: An inner piece: its first byte, the bytes before the new ones, the new bytes.
INNER, BEFORE, NEW = 1, 3, 4
#: Of the hash that tells apart the pieces before a phrase.
BEFORE_BITS = 19
#: A pair of pieces with this part of all triples is counted in so many parts. A sample of about so many texts finds them.
HOT, HOT_PARTS, HOT_TEXTS = 1 << 10, 1 << 10, 2_000
#: Texts whose triples are sorted together, in bytes.
SORTED = 8 << 20
#: Texts that are worked on at once, in bytes; a longer text is one piece.
PIECE = 1 << 20
#: The first k bytes of a word.
MASKS = np.array([((1 << (8 * k)) - 1) << (8 * (ORDER - k)) for k in range(ORDER + 1)], np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(97, 123), *range(0x80, 0x100)]] = True


def words(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Parts of a column of texts: first and last row, the pieces of the words as numbers, the row of each piece."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE)) - 1)
        yield at, upto, *_cut(raw[ends[at] : ends[upto]], ends[at : upto + 1] - ends[at])
        at = upto


def _cut(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw)
    data = np.zeros(n + ORDER, np.uint8)
    data[:n] = _LOWER[raw]
    after_c3 = np.flatnonzero(raw[:-1] == 0xC3) + 1
    capital = after_c3[(raw[after_c3] >= 0x80) & (raw[after_c3] <= 0x9E) & (raw[after_c3] != 0x97)]
    data[capital] += 32
    inside = _INSIDE[data]
    marks = np.flatnonzero(raw[:-1] == 0xC2)  # U+0080 to U+00BF: signs and spaces
    inside[marks] = inside[marks + 1] = False
    marks = np.flatnonzero(raw[:-2] == 0xE2)
    marks = marks[(raw[marks + 1] == 0x80) | (raw[marks + 1] == 0x81)]  # general punctuation
    for k in range(3):
        inside[marks + k] = False
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    starts = np.flatnonzero(inside[:n] & (first[:n] | ~np.concatenate(([False], inside[: n - 1]))[:n]))
    stops = np.flatnonzero(inside[:n] & (first[1 : n + 1] | ~inside[1 : n + 1])) + 1
    heads = np.ndarray((n,), ">u8", data.data, strides=(1,))
    keys = heads[starts].astype(np.uint64) & MASKS[np.minimum(stops - starts, ORDER)]
    long = np.flatnonzero(stops - starts >= ORDER)
    if len(long):
        # one inner piece for each NEW bytes beyond ORDER, the last one with the end of the word
        more = (stops[long] - starts[long] - ORDER) // NEW + 1
        word = np.repeat(long, more)
        at = starts[word] + ORDER - BEFORE + NEW * (np.arange(len(word)) - np.repeat(np.cumsum(more) - more, more))
        room = np.minimum(stops[word] - at, ORDER - 1)
        inner = (heads[at].astype(np.uint64) >> np.uint64(8) | np.uint64(INNER << 56)) & MASKS[1 + room]
        order = np.argsort(np.concatenate((starts, at)), kind="stable")
        keys, starts = np.concatenate((keys, inner))[order], np.concatenate((starts, at))[order]
    return keys, np.searchsorted(bounds, starts, side="right") - 1


def lefts(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The piece to the left of each, 0 at the start of a text; of an inner piece, that mixed with the one to the left of its word."""
    inner = keys >> np.uint64(56) == INNER
    left = np.concatenate((np.zeros(1, np.uint64), keys[:-1])) if len(keys) else keys
    left[np.flatnonzero(np.diff(row, prepend=-1))] = 0
    if not len(keys):
        return left
    outside = left[np.maximum.accumulate(np.where(inner, 0, np.arange(len(keys))))]
    return np.where(inner, left ^ outside * np.uint64(0xC2B2AE3D27D4EB4F), left)


def _shifted(left: np.ndarray, row: np.ndarray) -> np.ndarray:
    """What stood to the left of the piece before, 0 at the start of a text."""
    before = np.concatenate((np.zeros(1, np.uint64), left[:-1])) if len(left) else left
    before[np.flatnonzero(np.diff(row, prepend=-1))] = 0
    return before


def phrase_hash(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One number for a piece and the 32-bit hash of the one to its left."""
    mixed = (left ^ (left >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def discounted(counts: np.ndarray) -> np.ndarray:
    """What counts hand to the backoff: all of a single one, more of larger ones up to the last of ``DISCOUNTS``."""
    return DISCOUNTS[np.minimum(counts, len(DISCOUNTS) - 1).astype(np.int64)]


class Models:
    """Both models, or a block of them: for every length the stems, their counts (ordinary, toxic) and what these hand on."""

    def __init__(self, length: np.ndarray, stem: np.ndarray, counts: np.ndarray, given: np.ndarray | None = None):
        """Without ``given``, the stems are all there are, and what they hand on is worked out from them."""
        self.stems, self.counts, self.given = [], [], []
        for k in range(ORDER + 1):
            own = np.flatnonzero(length == k)
            own = own[np.argsort(stem[own])]
            self.stems.append(stem[own])
            self.counts.append(counts[own].astype(float))
            self.given.append(np.zeros((len(own), 3)) if given is None else given[own].astype(float))
        for k in range(ORDER if given is None else 0):
            above, known = self._find(k, self.stems[k + 1])
            mass = np.c_[discounted(self.counts[k + 1]), discounted(self.counts[k + 1].sum(axis=1))]
            np.add.at(self.given[k], above[known], mass[known])

    @classmethod
    def read(cls, paths: list[str]) -> Models:
        columns = ["length", "stem", "ordinary", "toxic", "given_ordinary", "given_toxic", "given"]
        table = read_files(paths, columns)
        number = lambda names: np.stack([table[n].to_numpy() for n in names], axis=1)
        stem = table["stem"].to_numpy().view(np.uint64)
        return cls(table["length"].to_numpy(), stem, number(columns[2:4]), number(columns[4:]))

    def _find(self, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stems, wanted = self.stems[k], keys & MASKS[k]
        if not len(stems):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(stems, wanted), len(stems) - 1)
        return at, stems[at] == wanted

    def differences(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of each piece in the toxic model, less that in the ordinary one; of inner pieces, that of the new bytes."""
        total = np.zeros(len(keys))
        live = np.arange(len(keys))
        inner = keys >> np.uint64(56) == INNER
        before, known = self._find(0, keys)
        for k in range(1, ORDER + 1):
            # a stem that one class alone has leaves the rest of the word to the shared backoff
            live, before = live[known], before[known]
            both = self.counts[k - 1][before].min(axis=1, initial=np.inf) > 0
            if k > 1:
                both &= (keys[live] & (MASKS[k - 1] ^ MASKS[k - 2])) > 0  # the word has not ended
            live, before = live[both], before[both]
            if not len(live):
                break
            here, known = self._find(k, keys[live])
            count = np.where(known[:, None], self.counts[k][here] if len(self.stems[k]) else 0.0, 0.0)
            pooled, above, given = count.sum(axis=1), self.counts[k - 1][before], np.maximum(self.given[k - 1][before], 1.0)
            shared = (pooled - discounted(pooled) + given[:, 2] / ALPHABET) / above.sum(axis=1)
            p = (count - discounted(count) + given[:, :2] * shared[:, None]) / above
            scored = ~inner[live] if k <= 1 + BEFORE else slice(None)
            total[live[scored]] += np.log(p[scored, 1]) - np.log(p[scored, 0])
            before = here
        return total


class Phrases:
    """Differences of the phrases of a block, by hash."""

    def __init__(self, numbers: np.ndarray, difference: np.ndarray):
        order = np.argsort(numbers)
        self.numbers, self.difference = numbers[order], difference[order]

    @classmethod
    def read(cls, paths: list[str]) -> Phrases:
        table = read_files(paths, ["phrase", "difference"])
        return cls(table["phrase"].to_numpy().view(np.uint64), table["difference"].to_numpy())

    def differences(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.numbers):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.numbers, keys), len(self.numbers) - 1)
        return np.where(self.numbers[at] == keys, self.difference[at], 0.0)


def _over_blocks(kind: type, blocks: Blocks, keys: np.ndarray) -> np.ndarray:
    """Differences of keys, each from the block for its first two bytes. A worker holds one block of each kind."""
    total = np.zeros(len(keys))
    where = block_of(blocks, (keys >> np.uint64(48)).astype(np.int64))
    for number, (_, paths) in enumerate(blocks):
        own = np.flatnonzero(where == number)
        if not len(own):
            continue
        total[own] = held("toxicity", kind.__name__, paths, kind.read).differences(keys[own])
    return total


def strongest(row: np.ndarray, each: np.ndarray, places: int, least: float, out: np.ndarray) -> None:
    """The largest values of each row beyond ``least``, one column for each place."""
    some = np.flatnonzero(each > least)
    some = some[np.lexsort((-each[some], row[some]))]
    rank = np.arange(len(some)) - np.searchsorted(row[some], row[some])
    top = rank < places
    out[row[some[top]], rank[top]] = each[some[top]]


class Evidence:
    """Where the blocks are, and the features of texts from them."""

    def __init__(self, stems: Blocks, phrases: Blocks):
        self.stems, self.phrases = stems, phrases

    @property
    def chunk(self) -> int:
        return CHUNK if max(len(self.stems), len(self.phrases)) > 1 else PIECE

    def features(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Per text: mean difference, the strongest, mean of the excess over ``STRONG``; the strongest phrases, mean of their excess."""
        out = np.zeros((len(texts), WIDTH))
        out[:, 1 : 1 + STRONGEST] = WEAKEST
        if self.chunk == PIECE:  # blocks that stay: one part of the texts after another
            for part in words(texts):
                self._fill(out, [part])
        else:
            self._fill(out, list(words(texts)))
        return out

    def _fill(self, out: np.ndarray, cut: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        parts = [(*part, *np.unique(part[2], return_inverse=True)) for part in cut]
        kinds = np.unique(np.concatenate([p[4] for p in parts])) if parts else np.zeros(0, np.uint64)
        known = _over_blocks(Models, self.stems, kinds)
        pairs = [np.unique(phrase_hash(short_hash(lefts(keys, row), 32), keys), return_inverse=True) for _, _, keys, row, _, _ in parts]
        hashes = np.unique(np.concatenate([p[0] for p in pairs])) if pairs else kinds
        phrased = _over_blocks(Phrases, self.phrases, hashes)
        for (at, upto, keys, row, own, which), (said, place) in zip(parts, pairs):
            if not len(keys):
                continue
            here, n = out[at:upto], np.maximum(np.bincount(row, minlength=upto - at), 1)
            each = known[np.searchsorted(kinds, own)][which.reshape(-1)]
            here[:, 0] = np.bincount(row, each, upto - at) / n
            here[:, 1 + STRONGEST] = np.bincount(row, np.maximum(each - STRONG, 0), upto - at) / n
            strongest(row, each, STRONGEST, WEAKEST, here[:, 1 : 1 + STRONGEST])
            each = phrased[np.searchsorted(hashes, said)][place.reshape(-1)]
            here[:, -1] = np.bincount(row, np.maximum(each - PHRASE, 0), upto - at) / n
            strongest(row, each, PHRASES, 0.0, here[:, -1 - PHRASES : -1])


def short_hash(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)


def triples(texts: pa.Array | pa.ChunkedArray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different triples of some texts, by piece: the piece, and in a second number the piece to its left (a hash of 32 bits), the
    one before both (``BEFORE_BITS``; none before an inner piece, which makes no phrase) and the class."""
    made = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    for at, _, keys, row in words(texts):
        left = lefts(keys, row)
        second = np.where(keys >> np.uint64(56) == INNER, np.uint64(0), short_hash(_shifted(left, row), BEFORE_BITS))
        toxic = (label[at + row] == 1).astype(np.uint64)
        made.append((keys, short_hash(left, 32) << np.uint64(BEFORE_BITS + 1) | second << np.uint64(1) | toxic))
    keys, before = (np.concatenate(m) for m in zip(*made))
    order = np.lexsort((before, keys))
    keys, before = keys[order], before[order]
    new = np.ones(len(keys), bool)
    new[1:] = (before[1:] != before[:-1]) | (keys[1:] != keys[:-1])
    return keys[new], before[new]


def hot_pairs(rows: DataFrame, known: int) -> np.ndarray:
    """Hashes of the pairs of pieces that hold about one in ``HOT`` of the triples of a sample, ``HOT`` at most.

    They decide where triples are counted, never what the counts are.
    """

    def frequent(chunk: pa.Table) -> pa.Table:
        keys, before = triples(chunk["text"], chunk["label"].to_numpy())
        pair, count = np.unique(phrase_hash(before >> np.uint64(BEFORE_BITS + 1), keys), return_counts=True)
        some = count * 4 * HOT >= len(keys)
        pair, count = pa.array(pair[some].view(np.int64)), pa.array(count[some])
        every = pa.table({"pair": pa.array([None], pa.int64()), "n": pa.array([len(keys)], pa.int64())})
        return pa.concat_tables([every, pa.table({"pair": pair, "n": count})])

    some = rows.select("text", "label")
    if known > HOT_TEXTS:
        some = some.where(F.pmod(F.xxhash64("text"), F.lit(known)) < HOT_TEXTS)
    found = map_chunks(some, frequent, "pair bigint, n bigint", SORTED).groupBy("pair").agg(F.sum("n").alias("n"))
    found = written(found, "hot")
    total = found.where("pair is null").first()
    if total is None:
        return np.zeros(0, np.uint64)
    hot = found.where((F.col("n") * HOT >= total.n) & F.col("pair").isNotNull()).orderBy(F.desc("n")).limit(HOT)
    return np.sort(np.array([r.pair for r in hot.collect()], np.int64).view(np.uint64))


def phrase_counts(rows: DataFrame, known: int = 0) -> DataFrame:
    """(left, word, ordinary, toxic) from (text, label), about ``known`` rows: before how many different pieces a pair of pieces stands, by class.

    Triples are told apart and counted where their pair is, after one shuffle. Tasks hand on different triples only, sorted by piece,
    which halves what the shuffle writes. A pair that holds many of the triples is dealt in ``HOT_PARTS`` parts by the piece before it, and its
    parts are added up in the end, so a frequent pair is no hot key. Pairs are counted before pieces are, so neither is a frequent piece.
    """
    hot = hot_pairs(rows, known)
    held_hot = rows.sparkSession.sparkContext.broadcast(hot)  # HOT numbers at most

    def dealt(chunk: pa.Table) -> pa.Table:
        keys, before = triples(chunk["text"], chunk["label"].to_numpy())
        left, rest = before >> np.uint64(BEFORE_BITS + 1), before & np.uint64((2 << BEFORE_BITS) - 1)
        place = left.astype(np.int64)
        hot = held_hot.value
        if len(hot):
            pair = phrase_hash(left, keys)
            split = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, pair), len(hot) - 1)] == pair)
            place[split] |= ((rest[split] >> np.uint64(1)) % np.uint64(HOT_PARTS) + np.uint64(1)).astype(np.int64) << 32
        return pa.table({"place": place, "word": keys.view(np.int64), "rest": rest.astype(np.int32)})

    found = map_chunks(rows.select("text", "label"), dealt, "place bigint, word bigint, rest int", SORTED)
    # dealt by the pair before triples are told apart, so one shuffle serves both
    found = found.repartition("place", "word").distinct()
    both = F.sum(F.when(F.col("rest").bitwiseAND(F.lit(1)) == 1, 1 << 32).otherwise(1))  # both counts in one sum
    counted = found.groupBy("place", "word").agg(both.alias("both"))
    ordinary = F.col("both").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    left = F.shiftright(F.shiftleft("place", 32), 32).cast("int")
    counted = counted.select(
        left.alias("left"), "word", ordinary.alias("ordinary"), F.shiftright("both", 32).cast("int").alias("toxic"), (F.col("place") >= 1 << 32).alias("part")
    )
    if not len(hot):
        return written(counted.drop("part"), "pairs")
    stored = written(counted, "pairs")
    whole = stored.where("part").groupBy("left", "word").agg(*(F.sum(c).cast("int").alias(c) for c in ("ordinary", "toxic")))
    return stored.where("not part").drop("part").union(whole)


def word_counts(pairs: DataFrame) -> DataFrame:
    """(word, ordinary, toxic) from ``phrase_counts``: to the right of how many different pieces a piece stands, by class."""
    return pairs.groupBy("word").agg(F.count_if(F.col("ordinary") > 0).alias("ordinary"), F.count_if(F.col("toxic") > 0).alias("toxic"))


def stem_counts(counted: DataFrame) -> DataFrame:
    """(length, stem, ordinary, toxic) from ``word_counts``: the counts of all words that begin with the stem."""

    def stems(batch: pa.RecordBatch) -> pa.Table:
        keys = batch.column(0).to_numpy().view(np.uint64)
        made = []
        for k in range(ORDER + 1):
            # an ended word has one stem more than it has bytes
            own = np.arange(len(keys)) if k < 2 else np.flatnonzero((keys & (MASKS[k - 1] ^ MASKS[k - 2])) > 0)
            stem = (keys[own] & MASKS[k]).view(np.int64)
            part = {"length": np.full(len(own), k, np.int32), "stem": stem}
            made.append(pa.table(part | {c: batch.column(c).take(pa.array(own)) for c in ("ordinary", "toxic")}))
        return pa.concat_tables(made)

    made = map_texts(counted, stems, "length int, stem bigint, ordinary bigint, toxic bigint")
    return made.groupBy("length", "stem").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _discounted(count: Column) -> Column:
    steps = F.array(*map(F.lit, DISCOUNTS.tolist()))
    return F.get(steps, F.least(count, F.lit(len(DISCOUNTS) - 1)).cast("int"))


def _given() -> list[Column]:
    pooled = F.col("ordinary") + F.col("toxic")
    return [
        F.sum(_discounted(F.col("ordinary"))).alias("given_ordinary"), F.sum(_discounted(F.col("toxic"))).alias("given_toxic"),
        F.sum(_discounted(pooled)).alias("given"),
    ]


def models(stems: DataFrame) -> DataFrame:
    """Stems whose counts say more than nothing, with what all longer ones hand to their backoff, and the ``part`` that blocks are made of.

    Stems of up to one byte, which every block needs, are in every part that there is.
    """
    # the stem that a longer one continues: its last byte off
    bits = f"8 * ({ORDER + 1} - length)"
    shorter = F.when(F.col("length") > 1, F.expr(f"shiftleft(shiftright(stem, {bits}), {bits})"))
    handed = stems.where("length > 0").groupBy((F.col("length") - 1).alias("length"), F.coalesce(shorter, F.lit(0)).alias("stem"))
    handed = handed.agg(*_given())
    told = stems.where(F.col("ordinary") + F.col("toxic") >= len(DISCOUNTS) - 1).join(handed, ["length", "stem"], "left")
    told = told.fillna(0.0, ["given_ordinary", "given_toxic", "given"])
    return told.withColumn("part", F.when(F.col("length") > 1, F.shiftrightunsigned("stem", 48)).otherwise(-1))


def phrases(pairs: DataFrame, counted: DataFrame) -> DataFrame:
    """(phrase, difference, part): of every pair that is not wholly discounted, how much likelier its word is in toxic texts, given the left one."""
    left = pairs.groupBy("left").agg(F.sum("ordinary").alias("all_ordinary"), F.sum("toxic").alias("all_toxic"), *_given())
    word = counted.select("word", (F.col("ordinary") + F.col("toxic")).alias("pairs"))
    total = word.agg(F.sum("pairs")).scalar()
    o, t = F.col("ordinary"), F.col("toxic")
    told = pairs.where(F.greatest(o, t) >= len(DISCOUNTS) - 1).join(left.where("all_ordinary > 0 and all_toxic > 0"), "left").join(word, "word")
    share = (o + t - _discounted(o + t) + F.col("given") * F.col("pairs") / total) / (F.col("all_ordinary") + F.col("all_toxic"))

    def chance(count: Column, given: str, every: str) -> Column:
        return (count - _discounted(count) + F.greatest(given, F.lit(1.0)) * share) / F.col(every)

    difference = F.ln(chance(t, "given_toxic", "all_toxic")) - F.ln(chance(o, "given_ordinary", "all_ordinary"))
    rows = told.select("left", "word", difference.alias("difference"))

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        left = batch.column(0).to_numpy().view(np.uint32).astype(np.uint64)
        numbers = phrase_hash(left, batch.column(1).to_numpy().view(np.uint64))
        part = (numbers >> np.uint64(48)).astype(np.int64)
        columns = [pa.array(numbers.view(np.int64)), batch.column(2), pa.array(part)]
        return pa.RecordBatch.from_arrays(columns, names=["phrase", "difference", "part"])

    return map_texts(rows, hashed, "phrase bigint, difference double, part bigint")


def learn(rows: DataFrame, known: int = 0) -> Evidence:
    """Both models from (text, label), about ``known`` rows, as files."""
    pairs = phrase_counts(rows, known)
    counted = written(word_counts(pairs), "words")
    stored = written(models(written(stem_counts(counted), "stems")), "models")
    common, own = stored.where("part < 0"), stored.where("part >= 0")
    short = written(common, "short").inputFiles()  # at most 257 rows
    stems = [(first, short + paths) for first, paths in in_blocks(written(own, "long"), "part", BLOCK, "stems")] or [(0, short)]
    return Evidence(stems, in_blocks(written(phrases(pairs, counted), "phrases"), "part", BLOCK, "phrases"))


class Classifier:
    def __init__(self, evidence: Evidence, score: Logistic):
        self.evidence, self.score = evidence, score

    def scores(self, texts: pa.ChunkedArray) -> np.ndarray:
        return self.score.scores(self.evidence.features(texts))


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Counts from all rows of two thirds of the labelled ids, the weights of the score from ``LABEL_ROWS`` of the other third at most."""
    known = all_labels(labels, "toxic", PARTS, HELD)
    fits = F.crc32(F.col("doc_id").cast("string")) % PARTS == 1
    counted = known.where(~fits)
    evidence = learn(all_texts_of(docs, counted), counted.count())

    def features(chunk: pa.Table) -> pa.Table:
        made = pa.array(evidence.features(chunk["text"]).tolist(), pa.list_(pa.float64()))
        return pa.table({"doc_id": chunk["doc_id"], "x": made, "label": chunk["label"]})

    sample = known.where(fits)
    rows = texts_of(docs, sample.where(share(sample.count(), LABEL_ROWS, 0))).select("doc_id", "text", "label")
    return Classifier(evidence, fit(map_chunks(rows, features, "doc_id bigint, x array<double>, label int", evidence.chunk), WIDTH))


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text)."""

    def per_chunk(chunk: pa.Table) -> pa.Table:
        return pa.table({"doc_id": chunk["doc_id"], "score": classifier.scores(chunk["text"])})

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = map_chunks(texts, per_chunk, "doc_id bigint, score double", classifier.evidence.chunk)
    return made.select(
        "doc_id", in_fold("doc_id", PARTS, HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, classifier: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns; one pass, no shuffle."""
    at = docs.columns.index("text")

    def per_chunk(chunk: pa.Table) -> pa.Table:
        return chunk.filter(pa.array(classifier.scores(chunk.column(at)) < threshold))

    return map_chunks(docs, per_chunk, docs.schema, classifier.evidence.chunk)
