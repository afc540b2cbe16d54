import hashlib
import random

import pytest
from tokenizers import Tokenizer

from aeromart.llm import bpe
from aeromart.llm.queries import op7_bpe, vocabulary
from tests.conftest import rows
from tests.llm.data import frame, odd_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(vocabulary())
    made.no_padding()
    made.no_truncation()
    return made


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(back)


def test_whole_table_equals_library(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert rows(op7_bpe(spark, FOLDER)) == sorted(((d, *expected(library, t)) for d, t in docs), key=repr)


def test_odd_rows_equal_library(spark, library):
    made = bpe.encode_decode(frame(spark, odd_rows()), vocabulary(), keep_ids=True).collect()
    want = sorted(((d, *expected(library, t)) for d, t in odd_rows()), key=repr)
    assert sorted((tuple(r)[:4] for r in made), key=repr) == want
    assert all(len(r["ids"]) == r["n_tokens"] for r in made)


def test_random_characters_equal_library(library):
    rng = random.Random(5)
    codec = bpe.codec(vocabulary())
    pools = [range(32, 127), range(9, 14), range(28, 32), (0x85, 0xA0, 0x1680, 0x2028, 0x3000, 0x200B, 0x180E), range(0x80, 0x250),
             range(0x4E00, 0x4E40), range(0x1F600, 0x1F640), range(0x300, 0x340), (39, 115, 116, 114, 101)]
    for _ in range(600):
        text = "".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(60)))
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert codec.decode(codec.encode(text)) == text


def test_long_words_merge_as_short_ones():
    codec = bpe.codec(vocabulary())
    rng = random.Random(6)
    for n in (1, 2, 3, 50, 300):
        word = bytes(rng.choice(b"abcdethesin") for _ in range(n))
        assert codec._heaped(word) == codec._scanned(word)
    assert len(codec.encode("ab" * 200_000)) > 0


def test_empty_table(spark):
    assert bpe.encode_decode(frame(spark, []), vocabulary()).count() == 0
