from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import AWKWARD, documents
from tripmart.llm.bpe import WordBpe, encoded

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABETS = [
    "abcdefghijklmnopqrstuvwxyz",
    "aeinrst",
    "ab",
    "Aa '-.1\n\x1c\x85\xa0éÉßΣσς",
    [chr(c) for c in range(0x3000) if c < 0xD800],
]


@pytest.fixture(scope="module")
def pair():
    return Tokenizer.from_file(PATH), WordBpe(PATH)


@pytest.mark.parametrize("alphabet", ALPHABETS, ids=["letters", "few", "two", "mixed", "wide"])
def test_ids_and_texts_equal_the_library(pair, alphabet):
    library, mine = pair
    draw = random.Random(7)
    for _ in range(1500):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids, text
        assert " ".join(w[2] for w in mine.encoded(text)) == library.decode(ids, skip_special_tokens=False)


def test_special_tokens_and_vocabulary_words(pair):
    library, mine = pair
    draw = random.Random(8)
    tokens = [t.removesuffix("</w>") for t in mine.vocab]
    cases = ["<|endoftext|>a<|startoftext|>", "it's WE'LL", "한국어 가"]
    cases += ["".join(draw.choice(tokens) for _ in range(draw.randint(1, 5))) for _ in range(1500)]
    for text in cases:
        assert mine.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_rows(spark, pair):
    library, _ = pair
    docs = documents(spark)
    got = encoded(docs, PATH).collect()
    want = []
    for doc_id, text, *_ in AWKWARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        joined = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        want.append((doc_id, len(ids), joined, text))
    mine = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got]
    assert sorted(mine, key=repr) == sorted(want, key=repr)
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert encoded(docs.limit(0), PATH).count() == 0
