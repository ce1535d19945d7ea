"""BPE against the tokenizers library."""

import random

import public_tokenizers
import pytest
from fixtures import empty_docs, odd_docs, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadlens.llm.bpe import Encoder, Vocabulary, encode_decode

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def test_encoder_equals_library(vocabulary, library):
    rng = random.Random(5)
    texts = ["", " ", "a<|endoftext|>b <|endoftext|><|endoftext|>", "  \n\n  x  ", "日本語 テスト 🎉🎉", "'s don't I'LL", "\x00\x85 x　y",
             "z" * 5000, "ab" * 3000, " " * 3000 + "x", "!?" * 2000, words(2000, 9)]
    texts += ["".join(rng.choice("aeinrst hlo\n.,1é") for _ in range(rng.randint(0, 200))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FFF), rng.randint(32, 126), rng.randint(0x1F300, 0x1F700)])) for _ in range(60)) for _ in range(200)]
    encoder = Encoder(vocabulary)
    ids = encoder.encode(texts)
    assert ids == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.decode(ids) == texts
    assert 0 < encoder.exact < encoder.met  # only failing words were merged


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=24))
def test_speculation_equals_merging(vocabulary, word):
    assert vocabulary.encode_words([word])[0] == [vocabulary.merge(word)]


def test_forgetting_words_changes_nothing(vocabulary):
    texts = [words(50, k) for k in range(20)]
    small, large = Encoder(vocabulary, cache_words=10), Encoder(vocabulary)
    assert [small.encode([t])[0] for t in texts] == large.encode(texts)


def test_odd_rows(spark, library):
    out = encode_decode(odd_docs(spark), PATH)
    rows = out.select("doc_id", "text", "ids", "decoded", "lang").collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")
    clash = odd_docs(spark).withColumnRenamed("id", "IDS")
    assert [c.lower() for c in encode_decode(clash, PATH).columns].count("ids") == 1
    assert encode_decode(empty_docs(spark), PATH).count() == 0
