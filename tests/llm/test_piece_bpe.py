"""Merge-type SentencePiece encoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from fixtures import empty_docs, odd_docs, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from roadlens.llm import piece_bpe
from roadlens.llm.piece_bpe import Encoder, Vocabulary, encode_decode
from roadlens.llm.queries import op12_piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def ids_of(encoder, texts):
    rows, differ = encoder.encode(texts)
    assert not any(differ)
    return [np.frombuffer(r, np.int32).tolist() for r in rows]


def test_encoder_equals_library(vocabulary, library):
    rng = random.Random(5)
    texts = ["", " ", "  ", "   x", "x  ", "a▁b ▁▁ c", "\n\n\t x", "日本語 テスト 🎉🎉", "z" * 5000, " " * 3000 + "x ", "ab " * 300 + "  ",
             "\x00\x01 odd\x85x", " \n \n", "<s></s><unk><0x41>", "don't  I'LL", words(2000, 9)]
    texts += ["".join(rng.choice("aeinrst hlo\n.,1é   ▁") for _ in range(rng.randint(0, 200))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FFF), rng.randint(32, 126), rng.randint(0x1F300, 0x1F700), 32])) for _ in range(60)) for _ in range(300)]
    own = ids_of(Encoder(vocabulary, check=False), texts)
    theirs = library.encode(texts, num_threads=1)
    assert own == theirs
    encoder = Encoder(vocabulary)
    assert [encoder.decode(i) for i in own] == library.decode(theirs)
    assert ids_of(encoder, texts) == theirs


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" aetonshire▁\n.é🎉日"), max_size=40))
def test_any_text(vocabulary, library, text):
    assert ids_of(Encoder(vocabulary, check=False), [text]) == [library.encode(text)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 262)), max_size=12))
def test_any_ids_decode(vocabulary, library, ids):
    assert Encoder(vocabulary, check=False).decode(ids) == library.decode(ids)


def test_heap_equals_rows(vocabulary):
    rng = random.Random(3)
    parts = [" " + "".join(rng.choice("aeinrsthlo") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    heaps = [vocabulary.merge([int(vocabulary.symbol_of[ord(c)]) for c in p]) for p in parts]
    assert [np.frombuffer(r, np.int32).tolist() for r in vocabulary.encode_words(parts)] == heaps


def test_forgetting_words_changes_nothing(vocabulary):
    texts = [words(50, k) for k in range(20)]
    small, large = Encoder(vocabulary, cache_words=10), Encoder(vocabulary)
    assert [ids_of(small, [t])[0] for t in texts] == ids_of(large, texts)


def test_library_overrules_and_counts(vocabulary, library, monkeypatch):
    encoder = Encoder(vocabulary)
    monkeypatch.setattr(vocabulary, "encode_words", lambda w: [np.array([5], np.int32).tobytes()] * len(w))
    rows, differ = encoder.encode(["two words", "two", ""])
    assert [np.frombuffer(r, np.int32).tolist() for r in rows] == library.encode(["two words", "two", ""])
    assert differ == [2, 1, 0]


def test_other_models_are_refused(tmp_path):
    (tmp_path / "m").write_bytes(b"\x12\x02\x18\x01")  # a trainer section that names the unigram type
    with pytest.raises(ValueError):
        piece_bpe.Vocabulary(str(tmp_path / "m"))


def test_odd_rows(spark, library):
    out = encode_decode(odd_docs(spark), PATH)
    rows = out.select("doc_id", "text", "ids", "decoded", "differing", "lang").collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "")
        assert r["decoded"] == library.decode(r["ids"]) and r["differing"] == 0
    clash = odd_docs(spark).withColumnRenamed("id", "IDS")
    assert [c.lower() for c in encode_decode(clash, PATH).columns].count("ids") == 1
    assert encode_decode(empty_docs(spark), PATH).count() == 0


def test_query(spark, library):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    texts = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    expected = {(i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, t in texts for ids in [library.encode(t)]}
    assert {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op12_piece_bpe(spark, SF_SMALL).collect()} == expected
