"""The lattice model against plain enumeration, and the base scores against plain counting."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from fixtures import empty_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from roadlens.llm import lattice_lm
from roadlens.llm.bpe import Vocabulary
from roadlens.llm.queries import op9_lattice_lm

PATH = public_tokenizers.path("byte_bpe_50k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def paths(raw, entries):
    """All segmentations of a byte string."""
    if not raw:
        yield []
    for end in range(1, len(raw) + 1):
        if raw[:end] in entries:
            for rest in paths(raw[end:], entries):
                yield [entries[raw[:end]], *rest]


def test_marginal_is_the_sum_over_all_segmentations(vocabulary):
    lattice = lattice_lm.Lattice(vocabulary)
    weight = lattice_lm.scores(vocabulary.size)
    words = ["the", "thething", "é", "a", "ingtion", "x1!"]
    want = [math.log(sum(math.exp(sum(weight[e] for e in p)) for p in paths(b" " + w.encode(), vocabulary.by_bytes))) for w in words]
    assert lattice.marginals([w.encode() for w in words], weight).tolist() == pytest.approx(want)


def plain(rows):
    """Per row: tokens, known tokens, base score, and all training tokens."""
    split = [(i, held, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))) for i, t, held in rows]
    counts = Counter(w for _, held, ws in split if not held for w in ws)
    texts = sum(not held for _, held, _ in split)
    n, v = sum(counts.values()) + texts, len(counts) + (texts > 0)
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    return [(i, len(ws) + 1, sum(w in counts for w in ws) + (texts > 0), n, sum(base(counts[w]) for w in ws) + base(texts)) for i, _, ws in split]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


@pytest.mark.parametrize("head", [0, 3, 1 << 16])
def test_odd_rows(spark, head):
    docs = odd_docs(spark).withColumn("held", F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False)))
    out = lattice_lm.score(docs.select("doc_id", "text", "held", "n_tokens"), ~F.col("held"), PATH, head_words=head).collect()
    same([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out],
         plain([(r[0], r[1], r[0] is not None and r[0] % 3 == 1) for r in odd_rows()]))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    by_text = {}
    for r in out:
        by_text.setdefault((r["doc_id"], r["n_tokens"]), set()).add(round(r["score"], 6))
    test_odd_rows.scores = getattr(test_odd_rows, "scores", by_text)
    assert by_text == test_odd_rows.scores  # how many words are broadcast changes nothing


def test_probabilities_of_words_sum_to_one_at_most(spark):
    texts = ["a b a", "ab ba", "b"]
    docs = spark.createDataFrame([(k, t, False) for k, t in enumerate(texts)] + [(10 + k, w, True) for k, w in enumerate(["a", "b", "ab", "ba", "c", "aa", ""])],
                                 "doc_id bigint, text string, held boolean")
    out = {r["doc_id"]: 10 ** r["score"] for r in lattice_lm.score(docs, ~F.col("held"), PATH).collect()}
    end = out[16]
    assert sum(out[k] / end for k in range(10, 16)) + end < 1


def test_vocabulary_scores_alone(spark, vocabulary):
    """Without arcs for whole words a text's score is the sum of its words' marginals, and the end."""
    docs = spark.createDataFrame([(1, "the thing the", False), (2, "x1! the", True), (3, "", True)], "doc_id bigint, text string, held boolean")
    lattice, weight = lattice_lm.Lattice(vocabulary), lattice_lm.scores(vocabulary.size)
    end = 1.5 / 5
    word = lambda w: (lattice.marginals([w], weight)[0] + math.log(1 - end)) / math.log(10)
    want = {1: 2 * word(b"the") + word(b"thing"), 2: word(b"x1!") + word(b"the"), 3: 0.0}
    out = {r["doc_id"]: r["score"] for r in lattice_lm.score(docs, ~F.col("held"), PATH, whole_words=False).collect()}
    assert out == pytest.approx({k: x + math.log10(end) for k, x in want.items()})


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = lattice_lm.score(docs, F.lit(False), PATH).collect()
    assert all(math.isfinite(r["score"]) and r["train_tokens"] == 0 and r["n_known"] == 0 for r in rows) and len(rows) == 2
    assert lattice_lm.score(empty_docs(spark).select("doc_id", "text"), F.lit(True), PATH).count() == 0


def test_query_on_documents(spark):
    got = op9_lattice_lm(spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    same([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got],
         plain([(r["doc_id"], r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in docs]))
    held = [(r["score"], r["n_tokens"]) for r in got if r["held_out"]]
    bits = -sum(s for s, _ in held) / sum(n for _, n in held)
    assert bits < 7  # decimal digits a token; spelling words byte by byte takes more than twice that
