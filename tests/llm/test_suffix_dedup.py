"""Repeated passages: the transform and the distributed operator against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from fixtures import empty_docs, odd_docs, odd_rows, words

from roadlens.llm import suffix_dedup
from roadlens.llm.bwt import repeats


def starts(strings, length):
    seen = Counter(s[i:i + length] for s in strings for i in range(len(s) - length + 1))
    return [[len(s[i:i + length]) == length and seen[s[i:i + length]] > 1 for i in range(len(s))] for s in strings]


def test_transform_equals_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        length = rng.choice([1, 2, 3, 7, 8, 9, 15, 20])
        letters = rng.choice([b"ab", b"abcdef", bytes(range(256)), b"\x00\xff"])
        base = bytes(rng.choice(letters) for _ in range(60))
        strings = []
        for _ in range(rng.randint(1, 8)):
            a = rng.randint(0, 40)
            strings.append(bytes(rng.choice(letters) for _ in range(rng.randint(0, 40))) + base[a:a + rng.randint(0, 40)]
                           + bytes(rng.choice(letters) for _ in range(rng.randint(0, 20))))
        assert [g.tolist() for g in repeats(strings, length)] == starts(strings, length)


def test_equal_windows_choose_equal_anchors():
    rng = np.random.default_rng(2)
    passage = rng.integers(97, 110, 90).astype(np.uint8)
    found = []
    for k in range(30):
        text = np.concatenate((rng.integers(97, 110, 40 + k).astype(np.uint8), passage, rng.integers(97, 110, 33).astype(np.uint8)))
        h, first, n = suffix_dedup.anchors(text, 60, 20)
        assert int(n.sum()) == len(text) - 59  # every window has one anchor
        found.append([h[np.searchsorted(first, w, side="right") - 1] for w in range(40 + k, 40 + k + 31)])
    assert all((np.array(f) == np.array(found[0])).all() for f in found)


def brute(rows, length):
    raws = [(t or "").encode() for t in rows]
    out = Counter()
    for raw, flags in zip(raws, starts(raws, length), strict=True):
        gone = np.zeros(len(raw), bool)
        for i in np.flatnonzero(flags):
            gone[i:i + length] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), kept] += 1
    return out


def removed(spark, docs, texts, **options):
    cut, whole = suffix_dedup.cut_repeats(docs, **options)
    got = Counter((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in cut.collect())
    untouched = {r["id"]: r["n_bytes"] for r in whole.collect()}
    assert len(untouched) + sum(got.values()) == len(texts)
    return got, untouched


@pytest.mark.parametrize("limit", [512, 3])
def test_operator_equals_brute_force(spark, limit):
    """With a low limit, most anchors go the way of hot ones."""
    rng = random.Random(8)
    passages = [words(60, 100 + k) for k in range(5)]
    texts = []
    for k in range(120):
        parts = [words(rng.randint(1, 25), k)] + [p for p in passages if rng.random() < 0.25] + [words(rng.randint(1, 20), 1000 + k)]
        texts.append(" ".join(parts))
    texts += [texts[0], texts[0], texts[1] + "é", "ab" * 400, "x" * 300, None, "", passages[0], passages[1][:99], "ü" * 120]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got, untouched = removed(spark, docs, texts, length=100, anchor=40, limit=limit, block_bytes=2000)
    want = brute(texts, 100)
    assert got == Counter({k: n for k, n in want.items() if k[1]})
    assert Counter(untouched.values()) == Counter({a: n for a, n in _sizes(want).items()})


def _sizes(want):
    out = Counter()
    for (size, gone, _, _), n in want.items():
        if not gone:
            out[size] += n
    return out


def test_odd_rows(spark):
    texts = [r[1] for r in odd_rows()]
    cut, whole = suffix_dedup.cut_repeats(odd_docs(spark))
    ids = Counter(r["id"] for r in cut.select("id").collect()) + Counter(r["id"] for r in whole.select("id").collect())
    assert ids == Counter(r[0] for r in odd_rows())
    assert {r["id"]: r["n_removed"] for r in cut.collect()}[14] == len(texts[13])  # one letter repeated covers itself
    none, rest = suffix_dedup.cut_repeats(empty_docs(spark))
    assert none.count() == 0 and rest.count() == 0
