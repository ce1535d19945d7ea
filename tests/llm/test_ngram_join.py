"""The shingle join against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import empty_docs, odd_docs, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from roadlens.llm import ngram_join
from roadlens.llm.components import components, extended
from roadlens.llm.shingles import Shingler

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, t):
    """[(id, text)] to Counter of (id, size, component)."""
    sets = [(i, shingles(x, k)) for i, x in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= t * len(x | y):
                parent[root(a)] = root(b)
    names = {}
    for n, (i, s) in enumerate(sets):
        if i is not None:
            r = root(n)
            names[r] = min(names.get(r, i), i)
    return Counter((i, len(s), names.get(root(n)) if s else i) for n, (i, s) in enumerate(sets))


def found(df):
    return Counter((r["id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def family(seed):
    rng = random.Random(seed)
    rows = []
    for f in range(12):
        base = words(rng.randint(8, 90), 50 + f).split()
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(["new", "Other", "x1", "y2"])
            rows.append(" ".join(w))
    common = words(40, 7)
    rows += [words(rng.randint(1, 30), 900 + k) + " " + common for k in range(40)]
    rows += [common + " " + words(2, 2000 + k) for k in range(15)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k,t", [(3, 90), (5, 80), (2, 60), (1, 100)])
def test_join_equals_brute_force(spark, monkeypatch, k, t):
    monkeypatch.setattr(ngram_join, "GROUP_SETS", 4)
    monkeypatch.setattr(ngram_join, "RUN_TOKENS", 500)
    rows = family(k)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(ngram_join.join(docs, k, t)) == brute(rows, k, t)


def test_matrix_alone_loses_nothing(spark, monkeypatch):
    """Even if the sketches propose no pair, every link is found through the groups."""
    monkeypatch.setattr(ngram_join, "ALIKE", ngram_join.SKETCH + 1)
    rows = family(77)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(ngram_join.join(docs, 3, 80)) == brute(rows, 3, 80)


@pytest.mark.parametrize("t", [60, 75, 80, 90])
def test_longer_prefixes_share_enough(t):
    """Linked sets share at least as many tokens of their longer prefixes as either of them asks for."""
    rng = random.Random(t)
    seen = 0
    for _ in range(3000):
        n = rng.randint(2, 60)
        a = set(rng.sample(range(200), n))
        b = set(a) - set(rng.sample(sorted(a), rng.randint(0, max(1, n // 5)))) | set(rng.sample(range(200), rng.randint(0, n // 8 + 1)))
        if not b or a == b or 100 * len(a & b) < t * len(a | b):
            continue
        seen += 1
        size = np.array([len(a), len(b)])
        take = size - ngram_join.least_overlap(size, t) + ngram_join.more_shared(size, t)
        asked = ngram_join.more_shared(ngram_join.least_overlap(size, t), t)
        assert len(set(sorted(a)[:take[0]]) & set(sorted(b)[:take[1]])) >= asked.max() >= 1
    assert seen > 50


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert found(ngram_join.join(odd_docs(spark), 3, 90)) == brute(rows, 3, 90)
    assert ngram_join.join(empty_docs(spark), 3, 90).count() == 0


def test_keep_one(spark):
    docs = odd_docs(spark)
    out = ngram_join.keep_one(docs, 3, 90)
    assert out.schema.simpleString() == docs.schema.simpleString()
    kept = out.collect()
    sets = [shingles(r["text"], 3) for r in kept]
    full = [s for s in sets if s]
    assert len(full) == len(set(full)) and len(sets) - len(full) == sum(not shingles(r[1], 3) for r in odd_rows())
    assert 1 in {r["doc_id"] for r in kept} and not {2, 3, 4} & {r["doc_id"] for r in kept}
    assert sum(r["doc_id"] == 16 for r in kept) == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té", max_size=30), min_size=1, max_size=6), st.integers(1, 4))
def test_set_sizes(texts, k):
    offsets, tokens = Shingler(k).sets(texts)
    assert np.diff(offsets).tolist() == [len(shingles(t, k)) for t in texts]
    for a, b in zip(offsets, offsets[1:], strict=False):
        assert (np.diff(tokens[a:b].astype(object)) > 0).all()


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 100 + k) for k in range(1, 50)] + [(200, 200)] + [(301, 300), (301, 302)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert {out[k] for k in range(61)} == {0} and {out[100 + k] for k in range(50)} == {100}
    assert out[302] == out[301] == 300 and 200 not in out


def test_near_copies_are_merged_before_groups_are_opened(spark, monkeypatch):
    """A large group of near copies takes few comparisons between families, though much altered copies, which link with none, come first in its bands."""
    rng = random.Random(5)
    k, t, base, rows = 5, 80, words(120, 4).split(), []
    for i in range(360):
        w = list(base)
        for at in rng.sample(range(len(w)), 8 if i < 60 else rng.choice([1, 2, 2, 3])):
            w[at] = f"n{i}x{at}"
        rows.append(" ".join(w))
    rows = list(enumerate(rows))
    pairs, staged = [], ngram_join.staged

    def watched(df, name):
        out = staged(df, name)
        if name == "join-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "staged", watched)
    out = found(ngram_join.join(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), k, t))
    assert out == brute(rows, k, t)
    assert pairs[-1] <= 3 * len(rows), pairs


def test_sets_that_miss_the_head_of_a_family_are_merged_by_their_rare_tokens(spark, monkeypatch):
    """Much altered copies link with many less altered ones that share an alteration, not with the head: links are not all listed."""
    rng = random.Random(8)
    base, rows = words(150, 6).split(), []
    altered = [(at, f"n{at}") for at in range(10, 130, 5)]
    for i in range(420):
        w = list(base)
        for at, new in rng.sample(altered, 1 + i % 4):
            w[at] = new
        rows.append(" ".join(w))
    rows = list(enumerate(rows))
    pairs, staged = [], ngram_join.staged

    def watched(df, name):
        out = staged(df, name)
        if name == "join-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "staged", watched)
    monkeypatch.setattr(ngram_join, "ALIKE", 15)
    out = found(ngram_join.join(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), 3, 90))
    assert out == brute(rows, 3, 90)
    assert pairs[-1] <= len(rows), pairs


def test_components_are_extended_by_further_links(spark):
    def labels(links):
        return components(spark.createDataFrame(links, "a bigint, b bigint"))

    first, more = [(1, 2), (3, 4), (4, 5), (9, 8)], [(5, 2), (11, 12), (12, 9), (1, 2), (4, 3)]
    further = extended(labels(first), spark.createDataFrame(more, "a bigint, b bigint"))
    assert Counter(map(tuple, further.collect())) == Counter(map(tuple, labels(first + more).collect()))
    same = extended(labels(first), spark.createDataFrame([], "a bigint, b bigint"))
    assert Counter(map(tuple, same.collect())) == Counter(map(tuple, labels(first).collect()))


def test_widely_used_tokens_come_last_by_their_use(spark):
    texts = ["a b c d e f g h i j"]
    _, tokens = Shingler(1).sets(texts)
    hot = tokens[[1, 4, 7]]
    common = type("B", (), {"value": (hot, np.array([9, 3, 5], np.uint8))})
    import pyarrow as pa
    got = next(ngram_join._prefixes(1, 10, common, 1)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])))
    prefix = np.array(got["prefix"][0].as_py(), np.int64).view(np.uint64)
    assert prefix.tolist() == [*np.delete(tokens, [1, 4, 7]), *tokens[[4, 7, 1]]][:len(prefix)] and len(prefix) == 10
