"""Mixing: targets, rounding, reruns, awkward rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import empty_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from roadlens.llm import mixing


def share_out(sizes: dict, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0) -> dict:
    """Targets by plain resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        got = {s: left * w / open_weight for s, w in weight.items() if s not in capped} if open_weight else {}
        over = [s for s, x in got.items() if x > most * sizes[s]]
        if not over:
            return capped | got
        capped |= {s: most * sizes[s] for s in over}


def count(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def decide(spark, docs, **options):
    rows = docs.selectExpr("monotonically_increasing_id() AS row", "doc_id AS id", "source", "text").select(
        "row", "id", "source", mixing.word_count().alias("size"))
    return mixing.decide(rows, **options).collect()


def test_targets_and_copies_of_odd_rows(spark):
    sizes = defaultdict(int)
    for r in odd_rows():
        sizes[r[3]] += count(r[1])
    want = share_out(dict(sizes))
    rows = decide(spark, odd_docs(spark))
    assert Counter((r["id"], r["size"]) for r in rows) == Counter((r[0], count(r[1])) for r in odd_rows())
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["copies"] in (0, 1, 2)


def test_words_come_near_targets_and_reruns_agree(spark):
    docs = spark.range(30_000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source", "repeat('w ', cast(1 + pmod(xxhash64(id), 400) AS int)) AS text")
    first = decide(spark, docs)
    again = decide(spark, docs.repartition(5))
    taken, target, largest = Counter(), {}, Counter()
    for r in first:
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s] / 4  # only one row of a source is not balanced by others, a short one
    assert sorted((r["id"], r["copies"]) for r in first) == sorted((r["id"], r["copies"]) for r in again)
    assert sorted((r["id"], r["copies"]) for r in decide(spark, docs, seed=7)) != sorted((r["id"], r["copies"]) for r in first)


def test_pairing_keeps_mass_and_expectation():
    rng = np.random.default_rng(1)
    sizes, parts = [5, 5, 3, 2, 1, 1], [0.3, 0.5, 0.9, 0.25, 0.6, 0.1]
    mass = np.dot(sizes, parts)
    total = np.zeros(6)
    for _ in range(4000):
        out, left = mixing.pair_off(sizes, parts, rng.random(6).tolist())
        assert np.dot(sizes, out) == pytest.approx(mass)
        assert all(x in (0.0, 1.0) for k, x in enumerate(out) if k != left)
        total += out
    assert np.allclose(total / 4000, parts, atol=0.04)


@pytest.mark.parametrize("q", [0.3, 0.5, 0.85])
def test_much_longer_rows_are_settled_by_all_that_follow(q):
    rng = np.random.default_rng(2)
    # with 0.85, the rows after the first need room for 765 words: 5,100 words at least (200 rows have about 4,000, too few)
    sizes = sorted([900, 300, *map(int, rng.integers(1, 40, 400))], reverse=True)
    assert 0.15 * (sum(sizes) - 900) > 765
    total = np.zeros(len(sizes))
    for _ in range(3000):
        out, left = mixing.pair_off(sizes, [q] * len(sizes), rng.random(len(sizes)).tolist())
        assert np.dot(sizes, out) == pytest.approx(q * sum(sizes))
        assert all(x in (0.0, 1.0) for k, x in enumerate(out) if k != left)
        assert left < 0 or sizes[left] < 40
        total += out
    assert np.allclose(total / 3000, q, atol=0.05)


def test_repeated_rows_have_places(spark):
    """Copies of one row are dealt by their places, which run from 0 whatever the partitions."""
    docs = spark.range(9_000).selectExpr("if(id < 6000, null, id) AS id", "'hot' AS source", "cast(if(id < 6000, 20, 3) AS bigint) AS size", "id AS row")
    for frame in (docs.repartition(3), docs.repartition(8)):
        rows = mixing.placed(frame, F.xxhash64("id", "source", "size")).collect()
        assert sorted(r["place"] for r in rows if r["id"] is None) == list(range(6000))
        assert {r["place"] for r in rows if r["id"] is not None} == {0} and len(rows) == 9_000
    copies = [Counter((r["id"], r["copies"]) for r in mixing.decide(frame).collect()) for frame in (docs.repartition(3), docs.repartition(8))]
    assert copies[0] == copies[1]


def test_mix_returns_rows_of_the_input(spark):
    docs = odd_docs(spark)
    out = mixing.mix(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert max(Counter((r["doc_id"], r["text"]) for r in out.collect()).values()) <= 4  # two equal rows, twice each
    assert mixing.mix(empty_docs(spark)).count() == 0


def test_without_words_targets_are_zero(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert {(r["target"], r["size"]) for r in decide(spark, docs)} == {(0.0, 0)}
