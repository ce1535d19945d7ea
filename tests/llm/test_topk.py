"""Exact top-k against brute force."""

import math
import random

import pytest

from roadlens.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, q string, rep string, v string, score double, ids string"


def rows(n, dims, seed, ties=False):
    rng = random.Random(seed)
    out = [(i, [rng.choice([-0.25, 0.0, 0.25]) if ties else rng.uniform(-1, 1) for _ in range(dims)], None, "q", None, "v", 1.0, None) for i in range(n)]
    odd = [None, [], [None] * dims, [float("nan")] + [0.0] * (dims - 1), [float("inf")] * dims, [0.5] * (dims + 1), [1e30] * dims]
    out += [(n + k, v, None, None, None, None, None, None) for k, v in enumerate(odd)]
    out += [(None, [0.5] * dims, None, None, None, None, None, None)]
    out += [(n + 100 + k, [0.125] * dims, None, None, None, None, None, None) for k in range(40)]  # a hot vector
    return out


def brute(data, k, every):
    import numpy as np

    ok = [(r[0], [math.floor(1024 * float(np.float32(x))) for x in r[1]]) for r in data
          if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    ends = lambda x: max(-(2 ** 63), min(2 ** 63 - 1, x))
    ok = [(i, [ends(x) for x in v]) for i, v in ok]
    out = set()
    for q, a in ok:
        if q % every == 0:
            scores = sorted((-ends(sum(x * y for x, y in zip(a, b, strict=True))), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize("dims,ties,fragments", [(8, False, 2), (6, True, 2), (5, False, 3), (1, True, 2)])
def test_equals_brute_force(spark, monkeypatch, dims, ties, fragments):
    monkeypatch.setattr(topk, "SLICE_ROWS", 16)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 8)
    data = rows(120, dims, dims, ties)
    found = topk.search(spark.createDataFrame(data, SCHEMA).repartition(4), lambda i: i % 5 == 0, k=4, fragments=fragments)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(data, 4, 5)


def test_fewer_candidates_and_nothing(spark):
    data = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [0.0, -1.0])]
    found = topk.search(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), lambda i: i == 0, k=10).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]
    assert topk.search(spark.createDataFrame([], "vec_id bigint, embedding array<double>"), lambda i: i % 2 == 0).count() == 0


def test_large_components(spark):
    """Components of any finite size take part; sums beyond a long are compared whole and end at its bounds."""
    rng = random.Random(5)
    data = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.choice([0, 3, 6, 8, 13, 30]) for _ in range(4)]) for i in range(60)]
    data += [(60, [3e6, 0.0, 0.0, 0.0]), (65, [1.0, 0.0, 0.0, 0.0]), (70, [1e300, -1e300, 1e300, -1e300])]
    found = topk.search(spark.createDataFrame(data, "vec_id bigint, embedding array<double>").repartition(3), lambda i: i % 5 == 0, k=6)
    want = set()
    ints = [(i, [max(-(2 ** 63), min(2 ** 63 - 1, math.floor(1024 * x))) for x in v]) for i, v in data]
    for q, a in ints:
        if q % 5 == 0:
            scores = sorted((-max(-(2 ** 63), min(2 ** 63 - 1, sum(x * y for x, y in zip(a, b, strict=True)))), i) for i, b in ints if i != q)[:6]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    assert {tuple(r) for r in found.collect()} == want


def test_one_id_on_two_vectors(spark):
    """Rows that share an id keep their own scores; the query's own row alone is left out."""
    data = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (1, [0.2, 5.0]), (2, [0.5, 0.5]), (0, [0.25, 0.0])]
    found = topk.search(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), lambda i: i == 0, k=10)
    scores = lambda q: sorted(((math.floor(1024 * b[0]) * math.floor(1024 * q), i) for n, (i, b) in enumerate(data) if not (i == 0 and b[0] == q)), key=lambda x: (-x[0], x[1]))
    want = sorted((0, n + 1, i, s) for q in (1.0, 0.25) for n, (s, i) in enumerate(scores(q)))
    assert sorted(tuple(r) for r in found.collect()) == want
