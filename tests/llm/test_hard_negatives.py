"""Hard-negative mining against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadlens.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, q string, row string, v string, score double, windows string"


def rows(n, dims, seed, ties=False):
    rng = random.Random(seed)
    clash = ("q", "r", "v", 1.0, None)
    out = []
    for i in range(n):
        v = [rng.choice([-0.25, 0.0, 0.25, 0.5]) if ties else rng.gauss(0.15, 1) * 0.7 ** k for k in range(dims)]
        out.append((i, v, rng.randrange(3), *clash))
    odd = [None, [], [], [], [None] * dims, [float("nan")] + [0.0] * (dims - 1), [float("inf")] * dims, [0.5] * (dims + 1), [1e306] * dims]
    out += [(n + k, v, 1, None, None, None, None, None) for k, v in enumerate(odd)]
    out += [(n + 40, [0.5] * dims, None, *clash), (None, [0.5] * dims, 1, *clash)]
    out += [(n + 100 + k, [0.125] * dims, k % 2, *clash) for k in range(40)]  # a hot vector
    out += [(0, [1.0] * dims, 1, *clash), (0, [0.5] * dims, 2, *clash), (0, [0.5] * dims, 2, *clash)]  # an id on several rows
    out += [(n + 200, [3e6] * dims, 1, *clash), (n + 201, [3e9, *[-1.0] * (dims - 1)], 1, *clash), (n + 205, [3e9] * dims, 0, *clash),
            (n + 210, [1e30] * dims, 2, *clash), (n + 211, [-1e30] * dims, 2, *clash)]
    return out


def brute(data, every, positives, negatives):
    ok = [(r[0], r[2], [math.floor(256 * x) for x in r[1]], place) for place, r in enumerate(data)
          if r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in r[1])]
    clip = lambda s: max(-(2 ** 63) + 1, min(2 ** 63 - 1, s))
    out = Counter()
    for a in ok:
        if a[0] % every == 0:
            scored = [(-clip(sum(x * y for x, y in zip(a[2], b[2], strict=True))), b[0], b[3], b[1] == a[1])
                      for b in ok if b[3] != a[3] and len(b[2]) == len(a[2])]
            for p in sorted(s for s in scored if s[3])[:positives]:
                window = sorted(s for s in scored if not s[3] and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0])[:negatives]
                out.update((a[0], p[1], n + 1, s[1], -p[0], -s[0]) for n, s in enumerate(window))
    return out


@pytest.mark.parametrize("dims,ties,sample", [(12, False, 30), (6, True, 30), (20, False, 4096), (1, True, 5)])
def test_equals_brute_force(spark, monkeypatch, dims, ties, sample):
    for name, value in (("SLICE_ROWS", 64), ("BLOCK_ANCHORS", 16), ("TILE_ANCHORS", 5), ("SAMPLE_ROWS", sample)):
        monkeypatch.setattr(hard_negatives, name, value)
    data = rows(200, dims, dims, ties)
    found = hard_negatives.mine(spark.createDataFrame(data, SCHEMA).repartition(4), lambda i: i % 5 == 0, positives=3, negatives=4)
    assert Counter(tuple(r) for r in found.collect()) == brute(data, 5, 3, 4)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 30), st.sampled_from([0.0, 0.5, 0.9, 2.0, -0.3]))
def test_threshold_join(seed, d, part):
    rng = np.random.default_rng(seed)
    q = rng.integers(-40, 60, (7, d)).astype(float) * 0.8 ** np.arange(d) // 1
    x = rng.integers(-40, 60, (33, d)).astype(float) * 0.8 ** np.arange(d) // 1
    products = q @ x.T
    low = np.ceil(part * np.abs(products).max(1)).astype(np.int64)
    i, j, score = hard_negatives.reaching(q, x, low)
    assert set(zip(i.tolist(), j.tolist(), score.tolist(), strict=True)) == {
        (a, b, int(products[a, b])) for a in range(7) for b in range(33) if products[a, b] >= low[a]}
    assert len(i) == len(set(zip(i.tolist(), j.tolist(), strict=True)))


def test_nothing_and_alone(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert hard_negatives.mine(spark.createDataFrame([], schema), lambda i: i % 2 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 3), (1, [1.0, 1.0], 4)], schema)
    assert hard_negatives.mine(one, lambda i: i == 0).count() == 0
