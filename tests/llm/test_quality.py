"""The pairwise classifier on held-out rows, and its defined cases."""

import zlib

import numpy as np
from conftest import SF_SMALL
from fixtures import empty_docs, odd_docs

from roadlens.llm import quality
from roadlens.llm.queries import op1_quality

SF = SF_SMALL.replace("0.001", "0.01")


def test_held_out_accuracy(spark):
    scored = {r["doc_id"]: r for r in op1_quality(spark, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in scored.items())
    held = [(scored[i]["score"], y) for i, y in labels.items() if scored[i]["held_out"]]
    good, poor = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert np.mean([g > p for g in good for p in poor]) > 0.98
    assert np.mean([s >= 0.5 for s in good]) > 0.98
    assert np.mean([s < 0.5 for s in poor]) > 0.9


def test_fit_orders_pairs_and_cuts_at_the_quantile():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, quality.FEATURES))
    y = (x[:, 0] - x[:, 1] + 0.1 * rng.normal(size=400) > -0.8).astype(int)
    model = quality.fit(x, y)
    s = model.scores(x)
    assert (s >= 0.5).sum() == y.sum()  # as many below the cut as there are rows labelled 0
    assert np.mean((s >= 0.5) == (y == 1)) > 0.95


def test_one_label_only_gives_half():
    model = quality.fit(np.ones((5, quality.FEATURES)), np.ones(5))
    assert model.scores(np.zeros((1, quality.FEATURES)))[0] == 0.5


def test_odd_rows_and_no_labels(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (17, 0), (5, None), (None, 1), (6, 3), (1, 1)], "doc_id bigint, quality int")
    model = quality.train(docs, labels, lambda i: i == i)
    rows = docs.withColumn("s", quality.score(model)).select("doc_id", "s").collect()
    assert len(rows) == docs.count() and all(0 <= r["s"] <= 1 for r in rows)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    none = quality.train(empty_docs(spark), labels.limit(0), lambda i: i == i)
    assert {r["s"] for r in docs.select(quality.score(none).alias("s")).collect()} == {0.5}
    assert empty_docs(spark).select(quality.score(none)).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    labels = spark.range(300).selectExpr("id AS doc_id", "cast(id % 3 = 0 AS int) AS quality")
    sample = quality.training_sample(docs, labels, lambda i: i >= 0, rows=40).collect()
    assert len(sample) == 40 and sum(r["label"] for r in sample) == 20


def test_cap_of_the_sample_leaves_the_cut(spark):
    """The cut is at the share of label 0 among all training rows, however few of them the weights are fitted on."""
    docs = spark.range(400).selectExpr("id AS doc_id", "concat(repeat('word and more, ', 5 + id % 7), repeat('AB!? ', hash(id) % 5), id) AS text")
    labels = spark.range(400).selectExpr("id AS doc_id", "cast(id % 5 > 0 AS int) AS quality")
    for rows in (40, 20_000):
        model = quality.train(docs, labels, lambda i: i >= 0, rows=rows)
        scores = [r["s"] for r in docs.select(quality.score(model).alias("s")).collect()]
        ties = sum(abs(s - 0.5) < 1e-9 for s in scores)
        assert sum(s < 0.5 - 1e-9 for s in scores) <= 80 <= sum(s < 0.5 - 1e-9 for s in scores) + ties


def test_quantile_cut(spark):
    values = [3.5, -2.0, 1e-300, 1e-300, 7.0, 8.0, 1e9, 0.0, 3.5, 3.5]
    frame = spark.createDataFrame([(v,) for v in values], "strength double")
    ordered = sorted(values)
    assert [quality.quantile_cut(frame, k) for k in range(1, 10)] == [(ordered[k - 1] + ordered[k]) / 2 for k in range(1, 10)]


def test_sample_orders_short_rows_only(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    labels = spark.range(300).selectExpr("id AS doc_id", "cast(id % 3 = 0 AS int) AS quality")
    sample = quality.training_sample(docs, labels, lambda i: i >= 0, rows=40)
    assert sorted(sample.columns) == ["id", "label", "x"]
    ordered = [line for line in sample._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Sort [" in line]
    assert len(ordered) == 2 and not [line for line in ordered if "text" in line]


def test_short_rest_joins_the_last_window():
    """Repeated words in the last few words of a text show in the features of repeated words."""
    rest = quality.features(" ".join([f"w{k}" for k in range(64)] + ["spam"] * 20))
    plain = quality.features(" ".join(f"w{k}" for k in range(84)))
    at = len(quality.NAMES) + len(quality.PEAKS)
    assert np.allclose(plain[at:at + 4], [1, 1, 0, 0])
    assert np.allclose(rest[at:at + 4], [65 / 84, 65 / 84, 19 / 84, 19 / 84])
