"""Exact dedup and sharding against brute force, with awkward rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from fixtures import empty_docs, odd_docs, odd_rows

from roadlens.llm import exact_dedup, sharding

DROP = str.maketrans("", "", " \t\n\x0b\x0c\r")


def norm(t):
    return (t or "").translate(DROP)


@pytest.mark.parametrize("fan_in", [2, 8])
def test_groups_equal_brute_force(spark, fan_in):
    marked, c = exact_dedup.mark_copies(odd_docs(spark), fan_in=fan_in)
    rows = marked.collect()
    groups = defaultdict(list)
    for r in odd_rows():
        groups[norm(r[1])].append(r)
    assert len(rows) == len(odd_rows())
    kept = Counter()
    for r in rows:
        group = groups[norm(r["text"])]
        best = min(group, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
        assert r[c["copies"]] == len(group)
        assert r[c["keep"]] == best[0]
        assert bytes(r[c["digest"]]).hex() == hashlib.sha256(norm(r["text"]).encode()).hexdigest()
        kept[norm(r["text"])] += r[c["kept"]]
    assert set(kept.values()) == {1}  # of repeated rows, exactly one stays


def test_dedup_keeps_columns_and_one_row_per_text(spark):
    docs = odd_docs(spark)
    out = exact_dedup.dedup(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    texts = [norm(r["text"]) for r in out.collect()]
    assert sorted(texts) == sorted({norm(r[1]) for r in odd_rows()})


def test_dedup_of_nothing(spark):
    assert exact_dedup.dedup(empty_docs(spark)).count() == 0


def test_plan_has_no_python(spark):
    marked, _ = exact_dedup.mark_copies(odd_docs(spark))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_hot_text_arrives_as_one_row_per_run(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, concat('u', id), 'same text') AS text").repartition(8)
    marked, c = exact_dedup.mark_copies(docs)
    rows = {r["doc_id"]: r for r in marked.collect()}
    assert sum(r[c["kept"]] for r in rows.values()) == 1001
    assert rows[1][c["copies"]] == 2000 and rows[1][c["kept"]] and rows[2][c["keep"]] == 1


@pytest.mark.parametrize("shards", [3, 16])
def test_rows_law(spark, shards):
    placed, c = sharding.shard(odd_docs(spark), shards=shards, bucket_bytes=4096)
    rows = placed.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r[0], r[1]) for r in odd_rows())
    slots = defaultdict(list)
    for r in rows:
        raw = (r["text"] or "").encode()
        assert r[c["size"]] == len(raw) + 1 and r[c["crc"]] == zlib.crc32(raw)
        slots[r[c["shard"]]].append(r[c["slot"]])
    sizes = [len(slots[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_of_nothing_and_reruns(spark):
    assert sharding.shard(empty_docs(spark))[0].count() == 0
    docs = spark.range(500).selectExpr("id AS doc_id", "repeat('x', cast(id AS int)) AS text")
    runs = []
    for seed in (1, 1, 2):
        placed, c = sharding.shard(docs, seed=seed, bucket_bytes=8192)
        runs.append(sorted((r["doc_id"], r[c["shard"]], r[c["slot"]]) for r in placed.collect()))
    assert runs[0] == runs[1] != runs[2]


def test_equal_rows_scatter_evenly(spark):
    docs = spark.range(4000).selectExpr("cast(null AS bigint) AS doc_id", "'same' AS text")
    names = dict(zip(["size", "crc", "row", "key", "bucket"], ["size", "crc", "row", "key", "bucket"], strict=True))
    dealt, buckets = sharding.scatter(docs, "text", 5, 2000, names)
    sizes = [r["count"] for r in dealt.groupBy("bucket").count().collect()]
    assert max(sizes) < 3 * 4000 / buckets
