"""The pipeline's stages on the small table, each held against brute force on its own input."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from conftest import SF_SMALL
from fixtures import empty_docs, odd_docs
from test_mixing import count, share_out
from test_ngram_join import shingles
from tokenizers import Tokenizer

import __spark_entry__
from roadlens.llm.common import staged

DROP = re.compile(r"[\x20\x09-\x0D]")


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF_SMALL), "test-stage")
        out[name] = (docs.collect(), after.collect(), docs.columns, after.columns)
        docs = after
    return out


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == list(stages) and len(names) == 5
    for n in names[:-1]:
        assert stages[n][2] == stages[n][3]


def test_quality(spark, stages):
    before, after, *_ = stages["quality classifier"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    good = [i for i, y in labels.items() if y == 1]
    poor = [i for i, y in labels.items() if y == 0]
    assert kept < {r["doc_id"] for r in before}
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in poor) <= 0.2 * len(poor)


def test_exact_dedup(stages):
    before, after, *_ = stages["exact dedup"]
    best = {}
    for r in before:
        k, v = DROP.sub("", r["text"] or ""), (-len(r["text"] or ""), r["doc_id"])
        best[k] = min(best.get(k, v), v)
    assert sorted(r["doc_id"] for r in after) == sorted(i for _, i in best.values())


def test_near_dedup(stages):
    before, after, *_ = stages["n-gram Jaccard join"]
    sets = {r["doc_id"]: shingles(r["text"], corpus_pipeline.SHINGLE_WORDS) for r in before}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and 100 * len(x & y) >= corpus_pipeline.SIMILARITY * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    assert sorted(r["doc_id"] for r in after) == sorted({root(i) for i in sets})


def test_mixing(stages):
    before, after, *_ = stages["mixing sources"]
    sizes, largest, taken = defaultdict(int), defaultdict(int), Counter()
    for r in before:
        sizes[r["source"]] += count(r["text"])
        largest[r["source"]] = max(largest[r["source"]], count(r["text"]))
    for r in after:
        taken[r["source"]] += count(r["text"])
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2
    for s, t in share_out(dict(sizes)).items():
        assert abs(taken[s] - t) <= largest[s]


def test_encoding(stages):
    before, after, *_ = stages["BPE encoding"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in before)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in after) == want
    assert all(r["decodes"] and r["n_tokens"] == len(r["ids"]) for r in after)


def test_registered_and_run(spark, stages):
    assert "pipeline" in __spark_entry__.queries()
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in stages["BPE encoding"][1])


def test_stages_on_awkward_tables(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            after = staged(stage(spark, docs, SF_SMALL), "test-odd")
            assert name == corpus_pipeline.STAGES[-1][0] or after.columns == docs.columns
            docs = after
