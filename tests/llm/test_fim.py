"""Fill-in-middle against a brute-force version."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from fixtures import empty_docs, odd_docs, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from roadlens.llm import fim
from roadlens.llm.queries import op13_fim


def brute(doc_id, text, rate=90, spm=20):
    """Output, form, units and code points of prefix and middle."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return text, "plain", n, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return f"<S>{s}<P>{p}<M>{m}", "spm", n, len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", "psm", n, len(p), len(m)


def test_odd_rows(spark):
    rng = random.Random(4)
    more = [(100 + k, "".join(rng.choice("abcXYZ  \n.é日🎉<>PSM") for _ in range(rng.randint(0, 3000)))) for k in range(150)]
    more += [(300 + k, t) for k, t in enumerate(["a<", "<P", "P>x", "<S>", "x<M>y", "<<P>>", "<P<S", "é" * 2000, "🎉x" * 700, words(20_000, 3)] * 4)]
    odd = odd_rows()
    rows = odd + [(i, t, *odd[0][2:]) for i, t in more]
    docs = spark.createDataFrame(rows, odd_docs(spark).schema).withColumnRenamed("key", "output").withColumnRenamed("digest", "Form").repartition(3)
    out, c = fim.transform(docs)
    assert [x.lower() for x in out.columns].count("output") == 1 and len(set(map(str.lower, out.columns))) == len(out.columns)
    got = out.select("doc_id", "text", *(out[c[k]].alias("g_" + k) for k in c), fim.restore(out[c["output"]], out[c["form"]]).alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r["g_" + k] for k in ("output", "form", "units", "prefix_chars", "middle_chars")) == brute(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {r["g_form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(empty_docs(spark))[0].count() == 0


@pytest.mark.parametrize("block,piece", [(1, 1), (3, 6), (512, 1 << 22)])
def test_blocks_do_not_matter(monkeypatch, block, piece):
    monkeypatch.setattr(fim, "BLOCK", block)
    monkeypatch.setattr(fim, "PIECE", piece)
    rng = random.Random(block)
    texts = ["".join(rng.choice("ab é日.🎉") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    raw, offsets = fim._raw(pa.array(texts))
    trees = fim.Trees(raw, offsets)
    for k, t in enumerate(texts):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
        assert trees.n[k] == len(units)
        cuts = np.arange(len(units) + 1)
        byte, points = trees.find(np.full(len(cuts), k), cuts)
        before = ["".join(units[:c]) for c in cuts]
        assert byte.tolist() == [len(x.encode()) for x in before] and points.tolist() == [len(x) for x in before]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aZ <PSM>é🎉", max_size=30), max_size=8), st.integers(0, 2 ** 32))
def test_any_texts(texts, seed):
    draws = np.random.default_rng(seed).integers(0, 2 ** 32, (len(texts), 4))
    out, forms, n, prefix, middle = fim.rearrange(pa.array(texts, pa.string()), draws, 90, 20)
    for k, t in enumerate(texts):
        if forms[k] == "plain":
            assert out[k].decode() == t
        else:
            order = {"psm": "<P>(.*)<S>(.*)<M>(.*)", "spm": "<S>(.*)<P>(.*)<M>(.*)"}[forms[k]]
            x, y, z = re.fullmatch(order, out[k].decode(), re.S).groups()
            p, s = (x, y) if forms[k] == "psm" else (y, x)
            assert p + z + s == t and (prefix[k], middle[k]) == (len(p), len(z))


def test_query(spark):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = set()
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        out, form, n, prefix, middle = brute(r["doc_id"], r["text"])
        expected.add((r["doc_id"], n, form, prefix, middle, sha(out), sha(r["text"] or "")))
    assert {tuple(r) for r in op13_fim(spark, SF_SMALL).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256").collect()} == expected
