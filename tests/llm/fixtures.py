"""Small tables with the awkward cases: nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

CLASHING = "row bigint, key string, digest string, size int, copies int, kept boolean, id string, n_tokens int, shard string, best string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
BLANK = " \t\n\x0b\x0c\r"


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgnorst") for _ in range(rng.randint(2, 6))) for _ in range(n))


def odd_rows() -> list[tuple]:
    base = words(120, 1)
    texts = [
        (1, base), (2, base), (3, base.replace(" ", "  ")), (4, base.replace(" ", "\n", 3) + "\t"), (5, base + " extra"),
        (6, None), (7, ""), (8, BLANK), (9, "a"), (10, "A b"), (11, "a B"), (12, "a b c"),
        (13, words(60_000, 2)), (14, "x" * 30_000), (15, "é" * 500 + " ñ 日本語 🎉"), (16, words(30, 3)), (16, words(30, 3)),
        (None, words(40, 4)), (None, words(40, 4)), (None, None), (17, "the the the the " * 50), (18, "\x00\x01 odd\x85x"),
        (19, "<|endoftext|>tail<|endoftext|>"),
    ]
    out = []
    for k, (i, t) in enumerate(texts):
        out.append((i, t, [None, "en", "fr"][k % 3], [None, "s1", "s2", "s0", ""][k % 5], k if k % 4 else None,
                    k % 3, "k", "d", 7, None, True, "id", None, "s", None))
    return out


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
