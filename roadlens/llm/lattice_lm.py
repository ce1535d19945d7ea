"""Language-model scores from a subword lattice.

The vocabulary is a public one and stays as it is: its entries are the arcs of
a lattice over each word's bytes (the word with a space before it). Every path
through the lattice is a segmentation, weighted by the product of its entries'
probabilities; a forward recursion in log space sums over all of them, so a
text's score is its marginal probability, not that of one best segmentation.
Entries never reach over a word's end, so the recursion over a text is the sum
over its words, plus the probability of the end.

The vocabulary's scores are its order: entry ``r`` has a weight in proportion to
1 / (r + 1), so no entry has weight 0 and every byte string has a score. A word met in
training has one arc more, over the whole word: its count less ``DISCOUNT``, over all
words; what the discounts free is the weight of the subword paths. So the
probabilities of all words sum to at most 1. Without these arcs (``whole_words=False``)
the vocabulary's scores alone are the model.

The sum over the segmentations of each distinct word of the corpus is computed once, next to its count.

For comparison, texts also get the score of plain smoothed word counts. The
counts of the ``HEAD_WORDS`` most frequent words (of at most ``HEAD_BYTES``
bytes, so the size is bounded) go to all tasks; all other words of a text are
looked up by a join, so the counts are exact for every word.

Defined results: a null text is an empty one, which has the end token only; a row
without an id belongs to the training texts; without training texts the prior
alone is the model; rows with repeated ids are scored each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .bpe import Vocabulary
from .common import WORD, most_frequent, staged, text_or_empty

DISCOUNT = 0.75
HEAD_WORDS = 1 << 16
HEAD_BYTES = 64
CHUNK = 20_000  # words that go through the lattice together
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCORED = "n_tokens bigint, known bigint, base double, model double, words array<string>, times array<bigint>"
TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


class Lattice:
    """All segmentations of words over a vocabulary's entries."""

    def __init__(self, vocabulary: Vocabulary):
        self.edges, self.children, self.ends = vocabulary.edges, vocabulary.children, vocabulary.ends
        self.size = vocabulary.size

    def arcs(self, text: np.ndarray):
        """Arcs of equally long words (rows of ``text``): from, to, rows, entries; ordered by where they start."""
        n = text.shape[1]
        for i in range(n):
            rows, node = np.arange(len(text)), np.zeros(len(text), np.int64)
            for j in range(i, n):
                keys = node * 256 + text[rows, j]
                edge = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
                on = self.edges[edge] == keys
                rows, node = rows[on], self.children[edge[on]]
                if not len(rows):
                    break
                entry = self.ends[node]
                whole = entry >= 0
                if whole.any():
                    yield i, j + 1, rows[whole], entry[whole]

    @staticmethod
    def groups(words: list[bytes]):
        """Places and byte matrix of words of equal length, in chunks."""
        raw = [b" " + w for w in words]
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(raw):
            by_length.setdefault(len(w), []).append(k)
        for n, places in by_length.items():
            step = max(1, min(CHUNK, 400_000 // n))
            for s in range(0, len(places), step):
                part = places[s:s + step]
                yield np.array(part), np.frombuffer(b"".join(raw[k] for k in part), np.uint8).reshape(-1, n).astype(np.int64)

    def marginals(self, words: list[bytes], weight: np.ndarray) -> np.ndarray:
        """The natural log of each word's probability: log sums over all paths to each place, the last one's."""
        out = np.zeros(len(words))
        for places, text in self.groups(words):
            alpha = np.full((len(text), text.shape[1] + 1), -np.inf)
            alpha[:, 0] = 0
            for i, j, rows, entry in self.arcs(text):
                alpha[rows, j] = np.logaddexp(alpha[rows, j], alpha[rows, i] + weight[entry])
            out[places] = alpha[:, -1]
        return out


def _lower(col: str):
    return F.translate(text_or_empty(col), UPPER, LOWER)


def scores(size: int) -> np.ndarray:
    """Natural log weights of a vocabulary's entries, from their order."""
    p = 1.0 / (np.arange(size) + 1.0)
    return np.log(p / p.sum())


def word_table(docs: DataFrame, is_training, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``(word, c, spelt)`` over all words of the texts: uses in training texts, and the natural log of the sum over its segmentations."""
    learned = F.when(is_training, 1).otherwise(0).alias("learned")
    counts = (docs.select(learned, F.explode(F.regexp_extract_all(_lower(text), F.lit(WORD), F.lit(0))).alias("word"))
              .groupBy("word").agg(F.sum("learned").alias("c")))
    shared = docs.sparkSession.sparkContext.broadcast((Lattice(vocabulary), scores(vocabulary.size)))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, weight = shared.value
        for b in batches:
            spelt = lattice.marginals(b.column(0).cast(pa.binary()).to_pylist(), weight)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spelt)], names=["word", "c", "spelt"])

    return staged(counts.mapInArrow(spell, "word string, c bigint, spelt double"), "lm-words")


def _score_texts(head, ends: tuple[float, float, int]):
    """Per text: tokens, known head tokens, base and model score of the head's words and the end, and the other words.

    ``head`` has the base and the model score of its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value
        for b in batches:
            for s in range(0, len(b), 2000):
                part = b.slice(s, 2000)
                tokens, sure, base, model, words, times = [], [], [], [], [], []
                for t in part.column(1).to_pylist():
                    # bytes.split() cuts at space and the control characters 9 to 13, and at nothing else
                    bag = Counter(t.encode("utf-8", "replace").translate(TO_LOWER).split())
                    inside = [(known[x], n) for x, n in bag.items() if x in known]
                    rest = [(x, n) for x, n in bag.items() if x not in known]
                    tokens.append(sum(bag.values()) + 1)
                    base.append(sum(n * x[0] for x, n in inside) + ends[0])
                    model.append(sum(n * x[1] for x, n in inside) + ends[1])
                    sure.append(sum(n for _, n in inside) + ends[2])
                    words.append([x.decode() for x, _ in rest])
                    times.append([n for _, n in rest])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(tokens, pa.int64()), pa.array(sure, pa.int64()), pa.array(base, pa.float64()),
                     pa.array(model, pa.float64()), pa.array(words, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))],
                    names=["row", "kept", "n_tokens", "known", "base", "model", "words", "times"])

    return run


def score(docs: DataFrame, is_training, vocabulary_path: str, text: str = "text", head_words: int = HEAD_WORDS,
          whole_words: bool = True) -> DataFrame:
    """``docs`` without the text, with n_tokens, n_known, train_tokens, base_score and score.

    ``is_training`` is a column that marks the rows to learn from; ``whole_words`` whether their words are arcs of their own.
    """
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c != text and c.lower() not in ("n_tokens", "n_known", "train_tokens", "base_score", "score")]
    table = word_table(docs, is_training, Vocabulary(vocabulary_path), text)
    texts = docs.filter(is_training).count()
    sums = table.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    words, kinds = sums["n"] or 0, sums["v"]
    n, v = words + texts, kinds + (texts > 0)

    denominator = n + 0.5 * (v + 1)
    end = (texts + 0.5) / (n + 1)
    # natural log of the weight of one count, and of all subword paths together
    arcs = whole_words and words > 0
    unit = float(np.log((1 - end) / words)) if arcs else 0.0
    free = float(np.log(DISCOUNT * kinds) + unit) if arcs else float(np.log(1 - end))
    spelt = F.col("spelt") + free
    arc = F.when(F.lit(arcs) & (F.col("c") > 0), F.log(F.col("c") - DISCOUNT) + unit)
    # log(exp(a) + exp(b)) from the larger one
    high, low = F.greatest(arc, spelt), F.least(arc, spelt)
    both = F.when(arc.isNull(), spelt).otherwise(high + F.log1p(F.exp(low - high))) / float(np.log(10.0))
    table = table.select("word", "c", F.log10((F.col("c") + 0.5) / F.lit(denominator)).alias("base"), both.alias("model"))
    # a fixed number of words of bounded length
    top = most_frequent(table.filter((F.octet_length("word") <= HEAD_BYTES) & (F.col("c") > 0)), "word", "c", head_words).select("word")
    top = table.join(F.broadcast(top), "word").collect()
    head = spark.sparkContext.broadcast({r["word"].encode(): (r["base"], r["model"]) for r in top})
    run = _score_texts(head, (float(np.log10((texts + 0.5) / denominator)), float(np.log10(end)), int(texts > 0)))
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), text_or_empty(text).alias("text"), F.struct(*rest).alias("kept"))
    schema = StructType([*keyed.drop("text").schema.fields, *StructType.fromDDL(SCORED).fields])
    first = staged(keyed.mapInArrow(run, schema), "lm-texts")
    others = (first.select("row", F.explode(F.arrays_zip("words", "times")).alias("x"))
              .select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times")))
    looked_up = others.join(table, "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.col("base")).alias("more_base"), F.sum(F.col("times") * F.col("model")).alias("more_model"))
    scored = first.drop("words", "times").join(looked_up, "row", "left")
    return scored.select("kept.*", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", F.lit(0.0))).alias("score"))
