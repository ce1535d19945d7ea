"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its whole text; the chance that
one document is preferred to another is the logistic function of the difference
of their strengths. Every training pair joins a document labelled 1 (preferred)
with one labelled 0, and the weights minimise the logistic loss on the
differences of the pairs' features (Newton's method, ridge penalty). Strengths
are then cut at a quantile of the strengths of all training rows: the share of
label 0 among them. The score is the logistic function of the distance to that
cut, so 0.5 is the threshold.

Fitting the weights reads at most ``TRAIN_ROWS`` labelled rows, half of each
label, picked by a hash of their id; everything else covers all rows: the
features of all training rows are computed where their texts are and only these
short rows are kept, ordered and counted; a scan scores each text in one pass,
with a model of a few hundred bytes.

Features: shares of character classes, shares of repeated words and lines, word
and line lengths, and the worst values of these over windows of ``WINDOW``
words, so that junk in a part of a long text shows.

Defined results: a null text is scored as an empty one, whose features are all
0; without labels of both kinds every score is 0.5; rows with null or
repeated ids are scored like any other; labels other than 0 and 1 are left out of the
fitting; further columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_or_empty

TRAIN_ROWS = 20_000
PAIRS_EACH = 16  # pairs for each row of the rarer label
RIDGE = 1e-5
WINDOW = 64
SEED = 5_112
BINS = 4_096  # of a histogram of strengths

CLASSES = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "space": " \t\n\x0b\x0c\r", "stop": ".,",
           "shout": "!?", "sign": "#$%&*", "markup": "|<>{}[]=_~^\\/"}
LETTER, OTHER = len(CLASSES), len(CLASSES) + 1
NAMES = [*CLASSES, "letter", "other"]


def _class_table() -> np.ndarray:
    table = np.full(256, OTHER, np.int8)
    table[128:] = LETTER
    table[ord("a"):ord("z") + 1] = LETTER
    for k, chars in enumerate(CLASSES.values()):
        table[[ord(c) for c in chars]] = k
    return table


TABLE = _class_table()
SPACE = NAMES.index("space")
PEAKS = [k for k in range(len(NAMES)) if k not in (SPACE, LETTER)]
FEATURES = len(NAMES) + len(PEAKS) + 12


def features(text: str) -> np.ndarray:
    """The features of one text."""
    words = text.split()
    if not words:
        return np.zeros(FEATURES)
    kinds = TABLE[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    share = np.bincount(kinds, minlength=len(NAMES)) / len(kinds)
    # windows of characters, from the start of every WINDOW-th word
    space = kinds == SPACE
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    cuts = starts[::WINDOW] if len(starts) else np.zeros(1, np.int64)
    if len(cuts) > 1 and len(starts) - WINDOW * (len(cuts) - 1) < WINDOW // 2:
        cuts = cuts[:-1]  # a short rest joins the window before it
    lengths = np.diff(np.append(cuts, len(kinds)))
    peaks = [(np.add.reduceat((kinds == k).astype(np.int32), cuts) / lengths).max() for k in PEAKS]
    windows = [words[k:k + WINDOW] for k in range(0, len(words), WINDOW)]
    if len(windows) > 1 and len(windows[-1]) < WINDOW // 2:
        windows[-2:] = [windows[-2] + windows[-1]]  # here too
    distinct = [len(set(w)) / len(w) for w in windows]
    twice = [sum(map(str.__eq__, w, w[1:])) / len(w) for w in windows]
    lines = [line for line in text.split("\n") if line.strip()]
    return np.array([
        *share, *peaks, min(distinct), sum(distinct) / len(distinct), max(twice), sum(twice) / len(twice),
        len(set(words)) / len(words), len(set(lines)) / max(1, len(lines)), np.log1p(len(words)), len(text) / len(words),
        np.log1p(len(lines)), np.log1p(len(text) / max(1, len(lines))), max(map(len, words)) / len(text), float(words[0][:1].islower())])


@dataclass
class Model:
    """Strength ``(clip((x - mean) / spread)) . weights``; the score's threshold is at ``cut``."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.strengths(x) - self.cut
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(x: np.ndarray, label: np.ndarray, seed: int = SEED) -> Model:
    """Fit weights on preference pairs, then the cut on the quantile of these rows' strengths."""
    good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(poor):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0)
    mean, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - mean) / spread, -8, 8)
    rng = np.random.default_rng(seed)
    pairs = PAIRS_EACH * min(len(good), len(poor))
    d = z[rng.choice(good, pairs)] - z[np.resize(poor, pairs)]
    w = np.zeros(FEATURES)
    for _ in range(50):
        lost = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))  # chance given to the wrong order
        slope = RIDGE * w - d.T @ lost / pairs
        bend = (d * (lost * (1 - lost))[:, None]).T @ d / pairs + RIDGE * np.eye(FEATURES)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    strength = np.sort(z @ w)
    k = len(poor)
    return Model(mean, spread, w, float((strength[k - 1] + strength[k]) / 2))


def training_rows(docs: DataFrame, labels: DataFrame, is_training, text: str = "text", id_col: str = "doc_id",
                  label: str = "quality") -> DataFrame:
    """``(id, label, x)`` of all labelled training rows, ``x`` the features of the text."""
    @F.pandas_udf("array<double>")
    def all_features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t).tolist())

    known = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1)).filter(is_training(F.col("id"))).distinct())
    rated = (docs.select(F.col(id_col).alias("doc"), text_or_empty(text).alias("text")).filter(is_training(F.col("doc")))
             .select("doc", all_features("text").alias("x")))  # before the join: texts are not shuffled
    return rated.join(known, F.col("doc") == F.col("id")).select("id", "label", "x")


def pick(known: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED) -> DataFrame:
    """At most ``rows`` of the training rows, half of each label where there are so many."""
    picked = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy(F.xxhash64(F.lit(seed), "id"), "id", "x").limit(rows // 2)
        picked = part if picked is None else picked.unionByName(part)
    return picked


def training_sample(docs: DataFrame, labels: DataFrame, is_training, rows: int = TRAIN_ROWS, seed: int = SEED, **columns) -> DataFrame:
    """``(id, label, x)`` of at most ``rows`` labelled rows, half of each label where there are so many."""
    return pick(training_rows(docs, labels, is_training, **columns), rows, seed)


def quantile_cut(strengths: DataFrame, k: int) -> float:
    """Halfway between the ``k``-th smallest ``strength`` (from 1) and the next one.

    Histograms of ever smaller ranges find it: ``BINS`` rows at most come to the driver at a time.
    """
    s, rank = F.col("strength"), k
    low, high = strengths.agg(F.min(s), F.max(s)).first()
    while low < high:
        bin_ = F.least(F.floor((s - F.lit(low)) / F.lit(high - low) * BINS), F.lit(BINS - 1))
        for r in (strengths.filter(s.between(low, high)).groupBy(bin_.alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min(s).alias("low"), F.max(s).alias("high")).orderBy("bin").collect()):
            if rank <= r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    upto, above = strengths.agg(F.count(F.when(s <= low, 1)), F.min(F.when(s > low, s))).first()
    return low if upto > k else (low + above) / 2


def train(docs: DataFrame, labels: DataFrame, is_training, rows: int = TRAIN_ROWS, seed: int = SEED, **columns) -> Model:
    """Fit the weights on a bounded sample of labelled rows and cut at a quantile of all of them; texts stay on the executors."""
    known = staged(training_rows(docs, labels, is_training, **columns), "quality-training")
    sample = pick(known, rows, seed).collect()  # TRAIN_ROWS short rows at most
    sample.sort(key=lambda r: (r["id"], r["label"], r["x"]))
    model = fit(np.array([r["x"] for r in sample]).reshape(-1, FEATURES), np.array([r["label"] for r in sample]))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2 or max(counts.values()) <= rows // 2:
        return model  # nothing to order, or all rows are in the sample

    @F.pandas_udf("double")
    def strength(x: pd.Series) -> pd.Series:
        return pd.Series(model.strengths(np.array(x.tolist()).reshape(-1, FEATURES)))

    strengths = staged(known.select(strength("x").alias("strength")), "quality-strengths")
    return replace(model, cut=quantile_cut(strengths, counts[0]))


def score(model: Model, text: str = "text"):
    """A column: the score of each text, between 0 and 1."""
    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([features(t) for t in texts]).reshape(-1, FEATURES)))

    return scores(text_or_empty(text))


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose text scores at least 0.5, with the columns of ``docs``."""
    return docs.filter(score(model, text) >= 0.5)
