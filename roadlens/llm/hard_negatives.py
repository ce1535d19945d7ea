"""Hard negatives by threshold joins over a partial inverted index with norm bounds (in the manner of L2AP).

An anchor's positives are its best rows of the same label; each positive opens
a window of scores, from a share of its own score up to it, and the best rows
of other labels in the window are its hard negatives. Both are threshold joins:
find the rows whose inner product with the anchor is at least ``low``.

Vectors are dealt into slices and anchors into blocks, which meet by an equi-join.
A task orders the dimensions by their weight in its slice and indexes, of each
vector, only the leading ones: as soon as the norm of what is left, times the
anchors' norms there, stays under every threshold, the rest is omitted (a
vector that can't reach any threshold is omitted whole). Going through the
index a few dimensions at a time, partial scores are accumulated and columns
dropped once the remaining norms can't lift any of their scores to a threshold;
the pairs that are left get the omitted dimensions and the exact test.

The first threshold of a window is the score that a bounded sample of rows
(``SAMPLE_ROWS``) leads to expect at twice the rank that is wanted. Windows that it does not fill are
searched again with lower thresholds, at last with their own lower end. The
sample sets the order of the search only. Each task sends the best few of each
window, so answers are whole and a join's output grows with the anchors.

Scores are exact: in doubles where no sum can reach 2**53, else in Python's
integers. Defined results: rows with a null id, label or vector, or with null or
non-finite components (scaled ones included) take no part; vectors of different
lengths never meet, and those without components have the score 0; rows are told apart by their place,
so rows with equal ids or vectors all count and each anchor row has its own answer; scores beyond a long
count as the largest (or smallest) one; positives with a negative score have no window; fewer rows give
shorter lists; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SCALE = 256
SLICE_ROWS = 4096
BLOCK_ANCHORS = 4096
TILE_ANCHORS = 256  # anchors that meet a slice at a time
DIMENSIONS = 8  # dimensions accumulated between two looks at the remaining norms
SAMPLE_ROWS = 4096
SAMPLE_COMPONENTS = 1 << 20
LEAST, MOST = -(2 ** 63) + 1, 2 ** 63 - 1
SLACK = 1 + 1e-9  # for rounding in norms


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).reshape(rows, -1) if rows else np.zeros((0, 0))


def _beyond(x: np.ndarray) -> np.ndarray:
    """Rows whose products may pass 2**53."""
    return np.abs(x).max(1, initial=0) >= 2 ** 26 / max(1, x.shape[1]) ** 0.5


def _left(x: np.ndarray) -> np.ndarray:
    """Norms of what each row has from every dimension on; the last column is 0."""
    out = np.zeros((x.shape[0], x.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])
    return out


def reaching(q: np.ndarray, x: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``(i, j)`` with ``q[i] . x[j] >= low[i]``, and these products."""
    d = x.shape[1]
    order = np.argsort(-(x * x).sum(0), kind="stable")
    q, x, low = q[:, order], x[:, order], low.astype(np.float64)
    left_q, left_x = _left(q), _left(x)
    with np.errstate(divide="ignore", invalid="ignore"):
        # the norm under which what is left of a vector reaches no threshold
        enough = np.where(low[:, None] > 0, low[:, None] / left_q[:, :d], -np.inf).min(0, initial=np.inf)
    indexed = (left_x[:, :d] * SLACK >= enough).sum(1)
    by = np.argsort(-indexed, kind="stable")
    by = by[(indexed[by] > 0) | (d == 0)]
    done = np.zeros(len(by), np.int64)  # dimensions accumulated
    sums = np.zeros((len(q), len(by)))
    for a in range(0, d, DIMENSIONS):
        k = int((indexed[by] > a).sum())  # the lists of these dimensions hold the first k
        if not k:
            break
        b = min(a + DIMENSIONS, d)
        sums[:, :k] += q[:, a:b] @ x[by[:k], a:b].T
        done[:k] = b
        if b < d:
            stay = np.ones(len(by), bool)
            stay[:k] = (sums[:, :k] + left_q[:, b, None] * left_x[by[:k], b] * SLACK >= low[:, None]).any(0)
            if stay.sum() < 0.8 * len(by):
                by, done, sums = by[stay], done[stay], sums[:, stay]
    i, j = np.nonzero(sums + left_q[:, done] * left_x[by, done] * SLACK >= low[:, None])
    score = sums[i, j]
    places = np.arange(d)
    for a in range(0, len(i), 1 << 16):
        part = slice(a, a + (1 << 16))
        at = j[part]
        if (done[at] < d).any():
            score[part] += (q[i[part]] * x[by[at]] * (places >= done[at][:, None])).sum(1)
    on = score >= low[i]
    return i[on], by[j[on]], score[on].astype(np.int64)


def _exact(q: np.ndarray, x: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for rows of any size, without bounds."""
    if not len(q) or not len(x):
        return (np.zeros(0, np.int64),) * 3
    whole = np.vectorize(int, otypes=[object])
    products = whole(q) @ whole(x).T if x.shape[1] else np.zeros((len(q), len(x)), object)
    score = np.minimum(np.maximum(products, LEAST), MOST).astype(np.int64)
    i, j = np.nonzero(score >= low[:, None])
    return i, j, score[i, j]


def _pairs(q: np.ndarray, x: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    big_q, big_x = _beyond(q), _beyond(x)
    out = []
    for on_q, on_x, find in ((~big_q, ~big_x, reaching), (big_q, np.ones(len(x), bool), _exact), (~big_q, big_x, _exact)):
        at_q, at_x = np.flatnonzero(on_q), np.flatnonzero(on_x)
        if len(at_q) and len(at_x):
            i, j, score = find(q[at_q], x[at_x], low[at_q])
            out.append((at_q[i], at_x[j], score))
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def _first(owner: np.ndarray, score: np.ndarray, ident: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each owner: by score, then id, then row."""
    order = np.lexsort((row, ident, -score, owner))
    mine = owner[order]
    begin = np.searchsorted(mine, mine)
    return order[np.arange(len(order)) - begin < n]


_FOUND = "q bigint, row bigint, id bigint, score bigint"


def _search(same: bool, n: int):
    def run(_, vectors: pa.Table, anchors: pa.Table) -> pa.Table:
        names = ("q", "row", "id", "score")
        if not len(vectors) or not len(anchors):
            return pa.table({k: pa.array([], pa.int64()) for k in names})
        column = lambda t, name: t.column(name).to_numpy()
        x, rows, ids, labels = _matrix(vectors.column("v"), len(vectors)), *(column(vectors, k) for k in ("row", "id", "label"))
        every = _matrix(anchors.column("v"), len(anchors))
        windows = anchors.column("windows").to_pylist()
        out = []
        for a in range(0, len(anchors), TILE_ANCHORS):
            tile = slice(a, a + TILE_ANCHORS)
            q, asked = every[tile], windows[tile]
            anchor, label = column(anchors, "q")[tile], column(anchors, "label")[tile]
            width = max(map(len, asked))
            low = np.array([[w["low"] for w in ws] + [MOST] * (width - len(ws)) for ws in asked], np.int64)
            high = np.array([[w["high"] for w in ws] + [LEAST] * (width - len(ws)) for ws in asked], np.int64)
            i, j, score = _pairs(q, x, low.min(1))
            on = ((labels[j] == label[i]) == same) & (rows[j] != anchor[i])
            i, j, score = i[on], j[on], score[on]
            sent = np.zeros(len(i), bool)
            for k in range(width):
                at = np.flatnonzero((score >= low[i, k]) & (score <= high[i, k]))
                sent[at[_first(i[at], score[at], ids[j[at]], rows[j[at]], n)]] = True
            out.append((anchor[i[sent]], rows[j[sent]], ids[j[sent]], score[sent]))
        return pa.table(dict(zip(names, map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return run


def _guess(same: bool, n: int, sample, share: float):
    """Per window two thresholds: the sample's scores at twice and at 16 times the wanted rank, or the window's lower end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, by_length = sample.value
        for batch in batches:
            out = {k: [] for k in ("q", "w", "floor", "high", "low0", "low1")}
            for r in batch.to_pylist():
                x, at = by_length.get(len(r["v"]), (np.zeros((0, len(r["v"]))), np.zeros(0, np.int64)))
                other = ((labels[at] == r["label"]) == same) & (rows[at] != r["q"])
                with np.errstate(over="ignore", invalid="ignore"):
                    score = np.sort(np.nan_to_num(x[other] @ np.floor(SCALE * np.array(r["v"]))))
                score = np.clip(score, -2.0 ** 62, 2.0 ** 62).astype(np.int64)
                for w in r["windows"]:
                    top = int(np.searchsorted(score, w["high"], "right"))
                    for name, times in (("low0", 2), ("low1", 16)):
                        k = top - int(np.ceil(times * n * share))
                        out[name].append(max(w["floor"], int(score[k])) if 0 <= k < top else w["floor"])
                    for name in ("w", "floor", "high"):
                        out[name].append(w[name])
                    out["q"].append(r["q"])
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return run


class _Join:
    """The rows that take part, dealt into slices, and the anchors, dealt into blocks."""

    def __init__(self, rows: DataFrame, is_anchor, id_col: str, label: str, vector: str):
        sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) * SCALE < float("inf")))
        self.rows = staged(rows.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & sound).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
            F.col(vector).cast("array<double>").alias("v")), "negatives-rows")
        self.anchors = self.rows.filter(is_anchor(F.col("id"))).withColumnRenamed("row", "q")
        size = self.rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor(F.col("id"))).alias("m"), F.max(F.size("v")).alias("d")).first()
        self.slices, self.blocks = (max(1, -(-size[k] // per)) for k, per in (("n", SLICE_ROWS), ("m", BLOCK_ANCHORS)))
        # a bounded sample, from which only the order of the search follows
        taken = min(SAMPLE_ROWS, max(64, SAMPLE_COMPONENTS // max(1, size["d"] or 1)))
        picked = self.rows.orderBy(F.xxhash64("row"), "row").limit(taken).collect()
        lengths: dict[int, list[int]] = {}
        for k, r in enumerate(picked):
            lengths.setdefault(len(r["v"]), []).append(k)
        by_length = {d: (np.floor(SCALE * np.array([picked[k]["v"] for k in at]).reshape(len(at), d)), np.array(at)) for d, at in lengths.items()}
        self.sample = rows.sparkSession.sparkContext.broadcast(
            (np.array([r["row"] for r in picked], np.int64), np.array([r["label"] for r in picked], np.int64), by_length))
        self.share = len(picked) / max(1, size["n"])

    def _meet(self, anchors: DataFrame, function) -> DataFrame:
        deal = lambda col, parts: F.pmod(F.xxhash64(col), F.lit(parts)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        dims = F.size("v").alias("dims")
        vectors = self.rows.select("*", dims, deal("row", self.slices).alias("slice")).withColumn("block", every(self.blocks))
        anchors = anchors.select("*", dims, deal("q", self.blocks).alias("block")).withColumn("slice", every(self.slices))
        key = ["dims", "slice", "block"]
        vectors = vectors.toDF(*vectors.columns)  # columns of their own, as the anchors come from the same rows
        return vectors.groupBy(*key).cogroup(anchors.groupBy(*key)).applyInArrow(function, _FOUND)

    def best(self, windows: DataFrame, same: bool, n: int) -> DataFrame:
        """``(q, w, row, id, score, rank)``: the first ``n`` rows with a score in each window ``(q, w, floor, high)``."""
        several = lambda *cols: F.collect_list(F.struct(*cols)).alias("windows")  # noqa: E731  an anchor has few windows
        asked = self.anchors.join(windows.groupBy("q").agg(several("w", "floor", "high")), "q")
        open_ = staged(asked.select("q", "label", "v", "windows").mapInArrow(
            _guess(same, n, self.sample, self.share), "q bigint, w bigint, floor bigint, high bigint, low0 bigint, low1 bigint"), "negatives-windows")
        order = Window.partitionBy("q", "w").orderBy(F.desc("score"), "id", "row")
        done = None
        for low in ("low0", "low1", "floor"):
            anchors = self.anchors.join(open_.groupBy("q").agg(several(F.col(low).alias("low"), "high")), "q")
            found = self._meet(anchors, _search(same, n))
            top = staged(found.join(open_, "q").filter(F.col("score").between(F.col(low), F.col("high"))).withColumn(
                "rank", F.row_number().over(order)).filter(F.col("rank") <= n)
                .select("q", "w", "row", "id", "score", "rank", (F.col(low) == F.col("floor")).alias("last")), "negatives-" + low)
            full = top.groupBy("q", "w").agg(F.count(F.lit(1)).alias("k"), F.first("last").alias("last")).filter((F.col("k") >= n) | F.col("last"))
            part = top.join(full.select("q", "w"), ["q", "w"], "left_semi").drop("last")
            done = part if done is None else done.unionByName(part)
            if low != "floor":
                open_ = staged(open_.filter(F.col(low) > F.col("floor")).join(full.select("q", "w"), ["q", "w"], "left_anti"), "negatives-open")
                if open_.isEmpty():
                    break
        return done


def mine(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 5, id_col: str = "vec_id", label: str = "label",
         vector: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows for which ``is_anchor(id)`` holds.

    A hard negative scores from four fifths of its positive's score up to it.
    """
    j = _Join(rows, is_anchor, id_col, label, vector)
    everything = j.anchors.select("q", F.lit(0).cast("bigint").alias("w"), F.lit(LEAST).alias("floor"), F.lit(MOST).alias("high"))
    near = staged(j.best(everything, True, positives), "negatives-positives")
    # 80 p <= 100 s: s >= p - floor(p / 5)
    windows = near.filter("score >= 0").select("q", F.col("rank").cast("bigint").alias("w"), F.expr("score - score div 5").alias("floor"), F.col("score").alias("high"))
    found = j.best(windows, False, negatives).select("q", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = near.select("q", F.col("rank").cast("bigint").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (pairs.join(found, ["q", "w"]).join(j.anchors.select("q", F.col("id").alias("anchor_id")), "q")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
