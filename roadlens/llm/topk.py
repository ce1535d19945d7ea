"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are turned into integers, equal vectors are collapsed to one (with
their ``k + 1`` smallest ids, more can never be returned), and cut into
``FRAGMENTS`` pieces by dimension. A node is one piece of one slice of the
vectors; it scores its pieces against a block of queries, so each object's
score is spread over ``FRAGMENTS`` nodes.

1. Every node sends its ``k + 1`` best partial scores for each query. The
   objects seen are scored exactly; the (k+1)-th best of them, ``t``, is a safe
   cutoff: no object below it is in the answer.
2. The cutoff travels back with the queries. A node sends every entry whose
   partial score is at least ``t / FRAGMENTS``; an object that no node sends sums to
   less than ``t``. Entries equal to the threshold are sent, so ties are kept.
3. Objects with an entry are scored exactly where not all pieces arrived, and
   the best are taken by score, then smaller id.

All arithmetic is on integers (in doubles where every sum is below 2**53, in Python's where
one may pass 2**63; a piece's score beyond 2**62 is not sent, its object is scored as a whole).
Slices and query blocks meet by an equi-join on (piece, slice, block) in
co-grouped tasks of bounded size; nothing is broadcast or gathered.

Defined results: vectors that are null, empty, or hold null or non-finite components
take no part, nor do rows without an id; components and scores beyond 64 bits end at the
largest and smallest long; vectors of different lengths are never compared; a query leaves out
its own row, rows of the same id with another vector are candidates and queries of their own;
a query row that occurs twice is answered once; fewer candidates give shorter lists; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged

SCALE = 1024
FRAGMENTS = 2
SLICE_ROWS = 2048
BLOCK_QUERIES = 1024
LEAST, MOST = -(2 ** 63), 2 ** 63 - 1


def integer_vectors(rows: DataFrame, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``(id, v)`` of the rows that take part, with floor(scale * x) for every component."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return rows.filter(F.col(id_col).isNotNull() & (F.size(vector) > 0) & sound).select(
        F.col(id_col).cast("bigint").alias("id"), scaled.cast("array<bigint>").alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` exactly: longs, or Python's integers where a sum may pass them."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    size = lambda x: max(int(x.max()), -int(x.min()))
    bound = size(a) * size(b) * a.shape[1]
    if bound < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2 ** 63:
        return a @ b.T
    return a.astype(object) @ b.astype(object).T


def _longs(scores: np.ndarray) -> np.ndarray:
    return scores if scores.dtype == np.int64 else np.minimum(np.maximum(scores, LEAST), MOST).astype(np.int64)


def _width(t: pa.Table) -> int:
    return len(t.column("v")[0])


def _lists(k: int):
    def run(_, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            return pa.table({"q": pa.array([], pa.int64()), "rep": pa.array([], pa.int64())})
        w, reps, ids = _width(vectors), vectors.column("rep").to_numpy(), queries.column("q").to_numpy()
        scores = _products(_matrix(queries.column("v"), w), _matrix(vectors.column("v"), w))
        n = min(k, len(reps))
        best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
        return pa.table({"q": np.repeat(ids, n), "rep": reps[best].ravel()})

    return run


def _entries(fragments: int):
    def run(_, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            return pa.table({c: pa.array([], pa.int64()) for c in ("q", "rep", "least", "part")})
        w, reps, ids = _width(vectors), vectors.column("rep").to_numpy(), queries.column("q").to_numpy()
        safe = 2 ** 62 // fragments  # as many sums of this size stay within a long
        scores = _products(_matrix(queries.column("v"), w), _matrix(vectors.column("v"), w))
        cutoff = queries.column("cutoff").to_pylist()
        every = np.array([c is None or c == LEAST for c in cutoff])
        cutoffs = np.array([0 if c is None else -(-c // fragments) for c in cutoff])  # ceil(t / fragments)
        a, b = np.nonzero((scores >= cutoffs[:, None]) | every[:, None])
        part = scores[a, b]
        return pa.table({"q": ids[a], "rep": reps[b], "least": vectors.column("least").to_numpy()[b],
                         "part": pa.array(_longs(part), mask=np.asarray((part > safe) | (part < -safe), bool))})

    return run


def _resolve(_, vectors: pa.Table, queries: pa.Table) -> pa.Table:
    if not len(vectors) or not len(queries):
        return pa.table({c: pa.array([], pa.int64()) for c in ("q", "rep", "least", "score")})
    w, reps, ids = _width(vectors), vectors.column("rep").to_numpy(), queries.column("q").to_numpy()
    v, least, out = _matrix(vectors.column("v"), w), vectors.column("least").to_numpy(), []
    order = np.argsort(reps)
    for q, qv, wanted in zip(ids, _matrix(queries.column("v"), w), queries.column("open").to_pylist(), strict=True):
        at = order[np.searchsorted(reps, np.array(wanted, np.int64), sorter=order)]
        out.append((np.full(len(at), q), reps[at], least[at], _longs(_products(v[at], qv[None])[:, 0])))
    q, rep, least, score = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"q": q, "rep": rep, "least": least, "score": score})


class _Search:
    """The distinct vectors, dealt into slices, and the distinct queries, dealt into blocks."""

    def __init__(self, distinct: DataFrame, wanted: DataFrame, k: int, fragments: int):
        spark = distinct.sparkSession
        n, m = distinct.count(), wanted.count()
        self.slices = max(-(-n // SLICE_ROWS), shuffle_partitions(spark))
        self.blocks = max(1, -(-m // BLOCK_QUERIES))
        self.k, self.fragments = k, fragments
        deal = lambda col, parts: F.pmod(F.xxhash64(col), F.lit(parts)).cast("int")
        self.slice_of = lambda col: deal(col, self.slices)
        self.vectors = distinct.select("rep", "least", "v", F.size("v").alias("dims"), self.slice_of("rep").alias("slice"))
        self.queries = wanted.select(F.col("rep").alias("q"), F.col("v").alias("v"), F.size("v").alias("dims"), deal("rep", self.blocks).alias("block"))

    def _pieces(self, df: DataFrame) -> DataFrame:
        """One row per piece; piece ``f`` of a vector has its components from ceil(f d / n) to ceil((f+1) d / n)."""
        start = f"cast(ceil(piece * dims / {self.fragments}) as int)"
        return (df.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(self.fragments - 1))))
                .withColumn("v", F.expr(f"slice(v, {start} + 1, cast(ceil((piece + 1) * dims / {self.fragments}) as int) - {start})"))
                .filter(F.size("v") > 0))

    def meet(self, queries: DataFrame, function, schema: str, pieces: bool) -> DataFrame:
        """Run ``function`` on every (piece, slice, block); ``queries`` may be narrowed to the slices they need."""
        vectors = self.vectors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))))
        if "slice" not in queries.columns:
            queries = queries.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(self.slices - 1))))
        if pieces:
            vectors, queries = self._pieces(vectors), self._pieces(queries)
        key = ["dims", "slice", "block", *(["piece"] if pieces else [])]
        return vectors.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(function, schema)

    def exact(self, pairs: DataFrame) -> DataFrame:
        """``(q, rep, least, score)`` of distinct pairs; each query goes to the slices that hold its pairs."""
        opened = (pairs.withColumn("slice", self.slice_of("rep")).groupBy("q", "slice")
                  .agg(F.collect_set("rep").alias("open")))  # a slice's rows at most
        return self.meet(self.queries.join(opened, "q"), _resolve, "q bigint, rep bigint, least bigint, score bigint", False)

    def best(self) -> DataFrame:
        """``(q, rep, least, score)``: for every distinct query its k best distinct vectors, itself included; ties to the smaller least id."""
        seen = self.meet(self.queries, _lists(self.k), "q bigint, rep bigint", True).distinct()
        first = staged(self.exact(seen), "topk-first")
        by_score = Window.partitionBy("q").orderBy(F.desc("score"), "least", "rep")
        cutoffs = first.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") == self.k).select("q", F.col("score").alias("cutoff"))
        queries = self.queries.join(cutoffs, "q", "left")
        sent = self.meet(queries, _entries(self.fragments), "q bigint, rep bigint, least bigint, part bigint", True)
        sums = staged(sent.groupBy("q", "rep").agg(F.min("least").alias("least"), F.sum("part").alias("score"), F.count("part").alias("parts")), "topk-sent")
        lacking = sums.filter(F.col("parts") < self.fragments)
        known = first.unionByName(sums.filter(F.col("parts") == self.fragments).select("q", "rep", "least", "score"))
        open_pairs = lacking.select("q", "rep").join(first.select("q", "rep"), ["q", "rep"], "left_anti")
        scored = known.unionByName(self.exact(open_pairs)).distinct()
        return scored.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") <= self.k).drop("r")


def search(rows: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector: str = "embedding",
           fragments: int = FRAGMENTS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other rows of every row for which ``is_query(id)`` holds."""
    ints = integer_vectors(rows, id_col, vector)
    keyed = staged(ints.withColumn("digest", F.unhex(F.sha2(F.array_join(F.col("v").cast("array<string>"), ","), 256))), "topk-vectors")
    # of equal vectors, the k + 1 smallest ids; the limit acts on every task before the shuffle. `rep` names the vector,
    # as rows with different vectors may share an id; it is fixed by being written
    few = Window.partitionBy("digest").orderBy("id")
    distinct = staged(keyed.withColumn("r", F.row_number().over(few)).filter(F.col("r") <= k + 1).groupBy("digest").agg(
        F.min("id").alias("least"), F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("rep", F.monotonically_increasing_id()), "topk-distinct")
    queries = staged(keyed.filter(is_query(F.col("id"))).select("id", "digest").distinct()
                     .join(distinct.select("digest", "rep"), "digest").select(F.col("id").alias("query_id"), "rep"), "topk-queries")
    wanted = distinct.join(queries.select("rep").distinct(), "rep", "left_semi")
    best = _Search(distinct, wanted, k + 1, fragments).best().select("q", "rep", "score")
    rows_of = best.join(distinct.select("rep", "ids"), "rep").select("q", (F.col("rep") == F.col("q")).alias("own"), "score", "ids")
    mine = queries.withColumnRenamed("rep", "q").join(rows_of, "q")
    # of the query's own vector, one row of its id is left out
    others = mine.select("query_id", "q", "score", F.expr("filter(ids, (x, i) -> NOT own OR i != array_position(ids, query_id) - 1)").alias("ids"))
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (others.select("query_id", "q", "score", F.explode("ids").alias("vec_id"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
