"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words; a row's expected number of copies is its
source's target over the source's size. The whole part is taken as it is, the
fraction is rounded by the pivotal method: two fractional rows of a source
exchange mass at random, in expectation zero for each, until one of them is 0
or 1; the other one meets the next row, from long rows to short ones. Mass is counted
in words (fraction times size), so a source's words stay at its target but for the one row that
is left at the end. A row over ``LONG`` times as long as the next one would meet many before it is settled
and could be that row; it exchanges mass with all that follow at once, as they
still have one common fraction: what it gains or loses lowers or raises that.

Rows are dealt into cells of a source (about ``CELL_ROWS`` rows each, by hash of the row
and its place among its equals, so a hot source has many cells, one of repeated rows, too). Each cell is paired off in one task and hands on
one residual row; residuals of ``FAN_IN`` cells meet in the next round, until
each source has one left, which is rounded by its own draw.

Draws are hashes of the seed, the row and the round, cells depend on the rows
alone, and each cell is put in order first: reruns agree, whatever the
partitioning. The row that is left at the end is a long one only where those
after it have too few words to settle it, so only a source with few rows can stop far from its target.

Targets: sources in the order of their code points, null last, get the weights
``WEIGHTS`` in turn and share ``SHARE`` times all words; no target exceeds
``MOST`` times its source's size, and the excess is shared out again by weight.

Defined results: a null text has no words; rows without words take no words and are copied or
dropped by their own draw; equal rows are interchangeable; an empty table, or
one without words, has targets of 0; further columns pass through.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, fresh, staged, text_or_empty

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = 90_187
CELL_ROWS = 4096
FAN_IN = 16
LONG = 2


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, n, target)`` from ``(source, source_size, n)``."""
    spark = sources.sparkSession
    ranked = sources.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(
        lambda x: (x[0]["source"], x[0]["source_size"], x[0]["n"], float(weights[x[1] % len(weights)])))
    ranked = staged(spark.createDataFrame(ranked, T.StructType([
        T.StructField("source", sources.schema["source"].dataType), T.StructField("source_size", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("weight", T.DoubleType())])), "mix-sources")
    # The level is what one unit of weight gets. Each round caps the sources that the level puts above their limit
    # and shares what they leave among the others, which raises the level; it ends when no further source is capped.
    limit = F.col("source_size") * most
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > limit
        r = ranked.agg(F.sum("source_size").alias("all"), F.count_if(over).alias("capped"),
                       F.sum(F.when(over, limit)).alias("spent"), F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if r["capped"] == capped or not r["all"] or not r["open"]:
            break
        capped, level = r["capped"], (share * r["all"] - (r["spent"] or 0.0)) / r["open"]
    if r["all"] and not r["open"]:  # all are at their limit
        return ranked.withColumn("target", limit)
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), limit))


def pair_off(sizes: list[int], parts: list[float], draws: list[float]) -> tuple[list[float], int]:
    """Round the fractions of one cell; returns the rounded parts and the place of the residual row (-1: none)."""
    out, open_at, p = list(parts), -1, 0.0
    fractional = [j for j, q in enumerate(parts) if 0.0 < q < 1.0]
    common = parts[fractional[0]] if len({parts[j] for j in fractional}) == 1 else None
    rest = sum(sizes[j] for j in fractional)  # words of the rows that were not met yet
    for j, after in zip(fractional, [*fractional[1:], -1], strict=True):
        q = parts[j] if common is None else common
        rest -= sizes[j]
        if open_at < 0:
            open_at, p = j, q
        else:
            s, t = sizes[open_at], sizes[j]
            up, down = min(s * (1 - p), t * q), min(s * p, t * (1 - q))
            if draws[j] * (up + down) < down:  # the open row gains `up`
                if s * (1 - p) <= t * q:
                    p, q = 1.0, q - up / t
                else:
                    p, q = p + up / s, 0.0
            elif s * p <= t * (1 - q):  # the open row loses `down`
                p, q = 0.0, q + down / t
            else:
                p, q = p - down / s, 1.0
            if 0.0 < p < 1.0:
                out[j] = float(q >= 0.5)
            else:
                out[open_at], open_at, p = p, j, q
                if not 0.0 < q < 1.0:
                    out[j], open_at = float(q >= 0.5), -1
        if common is not None and after >= 0 and open_at >= 0 and sizes[open_at] > LONG * sizes[after]:
            gain, loss = sizes[open_at] * (1 - p), sizes[open_at] * p
            if gain < rest * common and loss < rest * (1 - common):
                # the draw's last bits, which the pair of this row hardly depended on
                won = draws[open_at] * 2 ** 26 % 1.0 < p
                out[open_at], open_at = float(won), -1
                common += -gain / rest if won else loss / rest
    if open_at >= 0:
        out[open_at] = p
    return out, open_at


def _round(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["size", "draw", "tie", "place"], ascending=[False, True, True, True], kind="stable")
    rows["part"], left = pair_off(rows["size"].tolist(), rows["part"].tolist(), rows["draw"].tolist())
    rows["open"] = False
    if left >= 0:
        rows.iloc[left, rows.columns.get_loc("open")] = True
    return rows


def _uniform(*cols):
    """A draw in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11) + 0.5) / float(2 ** 53)


def placed(rows: DataFrame, tie) -> DataFrame:
    """``rows`` with ``tie`` and the row's ``place`` among those with the same, from 0.

    Places run through the parts of the input in turn, so no task holds all copies of a row.
    """
    rows = staged(rows.withColumn("tie", tie).withColumn("slice", F.spark_partition_id()), "mix-rows")
    counts = rows.groupBy("tie", "slice").agg(F.count(F.lit(1)).alias("n"))
    many = counts.groupBy("tie").agg(F.sum("n").alias("n")).filter("n > 1").select("tie")
    before = counts.join(many, "tie", "left_semi").withColumn(
        "before", F.sum("n").over(Window.partitionBy("tie").orderBy("slice")) - F.col("n")).drop("n")
    inside = Window.partitionBy("tie", "slice").orderBy("row")
    places = (rows.select("tie", "slice", "row").join(many, "tie", "left_semi").withColumn("k", F.row_number().over(inside))
              .join(before, ["tie", "slice"]).select("row", (F.col("before") + F.col("k") - 1).alias("place")))
    return staged(rows.drop("slice").join(places, "row", "left").withColumn("place", F.coalesce("place", F.lit(0).cast("bigint"))), "mix-placed")


def decide(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """``(row, id, source, size, source_size, target, copies)`` of rows ``(row, id, source, size)``."""
    rows = placed(rows, F.xxhash64(F.lit(seed), "id", "source", "size"))
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), weights, share, most)
    sources = sources.select(F.col("source").alias("s"), "source_size", "target", F.greatest(F.lit(1), F.ceil(F.col("n") / CELL_ROWS)).alias("cells"))
    most_cells = sources.agg(F.max("cells")).first()[0] or 1
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    state = (rows.join(sources, rows.source.eqNullSafe(sources.s), "left").drop("s")
             .withColumn("ratio", ratio).withColumn("whole", F.floor("ratio").cast("int"))
             .withColumn("part", F.col("ratio") - F.floor("ratio")).drop("ratio")
             .withColumn("draw", _uniform(F.lit(seed + 1), "tie", "place"))
             .withColumn("part", F.when(F.col("size") == 0, (F.col("draw") < F.col("part")).cast("double")).otherwise(F.col("part")))
             .withColumn("cell", F.pmod(F.xxhash64("tie", "place"), F.col("cells")).cast("bigint")).drop("cells")
             .withColumn("open", (F.col("part") > 0) & (F.col("part") < 1)))
    done, level = [], 0
    cells = most_cells
    while True:
        # rows that are whole already pass by; only fractional ones are shuffled
        idle = state.filter(~F.col("open"))
        paired = state.filter("open").groupBy("source", "cell").applyInPandas(_round, state.schema)
        state = staged(idle.unionByName(paired), f"mix-round{level}")
        done.append(state.filter(~F.col("open")))
        if cells == 1:
            break
        level, cells = level + 1, -(-cells // FAN_IN)
        state = (state.filter("open").withColumn("cell", F.floor(F.col("cell") / FAN_IN).cast("bigint"))
                 .withColumn("draw", _uniform(F.lit(seed + 1 + level), "tie", "place")))
    last = state.filter("open").withColumn("part", (_uniform(F.lit(seed), "tie", "place") < F.col("part")).cast("double"))
    out = last
    for d in done:
        out = out.unionByName(d)
    return out.select("row", "id", "source", "size", "source_size", "target", (F.col("whole") + F.col("part").cast("int")).alias("copies"))


def word_count(text: str = "text"):
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def mix(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mixed rows: each row of ``docs`` as many times as the mix takes it."""
    row, copies = fresh(docs, "row", "copies")
    kept = staged(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    rows = kept.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"))
    taken = decide(rows, **options).filter("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies))
    return (kept.join(taken, row).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns))
