"""Exact de-duplication by a tree merge of sorted digest runs (DataFrame operations only).

Every input partition makes one sorted run of digests: a sort aggregate that
keeps, for each text, the best row and the number of copies. Runs then meet in
rounds of ``FAN_IN``: runs ``r`` with the same ``r div FAN_IN`` are merged by a
further sort aggregate, until one run is left. A run has no single owner: its
digests are dealt by hash, so every round is spread over all tasks, and a text
with any number of copies arrives at a round as one row per run.

The digest is SHA-256 of the normalised text. It is verified at every level:
the key also holds the byte length and an independent 64-bit hash, so rows
whose digests agree without their texts agreeing would not merge.

Defined results: a null text equals an empty one; of equal texts the row with
most code points in the original stays, then the smallest ``doc_id`` (null
last), then one of the repeated rows, the same in every run over the same files,
so exactly one row per text stays; an empty table gives an empty result; further columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, fresh, named, text_or_empty

FAN_IN = 8


def _with_digest(docs: DataFrame, text: str, names: dict) -> DataFrame:
    norm = F.translate(text_or_empty(text), SPACES, "")
    return (docs
            .withColumn(names["norm"], norm)
            .withColumn(names["digest"], F.unhex(F.sha2(F.col(names["norm"]), 256)))
            .withColumn(names["check"], F.xxhash64(names["norm"]))
            .withColumn(names["bytes"], F.octet_length(names["norm"]))
            .withColumn(names["points"], F.char_length(text_or_empty(text)))
            .withColumn(names["run"], F.spark_partition_id())
            .drop(names["norm"]))


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Merge runs of ``(run, digest, check, bytes, best, copies)`` rows into one, in rounds."""
    key = ["digest", "check", "bytes"]
    last = rows.agg(F.max("run")).first()[0] or 0
    merged = rows.groupBy("run", *key).agg(F.min("best").alias("best"), F.sum("copies").alias("copies"))
    while last > 0:
        merged = (merged.groupBy((F.col("run") / fan_in).cast("int").alias("run"), *key)
                  .agg(F.min("best").alias("best"), F.sum("copies").alias("copies")))
        last //= fan_in
    return merged.drop("run")


def mark_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", fan_in: int = FAN_IN) -> tuple[DataFrame, dict]:
    """Every row of ``docs`` with what is known of its group of equal texts.

    Returns the frame and the names of the added columns: ``digest`` (binary),
    ``keep`` (id of the row that stays), ``copies``, ``kept``.
    """
    wanted = ["norm", "digest", "check", "bytes", "points", "run", "row"]
    names = dict(zip(wanted, fresh(docs, *wanted), strict=True))
    # digests are made again for the join with the groups, so no text is written in between
    rows = _with_digest(named(docs, names["row"], "dedup-docs"), text, names)
    runs = rows.select(
        F.col(names["run"]).alias("run"), F.col(names["digest"]).alias("digest"), F.col(names["check"]).alias("check"),
        F.col(names["bytes"]).alias("bytes"), F.lit(1).cast("bigint").alias("copies"),
        F.struct((-F.col(names["points"])).alias("points"), F.col(id_col).isNull().alias("no_id"),
                 F.col(id_col).alias("id"), F.col(names["row"]).alias("row")).alias("best"))
    groups = merge_runs(runs, fan_in).filter("copies > 1")
    out = dict(zip(("keep", "copies", "kept", "best"), fresh(rows, "keep_id", "copies", "kept", "best"), strict=True))
    groups = groups.select(F.col("digest").alias("g_digest"), F.col("check").alias("g_check"),
                           F.col("bytes").alias("g_bytes"), F.col("best").alias(out["best"]), F.col("copies").alias(out["copies"]))
    # A left join, so that a hot text's rows (left side) can be split by AQE.
    joined = rows.join(groups, (rows[names["digest"]] == groups.g_digest) & (rows[names["check"]] == groups.g_check)
                       & (rows[names["bytes"]] == groups.g_bytes), "left")
    single = F.col(out["best"]).isNull()
    marked = (joined
              .withColumn(out["keep"], F.when(single, F.col(id_col)).otherwise(F.col(f"{out['best']}.id")))
              .withColumn(out["kept"], single | (F.col(f"{out['best']}.row") == F.col(names["row"])))
              .withColumn(out["copies"], F.coalesce(out["copies"], F.lit(1).cast("bigint")))
              .drop("g_digest", "g_check", "g_bytes", out["best"]))
    return marked, {**out, "digest": names["digest"]}


def dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", fan_in: int = FAN_IN) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    marked, names = mark_copies(docs, text, id_col, fan_in)
    return marked.filter(F.col(names["kept"])).select(*docs.columns)
