"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.session import scratch_path

# The white space of every rule here: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Spark's setting to remove a query's shuffle files at its end, not when the driver's garbage collector meets them.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The lineage ends there: what follows a lost executor is recomputed from
    the written files, and values that depend on the partitioning of a scan
    (row ids) are fixed once and for all. The write's shuffle files, which
    nothing reads any more, are removed when it is committed; the setting is
    put back, as other queries of the session may be run twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def _plain_parquet(df: DataFrame) -> bool:
    """Whether ``df`` is a Parquet scan, at most with columns chosen or computed from one row: then a row's file and place name it."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.deterministic() and plan.nodeName() in ("Project", "SubqueryAlias"):
        plan = plan.child()
    if plan.nodeName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return False
    return plan.relation().fileFormat().toString() == "Parquet"


def named(df: DataFrame, name: str, stage: str) -> DataFrame:
    """``df`` with a 64-bit ``name`` of each row that is the same wherever ``df`` is read again.

    Rows of Parquet files are named by a hash of their file and place, so nothing is
    written; any other frame is written once, with its row ids.
    """
    if _plain_parquet(df):
        at = df.metadataColumn("_metadata")
        return df.withColumn(name, F.xxhash64(at.getField("file_path"), at.getField("row_index")))
    return staged(df.withColumn(name, F.monotonically_increasing_id()), stage)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, sized from the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names for helper columns that clash with none of ``df`` (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def pack_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: replace the last column, a text without nulls, by its bytes, compressed."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        packed = pa.array([pack(t.encode("utf-8", "replace")) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=[*batch.schema.names[:-1], "packed"])


def most_frequent(counts: DataFrame, value: str, count: str, limit: int) -> DataFrame:
    """The rows with the highest counts, at most ``limit`` of them, ties in or out together.

    A histogram of the counts' logarithms (at most some 1,000 steps) gives the
    lowest step that fits; no task sends more than its own share of the rows.
    """
    step = F.floor(F.log2(count) * 16).cast("int")
    below, total = None, 0
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        total += r["n"]
        if total > limit:
            break
        below = r["step"]
    return counts.filter(step >= below if below is not None else F.lit(False)).select(value, count)
