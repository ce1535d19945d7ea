"""Day-partitioned warehouse store of enriched pings (``vehicle_gps``) and its loads.

The table is a Parquet folder partitioned by ``ymd`` (``yyyymmdd`` as INT)
derived from ``recorded_at``, rows in order of time inside each file. A filter on
``recorded_at`` alone does not prune a derived partition column, so
:func:`read_since` adds the matching ``ymd`` predicate: the folder's partitions
are listed, files of other days are not opened (``PartitionFilters`` in the
plan), and row groups of other hours are skipped by their time range.

:func:`load` is insert-or-ignore against the stored keys. Parquet has no
transactions, so a table has one writer at a time; a load that is repeated adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.operators.enrich import WAREHOUSE_COLS, first_pings
from roadlens.session import exists, file_system, partition_values, scratch_path

POINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType()),
                      T.StructField("srid", T.IntegerType(), False)])
SCHEMA = T.StructType([
    T.StructField("gps_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("geom", POINT),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("heading", T.DoubleType()),
    T.StructField("traffic_light_id", T.StringType()),
    T.StructField("day_type", T.StringType()),
    T.StructField("time_window", T.StringType()),
    T.StructField("time_id", T.IntegerType()),
    T.StructField("ymd", T.IntegerType()),
])


KEY = ["gps_id", "recorded_at"]


def ymd_sql(ts: str) -> str:
    """Day partition value ``yyyymmdd`` of an instant."""
    return f"(year({ts}) * 10000 + month({ts}) * 100 + day({ts}))"


# Point reads of one vehicle or light skip row groups by their Bloom filters.
BLOOM = {"parquet.bloom.filter.enabled#gps_id": "true", "parquet.bloom.filter.enabled#traffic_light_id": "true"}


def write(pings: DataFrame, root: str, max_records_per_file: int = 5_000_000, mode: str = "append", only_own_days: bool = False) -> None:
    """Write warehouse rows under ``ymd=yyyymmdd`` folders.

    Rows are rebalanced by day (AQE makes tasks, and so files, of the advisory
    size: a busy day is split over tasks, quiet days share one) and sorted by
    time, so a read of a few minutes touches few row groups. With ``only_own_days``
    an overwrite replaces the days that ``pings`` has and no others.
    """
    (pings.selectExpr(*WAREHOUSE_COLS, f"{ymd_sql('recorded_at')} AS ymd")
          .hint("rebalance", "ymd")
          .sortWithinPartitions("ymd", "recorded_at", "gps_id")
          .write.mode(mode).option("partitionOverwriteMode", "dynamic" if only_own_days else "static")
          .options(**BLOOM).option("maxRecordsPerFile", max_records_per_file)
          .partitionBy("ymd").parquet(root))


def read(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(root)


def read_since(spark: SparkSession, root: str, since: str) -> DataFrame:
    """Rows with ``recorded_at > since`` (SQL timestamp expression text), days pruned.

    ``since`` is evaluated once (a constant such as
    ``TIMESTAMP '2026-01-09 08:30:00' - INTERVAL 5 MINUTES``), so the ``ymd``
    bound is a literal partition predicate.
    """
    return read(spark, root).filter(f"ymd >= {ymd_sql(f'({since})')} AND recorded_at > ({since})")


def load(offered: DataFrame, root: str, order: Sequence[str]) -> None:
    """Append the offered pings whose key is not stored yet: the first copy of each key by ``order``.

    The days that the batch touches come first, as a folder with one small file for each. Of
    the store exactly these are read, so one stray clock does not open the history between.
    The stored keys then enter the batch's keep-first as its first copies: what is
    stored or repeated goes in the one shuffle that the batch takes anyway.
    """
    spark = offered.sparkSession
    offered = offered.filter("recorded_at IS NOT NULL")
    if not exists(spark, root):
        write(first_pings(offered, order), root)
        return
    path = scratch_path(spark, "load-days")
    offered.groupBy(F.expr(f"{ymd_sql('recorded_at')} AS ymd")).agg(F.expr("count(1) AS n")).coalesce(1).write.partitionBy("ymd").parquet(path)
    touched = set(partition_values(spark, path, "ymd"))
    if not touched:
        return
    held = sorted(touched.intersection(partition_values(spark, root, "ymd")))
    # a key with a null matches no stored one
    stored = read(spark, root).filter(F.col("ymd").isin([int(d) for d in held])).filter("gps_id IS NOT NULL").select(*KEY)
    both = offered.withColumn("__new", F.lit(True)).unionByName(stored.withColumn("__new", F.lit(False)), allowMissingColumns=True)
    write(first_pings(both, ["__new", *order], "__new"), root)


def load_batches(root: str, order: Sequence[str]):
    """``foreachBatch`` body of a streaming load.

    There is no watermark: a ping that comes late is stored like any other, and a replayed batch adds nothing.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        load(batch, root, order)
    return run


def vehicle_pings(spark: SparkSession, root: str, gps_id: str) -> DataFrame:
    """The stored pings of one vehicle; row groups without it are skipped by their Bloom filters."""
    return read(spark, root).filter(F.col("gps_id") == gps_id)


def light_pings(spark: SparkSession, root: str, light: str, since: str, until: str) -> DataFrame:
    """The stored pings at one light with ``since <= recorded_at < until`` (text, UTC): days by their folders, hours by the files' order of time."""
    a, b = f"TIMESTAMP '{since}'", f"TIMESTAMP '{until}'"
    return read(spark, root).filter(f"ymd BETWEEN {ymd_sql(a)} AND {ymd_sql(b)} AND recorded_at >= {a} AND recorded_at < {b}").filter(
        F.col("traffic_light_id") == light)


def retain(spark: SparkSession, root: str, as_of: str, days: int = 7, env: str = "mock") -> None:
    """Remove pings older than ``days`` days before ``as_of`` from the store of the mock environment; production keeps all.

    Whole expired days go with their folders; only the day that the boundary cuts is
    written anew, and the files of later days stay as they are. A run that is ended in between can be repeated.
    """
    if env != "mock":
        return
    since = f"TIMESTAMP '{as_of}' - INTERVAL {int(days)} DAYS"
    edge = spark.sql(f"SELECT {ymd_sql(f'({since})')} AS ymd").first()["ymd"]
    stored = [int(d) for d in partition_values(spark, root, "ymd")]
    if edge in stored:
        path = scratch_path(spark, "retain-edge")
        read(spark, root).filter(f"ymd = {edge} AND recorded_at >= {since}").write.parquet(path)
        kept = spark.read.schema(SCHEMA).parquet(path)
        if kept.isEmpty():
            edge += 1  # nothing of that day is left: its folder goes, too
        else:
            write(kept, root, mode="overwrite", only_own_days=True)
    for day in sorted(set(stored)):
        if day < edge:
            fs, p = file_system(spark, f"{root}/ymd={day}")
            fs.delete(p, True)
