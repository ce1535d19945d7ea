"""Warehouse table of pings in buckets of its key, for loads that never shuffle what is stored.

The table is partitioned by day and bucketed and sorted by (gps_id, recorded_at), the
key of insert-or-ignore. A load's anti-join then reads the stored side bucket by bucket as it lies:
only the offered rows are shuffled. Both key columns are in the bucket hash, so a vehicle with a large
share of all pings is spread over all buckets. Each load adds one file per bucket and day that it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators.enrich import WAREHOUSE_COLS, first_pings
from roadlens.sources.warehouse import BLOOM, KEY, ymd_sql


def _append(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    # the shuffle's hash is the bucket's, so each task writes one bucket
    (rows.selectExpr(*WAREHOUSE_COLS, f"{ymd_sql('recorded_at')} AS ymd").repartition(buckets, *KEY)
     .write.mode("append").format("parquet").options(**BLOOM).option("path", path).partitionBy("ymd")
     .bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(table))


def fresh(first: DataFrame, table: str, days: Sequence[int]) -> DataFrame:
    """The offered rows whose key the table does not hold on ``days``; the table's side is not shuffled."""
    stored = first.sparkSession.table(table).filter(F.col("ymd").isin(list(days))).select(*KEY)
    return first.join(stored.hint("merge"), KEY, "left_anti")


def load(offered: DataFrame, table: str, path: str, order: Sequence[str], buckets: int) -> None:
    """Append the offered pings whose key is not stored: the first copy of each key by ``order``. One writer at a time.

    The offered rows are shuffled once, into the table's buckets: keep-first, anti-join and write all work on them as they lie then.
    """
    spark = offered.sparkSession
    offered = offered.filter("recorded_at IS NOT NULL")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(buckets))
    try:
        first = first_pings(offered, order)
        if spark.catalog.tableExists(table):
            days = [r["ymd"] for r in offered.selectExpr(f"{ymd_sql('recorded_at')} AS ymd").distinct().collect()]  # calendar days
            first = fresh(first, table, days)
        _append(first, table, path, buckets)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
