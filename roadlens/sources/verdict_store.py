"""Store of congestion verdicts (``congestion_analysis``), partitioned by analysis day.

One verdict per light and analysis time: :func:`load` is insert-or-ignore, so
the first verdict of a key stays whatever a later run finds. Reads of recent or
selected verdicts go to the store and prune its days; they do not recompute
history from raw pings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators.congestion import VERDICT_COLS
from roadlens.operators.load import insert_or_ignore
from roadlens.session import partition_values, scratch_path

KEY = ["traffic_light_id", "analysis_time"]
ORDER = ["-vehicle_count", "time_window", "day_type", "scheduled_red_duration"]
SCHEMA = ("traffic_light_id string, analysis_time string, time_id int, time_window string, day_type string, "
          "avg_speed_kmh double, vehicle_count int, congestion_level double, congestion_label string, "
          "avg_waiting_time double, queue_length double, scheduled_red_duration int, is_inefficient boolean, day string")


def load(offered: DataFrame, root: str) -> None:
    """Append the verdicts whose (light, analysis time) is not stored yet.

    The batch is staged once; of the store exactly the days that it touches are read.
    """
    spark = offered.sparkSession
    path = scratch_path(spark, "verdict-batch")
    offered.selectExpr(*VERDICT_COLS, "substring(analysis_time, 1, 10) AS day").write.partitionBy("day").parquet(path)
    touched = partition_values(spark, path, "day")
    if not touched:
        return
    staged = read(spark, path)
    held = sorted(set(touched).intersection(partition_values(spark, root, "day")))
    if held:
        staged = insert_or_ignore(read(spark, root).filter(F.col("day").isin(held)), staged, KEY, ORDER)
    (staged.hint("rebalance", "day").sortWithinPartitions("day", "analysis_time", "traffic_light_id")
     .write.mode("append").partitionBy("day").parquet(root))


def read(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(root)


def days(spark: SparkSession, root: str) -> list[str]:
    """The stored days, newest first, from the folder listing (no job)."""
    return partition_values(spark, root, "day")[::-1]


def latest(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    """The ``n`` newest verdicts. Days are added from the newest back, twice as many a time, until they hold ``n`` rows; as a rule the newest one does."""
    found, step = days(spark, root), 1
    while True:
        chosen = read(spark, root).filter(F.col("day").isin(found[:step]))
        if step >= len(found) or chosen.limit(n).count() >= n:
            return (chosen.orderBy("analysis_time", "traffic_light_id", ascending=[False, True]).limit(n).select(*VERDICT_COLS))
        step *= 2


def latest_per_light(spark: SparkSession, root: str, lights: DataFrame) -> DataFrame:
    """The newest verdict of each light; older days are only read for lights that the newer ones do not have."""
    found, step, start = days(spark, root), 1, 0
    wanted, out = lights.select("traffic_light_id"), None
    rest = [c for c in VERDICT_COLS if c != "traffic_light_id"]
    while True:
        rows = read(spark, root).filter(F.col("day").isin(found[start:start + step])).join(wanted, "traffic_light_id", "left_semi")
        part = (rows.groupBy("traffic_light_id").agg(F.max_by(F.struct(*rest), F.col("analysis_time")).alias("__v"))
                .select("traffic_light_id", *[F.col(f"__v.{c}").alias(c) for c in rest]).select(*VERDICT_COLS))
        out = part if out is None else out.unionByName(part)
        start, step = start + step, step * 2
        if start >= len(found):
            return out
        path = scratch_path(spark, "latest-found")
        out.write.parquet(path)
        out = spark.read.schema(out.schema).parquet(path)
        wanted = lights.select("traffic_light_id").join(out, "traffic_light_id", "left_anti")
        if wanted.isEmpty():
            return out
