"""Tables written to the shared folder."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from roadlens.llm.common import DROP_SHUFFLES, named, staged


def _shuffles(spark):
    """Shuffles of which the driver still knows map outputs."""
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_a_written_table_leaves_no_shuffle_files(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    setting = spark.conf.get(DROP_SHUFFLES, None)
    before = _shuffles(spark)
    first, second = staged(rows, "sevens"), staged(rows, "sevens")
    for _ in range(50):  # they are removed in the background
        if _shuffles(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffles(spark) <= before
    assert spark.conf.get(DROP_SHUFFLES, None) == setting
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect())) == [(k, 143 - (k == 6)) for k in range(7)]


def test_rows_of_files_are_named_without_a_write(spark, tmp_path):
    folder = str(tmp_path / "shared")
    spark.range(500).selectExpr("id", "'m' AS _metadata").repartition(4).write.parquet(folder)
    files = spark.read.parquet(folder)
    before = sorted(p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir())
    frame = named(files.withColumn("more", F.col("id") + 1), "row", "named-rows")
    names = {r["id"]: r["row"] for r in frame.collect()}
    assert len(set(names.values())) == 500
    again = named(files.select("id"), "row", "named-rows")
    assert names == {r["id"]: r["row"] for r in again.repartition(3).collect()}
    assert before == sorted(p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir())


def test_other_frames_are_written_to_be_named(spark, tmp_path):
    folder = str(tmp_path / "files")
    spark.range(50).write.parquet(folder)
    files = spark.read.parquet(folder)
    for frame in (spark.range(50), files.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))),
                  files.withColumn("r", F.rand()), files.unionByName(files), files.repartition(3)):
        rows = [r["row"] for r in named(frame, "row", "named-rows").collect()]
        assert len(set(rows)) == len(rows) == frame.count()
