"""Hand-worked goldens of the congestion indicators (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from roadlens.functions.congestion import indicator_columns

# avg, n, level, label, waiting, queue, inefficient
GOLDENS = [
    (-1.0, 5, 100.0, "Tắc nghẽn", 120.0, 5.5, True),
    (0.0, 5, 100.0, "Tắc nghẽn", 120.0, 5.0, True),
    (0.99, 5, 98.0, "Tắc nghẽn", 120.0, 4.505, True),
    (1.0, 5, 98.0, "Tắc nghẽn", 60.0, 4.5, True),
    (4.99, 2, 90.0, "Tắc nghẽn", 60.0, 1.002, False),
    (4.99, 3, 90.0, "Tắc nghẽn", 60.0, 1.503, True),
    (5.0, 5, 90.0, "Tắc nghẽn", 60.0, 2.5, False),
    (9.99, 5, 80.0, "Tắc nghẽn", 60.0, 0.005, False),
    (10.0, 5, 80.0, "Chậm", 20.0, 0.0, False),
    (24.99, 5, 50.0, "Chậm", 20.0, 0.0, False),
    (25.0, 5, 50.0, "Thông thoáng", 5.0, 0.0, False),
    (49.99, 5, 0.0, "Thông thoáng", 5.0, 0.0, False),
    (60.0, 5, 0.0, "Thông thoáng", 5.0, 0.0, False),
]


def test_goldens(spark):
    df = spark.createDataFrame([(a, n) for a, n, *_ in GOLDENS], "avg_speed double, veh_count long")
    ind = indicator_columns()
    rows = df.select("avg_speed", "veh_count", *[c.alias(k) for k, c in ind.items()]).collect()
    got = {(r.avg_speed, r.veh_count): r for r in rows}
    for a, n, level, label, wait, queue, ineff in GOLDENS:
        r = got[(a, n)]
        assert r.congestion_level == pytest.approx(level), (a, n)
        assert r.congestion_label == label, (a, n)
        assert r.avg_waiting_time == wait, (a, n)
        assert r.queue_length == pytest.approx(queue), (a, n)
        assert r.is_inefficient is ineff, (a, n)


def test_level_bounds_and_monotone(spark):
    df = spark.range(0, 700).select((F.col("id") / 10 - 5).alias("avg_speed"), F.lit(4).alias("veh_count"))
    lv = [r[0] for r in df.orderBy("avg_speed").select(indicator_columns()["congestion_level"]).collect()]
    assert all(0 <= x <= 100 for x in lv)
    assert all(a >= b for a, b in zip(lv, lv[1:])), "lower speed never lowers the level"
