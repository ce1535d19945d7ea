"""Time dimension and schedule lookup (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from roadlens.operators.schedule import lookup_red
from roadlens.sources import dimensions, seeds


def test_time_dimension_spots(spark):
    td = dimensions.time_dimension(spark)
    assert td.count() == seeds.TIME_DIM_HOURS
    by_ts = {r.k: r for r in td.select(F.date_format("full_timestamp", "yyyy-MM-dd HH:mm").alias("k"), "*")
             .filter(F.col("k").isin("2025-01-01 00:00", "2027-01-01 00:00", "2026-01-04 00:00",
                                     "2027-12-31 23:00")).collect()}
    a = by_ts["2025-01-01 00:00"]
    assert (a.time_id, a.day_of_week, a.week_of_year, a.season, a.time_window, a.day_type) == \
        (1, 3, 1, "winter", "off_peak", "weekday")
    assert by_ts["2027-01-01 00:00"].week_of_year == 53
    s = by_ts["2026-01-04 00:00"]
    assert (s.day_of_week, s.day_type) == (0, "weekend")
    assert by_ts["2027-12-31 23:00"].time_id == seeds.TIME_DIM_HOURS


def test_time_dimension_equals_duckdb(spark):
    import duckdb
    cols = ["time_id", "year", "month", "day", "hour", "day_of_week", "week_of_year", "quarter",
            "is_weekend", "day_type", "time_window", "season"]
    sp = sorted(tuple(r) for r in dimensions.time_dimension(spark).select(*cols).collect())
    dk = sorted(duckdb.sql(f"SELECT {', '.join(cols)} FROM ({dimensions.sql_time_dimension()})").fetchall())
    assert sp == dk


def test_computed_time_id_matches_lookup(spark):
    td = dimensions.time_dimension(spark)
    bad = td.filter(dimensions.time_id_of("full_timestamp") != F.col("time_id")).count()
    assert bad == 0


CASES = [  # (time of day, day type, light, strict reds, wrap reds)
    ("06:00:00", "weekday", "TL001", [60], [60]),
    ("08:59:59", "weekday", "TL001", [60], [60]),
    ("09:00:00", "weekday", "TL001", [45, 60], [45]),
    ("20:00:00", "weekday", "TL001", [65], [40]),
    ("23:00:00", "weekday", "TL001", [None], [40]),
    ("05:59:59", "weekday", "TL001", [None], [40]),
    ("12:00:00", "weekend", "TL001", [None], [None]),
    ("12:00:00", "weekend", "TL005", [50], [50]),
]


def test_fractions_of_a_second_count(spark):
    """Half a second after nine only the second row is active."""
    from roadlens.functions.timeparts import seconds_of_day_sql
    at = spark.sql(f"SELECT *, {seconds_of_day_sql('at')} AS tod FROM VALUES (TIMESTAMP '2026-01-09 09:00:00.5', 'weekday', 'TL001'), "
                   "(TIMESTAMP '2026-01-09 20:00:00.000001', 'weekday', 'TL001') AS t(at, day_type, traffic_light_id)")
    out = lookup_red(at, dimensions.light_schedule(spark), "tod", "day_type", "strict").collect()
    assert sorted((r.at.hour, r.scheduled_red_duration) for r in out) == [(9, 45), (20, None)]


@pytest.mark.parametrize("mode", ["strict", "wrap"])
def test_binned_schedule_equals_broadcast(spark, mode):
    """A schedule beyond the broadcast bound: same rows, and a light with most pings is in no single task."""
    from collections import Counter
    df = spark.range(20_000).selectExpr(
        "id", "CAST(CASE WHEN id % 10 = 0 THEN id * 900 % 86400 ELSE id * 7919 % 86400 + 0.5 END AS DOUBLE) AS tod",
        "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 'weekend' ELSE 'weekday' END AS day_type",
        "CASE WHEN id % 5 > 0 THEN 'TL005' WHEN id % 25 = 0 THEN NULL ELSE 'TL00' || (1 + id % 4) END AS traffic_light_id")
    sched = dimensions.light_schedule(spark)
    small = lookup_red(df, sched, "tod", mode=mode)
    large = lookup_red(df, sched, "tod", mode=mode, max_bytes=0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert Counter(map(tuple, large.collect())) == Counter(map(tuple, small.collect()))
        tasks = large.filter("traffic_light_id = 'TL005' AND tod BETWEEN 43200 AND 44099").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 3 and max(r["count"] for r in tasks) < 0.6 * sum(r["count"] for r in tasks)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_schedule_lookup(spark):
    rows = [(i, int(t[:2]) * 3600 + int(t[3:5]) * 60 + int(t[6:]), d, l)
            for i, (t, d, l, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, tod int, day_type string, traffic_light_id string")
    sched = dimensions.light_schedule(spark)
    for mode, idx in (("strict", 3), ("wrap", 4)):
        out = lookup_red(df, sched, "tod", "day_type", mode).collect()
        got = {}
        for r in out:
            got.setdefault(r.i, []).append(r.scheduled_red_duration)
        for i, case in enumerate(CASES):
            assert sorted(got[i], key=lambda x: (x is None, x)) == case[idx], (mode, case)


def test_seeding_twice_equals_once(spark):
    """Seed inserts are insert-or-ignore on each table's key (intersections: the name)."""
    from roadlens.operators.load import insert_or_ignore
    cases = [(dimensions.intersections, ["intersection_name"]),
             (dimensions.traffic_lights, ["traffic_light_id"]),
             (dimensions.light_schedule, ["traffic_light_id", "start_sec", "applicable_days"])]
    for build, key in cases:
        seed = build(spark)
        first = insert_or_ignore(seed.limit(0), seed, key, seed.columns[:1])
        stored = first.unionByName(insert_or_ignore(first, seed, key, seed.columns[:1]))
        assert stored.count() == seed.count() == first.count()
