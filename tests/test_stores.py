"""Stores: what is opened, what is rewritten, what is shuffled."""

import os

import pytest
from pyspark.sql import functions as F

from roadlens.operators import congestion
from roadlens.operators.enrich import WAREHOUSE_COLS
from roadlens.session import scratch_path
from roadlens.sources import dimensions, lake, ping_table, verdict_store, warehouse

ORDER = ["src_row"]


def pings(spark, rows):
    """``rows``: (gps_id, recorded_at, speed)."""
    df = spark.createDataFrame([(g, t, float(s), k) for k, (g, t, s) in enumerate(rows)], "gps_id string, t string, speed_kmh double, src_row int")
    have = {"gps_id": "gps_id", "vehicle_id": "gps_id", "recorded_at": "CAST(t AS TIMESTAMP)", "latitude": "21.0D", "longitude": "105.0D",
            "geom": "named_struct('lon', 105.0D, 'lat', 21.0D, 'srid', 4326)", "speed_kmh": "speed_kmh", "heading": "CAST(NULL AS DOUBLE)",
            "traffic_light_id": "'TL001'", "day_type": "'weekday'", "time_window": "'off_peak'", "time_id": "1"}
    return df.selectExpr(*[f"{have[c]} AS {c}" for c in WAREHOUSE_COLS], "src_row")


def stored(spark, root):
    return sorted((r.gps_id, str(r.recorded_at), r.speed_kmh) for r in warehouse.read(spark, root).collect())


def paths(spark, root):
    return {f for d, _, names in os.walk(root) for f in (os.path.join(d, n) for n in names) if f.endswith(".parquet")}


def test_discovery_opens_new_files_only(spark):
    root, seen = scratch_path(spark, "lake"), scratch_path(spark, "seen")
    rows = lambda k: lake.with_partitions(pings(spark, [(f"G{k}", f"2026-01-0{k} 10:00:00", k)]).withColumn("timestamp", F.col("recorded_at").cast("string")),
                                          "prod" if k < 9 else "mock", F.col("recorded_at"))
    lake.write(rows(1), root)
    first = lake.record(lake.discover(spark, root, seen, "prod"), seen, "1")
    assert first.count() == 1 and {r.gps_id for r in lake.read_files(spark, root, first).collect()} == {"G1"}
    lake.write(rows(2), root)
    lake.write(rows(9), root)
    late = scratch_path(spark, "late")
    lake.write(rows(3), late)
    second = lake.record(lake.discover(spark, root, seen, "prod"), seen, "2")
    out = lake.read_files(spark, root, second)
    assert {r.gps_id for r in out.collect()} == {"G2"}
    # the scan itself lists the new files and nothing else
    assert len(out.inputFiles()) == 1 and "day=02" in out.inputFiles()[0]
    # a file of an early day that is committed late, with an old time
    moved = next(iter(paths(spark, late)))
    target = f"{root}/env=prod/year=2026/month=01/day=01/late.parquet"
    with open(moved, "rb") as a, open(target, "wb") as b:
        b.write(a.read())
    os.utime(target, (0, 0))
    third = lake.record(lake.discover(spark, root, seen, "prod"), seen, "3")
    assert {r.gps_id for r in lake.read_files(spark, root, third).collect()} == {"G3"}
    nothing = lake.discover(spark, root, seen, "prod")
    assert nothing.count() == 0 and lake.read_files(spark, root, nothing).count() == 0
    plan = lake.files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]


@pytest.fixture
def week(spark):
    root = scratch_path(spark, "store")
    warehouse.load(pings(spark, [(f"G{v}", f"2026-01-{d:02d} {h:02d}:30:00", d) for d in range(1, 15) for h in (5, 18) for v in (1, 2)]), root, ORDER)
    return root


def test_retention_drops_days_and_rewrites_one(spark, week):
    before = paths(spark, week)
    warehouse.retain(spark, week, "2026-01-17 06:00:00")
    after = paths(spark, week)
    kept = {p for p in before if any(f"ymd=202601{d}" in p for d in (11, 12, 13, 14))}
    assert kept <= after and all("ymd=20260110" in p for p in after - kept)
    assert min(t for _, t, _ in stored(spark, week)) == "2026-01-10 18:30:00"
    warehouse.retain(spark, week, "2026-01-17 06:00:00")
    assert {p for p in paths(spark, week) if p in kept} == kept
    # a day of which nothing is left goes whole; production keeps all
    warehouse.retain(spark, week, "2026-01-18 23:00:00")
    assert not any("ymd=20260111" in p for p in paths(spark, week))
    rows = stored(spark, week)
    warehouse.retain(spark, week, "2030-01-01 00:00:00", env="prod")
    assert stored(spark, week) == rows


def test_a_stray_clock_opens_its_day_only(spark, week, monkeypatch):
    reads = []
    read = warehouse.read
    monkeypatch.setattr(warehouse, "read", lambda s, r: reads.append(read(s, r)) or reads[-1])
    batch = pings(spark, [("G1", "1970-01-01 00:00:01", 1), ("G1", "2026-01-14 05:30:00", 99), ("G9", "2026-01-14 05:30:00", 7), ("G9", "2026-01-14 05:30:00", 8)])
    held = spark.read.schema(warehouse.SCHEMA).parquet(week).count()
    days = []
    values = warehouse.partition_values
    monkeypatch.setattr(warehouse, "partition_values", lambda s, r, c: days.append(values(s, r, c)) or days[-1])
    warehouse.load(batch, week, ORDER)
    assert days[0] == ["19700101", "20260114"] and len(reads) == 1
    rows = stored(spark, week)
    assert len(rows) == held + 2
    assert ("G1", "1970-01-01 00:00:01", 1.0) in rows and ("G9", "2026-01-14 05:30:00", 7.0) in rows and ("G1", "2026-01-14 05:30:00", 14.0) in rows
    warehouse.load(batch, week, ORDER)
    assert stored(spark, week) == rows


def test_point_reads_skip_row_groups(spark):
    root = scratch_path(spark, "points")
    days = [(v, f"2026-01-{d:02d} {h:02d}:00:00", h) for d in range(1, 9) for v in ("A", "Z") for h in range(24)]
    warehouse.write(pings(spark, [*days, ("M", "2026-01-03 12:34:00", 5)]).drop("src_row"), root)

    def scanned(df):
        df.collect()
        plan, rows, stack = df._jdf.queryExecution().executedPlan(), 0, []
        stack.append(plan)
        while stack:
            node = stack.pop()
            if "AdaptiveSparkPlan" in node.nodeName():
                node = node.executedPlan()
            if "Scan" in node.nodeName():
                rows += node.metrics().apply("numOutputRows").value()
            kids = node.children()
            stack += [kids.apply(i) for i in range(kids.size())]
        return rows

    one = warehouse.vehicle_pings(spark, root, "M")
    assert [str(r.recorded_at) for r in one.collect()] == ["2026-01-03 12:34:00"]
    # minima and maxima do not tell M from A and Z, the Bloom filters of the other days do
    assert scanned(warehouse.vehicle_pings(spark, root, "M")) == 49
    between = warehouse.light_pings(spark, root, "TL001", "2026-01-02 22:00:00", "2026-01-03 02:00:00")
    assert between.count() == 8
    assert "PartitionFilters: [isnotnull(ymd" in between._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_of_a_bucketed_table_are_not_shuffled(spark):
    path = scratch_path(spark, "table")
    table = "t_" + path.rsplit("-", 1)[1]
    batch = pings(spark, [(f"G{k % 7}", f"2026-01-0{1 + k % 5} 10:00:{k % 60:02d}", k) for k in range(300)])
    ping_table.load(batch.filter("src_row < 100"), table, path, ORDER, 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ping_table.fresh(batch.drop("src_row"), table, [20260101])._jdf.queryExecution().executedPlan().toString()
        lines = [x.strip(" :+-|") for x in plan.splitlines()]
        scan = next(k for k, x in enumerate(lines) if "FileScan parquet" in x)
        join = max(k for k, x in enumerate(lines[:scan]) if "SortMergeJoin" in x)
        above = lines[join + 1:scan]
        offered = max((k for k, x in enumerate(above) if "ExistingRDD" in x or "LocalTableScan" in x), default=-1)
        assert not any("Exchange" in x for x in above[offered + 1:]), plan
        assert "Bucketed: true" in plan and "ymd#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for _ in range(2):
        ping_table.load(batch, table, path, ORDER, 4)
    assert spark.table(table).count() == batch.select("gps_id", "recorded_at").distinct().count()


def test_latest_reads_new_days_first(spark):
    root = scratch_path(spark, "verdicts")
    stats = spark.sql("SELECT 'TL00' || l AS traffic_light_id, 'off_peak' AS time_window, 'weekday' AS day_type, "
                      "TIMESTAMP '2026-01-01 12:00:00' + make_dt_interval(d) AS analysis_ts, 20.0D AS avg_speed, 3L AS veh_count "
                      "FROM (SELECT explode(sequence(1, 5)) AS l) CROSS JOIN (SELECT explode(sequence(0, 9)) AS d) WHERE l < 5 OR d = 2")
    verdict_store.load(congestion.verdicts(stats, dimensions.light_schedule(spark)), root)
    assert verdict_store.days(spark, root)[0] == "2026-01-10" and len(verdict_store.days(spark, root)) == 10
    newest = verdict_store.latest(spark, root, 6).collect()
    assert [r.analysis_time[:10] for r in newest] == ["2026-01-10"] * 4 + ["2026-01-09"] * 2
    assert verdict_store.latest(spark, root, 1000).count() == 41
    last = {r.traffic_light_id: r.analysis_time[:10] for r in verdict_store.latest_per_light(spark, root, dimensions.traffic_lights(spark)).collect()}
    assert last == {"TL001": "2026-01-10", "TL002": "2026-01-10", "TL003": "2026-01-10", "TL004": "2026-01-10", "TL005": "2026-01-03"}
