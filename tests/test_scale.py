"""What crosses a shuffle or is written on the way: no more than a job needs (findings of round 3)."""

import pytest

from conftest import SF_SMALL
from roadlens.operators import clean, trajectory
from roadlens.operators.enrich import WAREHOUSE_COLS
from roadlens.operators.joins import keep_first
from roadlens.plans import base, queries
from roadlens.session import scratch_path, stream_session
from roadlens.sources import lake, ping_table, warehouse
from roadlens.streaming import pipelines

ORDER = ["src_row"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pings(spark, rows):
    df = spark.createDataFrame(rows, "gps_id string, at string, src_row int")
    return df.selectExpr("gps_id", "gps_id AS vehicle_id", "CAST(at AS TIMESTAMP) AS recorded_at", "21.0D AS latitude", "105.0D AS longitude",
                         "named_struct('lon', 105.0D, 'lat', 21.0D, 'srid', 4326) AS geom", "CAST(src_row AS DOUBLE) AS speed_kmh",
                         "CAST(NULL AS DOUBLE) AS heading", "'TL001' AS traffic_light_id", "'weekday' AS day_type",
                         "'off_peak' AS time_window", "1 AS time_id", "src_row")


def test_pings_are_made_by_many_tasks(spark):
    assert base.raw_pings(spark, SF_SMALL).rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_keep_first_has_nothing_twice(spark):
    df = spark.sql("SELECT id % 3 AS k, id AS o, CASE WHEN id > 6 THEN id END AS m, -id AS v FROM range(12)")
    first = keep_first(df, ["k"], ["m", "o"])
    struct = plan(first).split("min(")[1].split(") AS")[0]
    assert struct.count("o#") == 1 and struct.count("isnull(") == 1, struct
    assert first.columns == df.columns
    assert sorted(map(tuple, first.collect())) == [(0, 9, 9, -9), (1, 7, 7, -7), (2, 8, 8, -8)]


def test_derived_columns_do_not_cross_the_shuffle(spark):
    rows = base.warehouse_all(spark, SF_SMALL)
    struct = plan(rows).split("min(")[1]
    assert "srid" not in struct.split(" AS __first")[0] and rows.columns == WAREHOUSE_COLS


def test_rejects_carry_places_not_rows(spark):
    cols = "gps_id string, timestamp string, latitude double, longitude double, speed_kmh double, src_file int, src_row long"
    at = "2026-01-05 08:00:00"
    rows = [("A", at, 21.0, 105.0, 1.0, 0, 1), ("A", at, 21.0, 105.0, 2.0, 1, 1), ("A", at, 21.0, 105.0, 3.0, 0, 1),
            ("B", at, 21.0, 105.0, 1.0, 0, 2), ("C", at, 99.0, 105.0, 1.0, 0, 3), ("D", at, 21.0, 105.0, 1.0, 0, None),
            (None, at, 21.0, 105.0, 1.0, 0, 5), ("E", "junk", 21.0, 105.0, 1.0, 0, 6), ("E", at, 21.0, 105.0, 1.0, 0, 7)]
    out = clean.rejects(spark.createDataFrame(rows, cols))
    got = sorted((r.gps_id or "", r.src_file, r.src_row or 0, r.reject_reason) for r in out.collect())
    # a row without a place is nobody's first row; rows equal in key and place are the first row, both of them
    assert got == [("", 0, 5, "missing_field"), ("A", 1, 1, "duplicate"), ("C", 0, 3, "latitude_range"), ("D", 0, 0, "duplicate"), ("E", 0, 6, "bad_timestamp")]
    assert "latitude" not in plan(out).split("min(")[1].split(") AS")[0]


def test_a_load_stages_days_only(spark, monkeypatch):
    root, paths = scratch_path(spark, "scale-load"), []
    monkeypatch.setattr(warehouse, "scratch_path", lambda s, n: paths.append(scratch_path(s, n)) or paths[-1])
    warehouse.load(pings(spark, [("A", "2026-01-05 08:00:00", 1)]), root, ORDER)
    batch = pings(spark, [("A", "2026-01-05 08:00:00", 0), ("B", "2026-01-05 08:00:00", 4), ("B", "2026-01-05 08:00:00", 3), (None, "2026-01-05 08:00:00", 5)])
    for _ in range(2):
        warehouse.load(batch, root, ORDER)
    assert all(spark.read.parquet(p).columns == ["n", "ymd"] for p in paths) and len(paths) == 2
    # a row without a vehicle matches no stored one, so each load adds it
    got = sorted((r.gps_id or "", r.speed_kmh, r.geom.lat, r.time_id is None) for r in warehouse.read(spark, root).collect())
    assert got == [("", 5.0, 21.0, False)] * 2 + [("A", 1.0, 21.0, False), ("B", 3.0, 21.0, False)]


def test_a_table_load_shuffles_the_offered_rows_once(spark, monkeypatch):
    path = scratch_path(spark, "scale-table")
    table, seen = "t_" + path.rsplit("-", 1)[1], []
    append = ping_table._append
    monkeypatch.setattr(ping_table, "_append", lambda rows, *a: seen.append(physical(rows)) or append(rows, *a))
    batch = pings(spark, [(f"G{k % 7}", f"2026-01-05 10:00:{k % 60:02d}", k) for k in range(100)])
    for part in (batch.filter("src_row < 50"), batch):
        ping_table.load(part, table, path, ORDER, 4)
    assert seen[1].count("Exchange hashpartitioning") == 1 and "table-batch" not in seen[1], seen[1]
    assert spark.table(table).count() == batch.select("gps_id", "recorded_at").distinct().count()


def test_a_stream_is_fed_from_rows_written_once(spark):
    rows = base.warehouse_all(spark, SF_SMALL).select("gps_id", "recorded_at")
    d = queries._stream_over(spark, rows, "scale-stream", queries._append(lambda s: s))
    assert spark.read.parquet(d + "/all").columns == rows.columns
    assert sorted(queries._arrived(spark, d, rows).collect()) == sorted(rows.collect())
    assert stream_session(spark).conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"


@pytest.mark.parametrize("job", [trajectory.route_points, trajectory.run_samples])
def test_routes_run_the_pings_shuffle_once(spark, job):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "ReusedExchange" in physical(job(base.warehouse_pings(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_dedupe_stream_carries_its_keys_only(spark, monkeypatch):
    seen, over = [], queries._stream_over
    monkeypatch.setattr(queries, "_stream_over", lambda s, df, *a: seen.append(df.columns) or over(s, df, *a))
    out = queries.stream_dedupe(spark, SF_SMALL)
    assert seen == [["gps_id", "recorded_at"]] and out.count() == base.warehouse_all(spark, SF_SMALL).count()


def test_ingest_keeps_the_bodies_of_rejected_rows_only(spark, monkeypatch):
    d, seen, rejected = scratch_path(spark, "scale-ingest"), [], pipelines.decode.rejected
    good = '{"gps_id": "A", "timestamp": "2026-01-05 08:00:00", "latitude": 21.0, "longitude": 105.0}'
    spark.createDataFrame([(good,), ("{bad",)], "value string").write.text(d + "/requests")
    monkeypatch.setattr(pipelines.decode, "rejected", lambda batch: seen.extend((r.value, r.reject_reason) for r in batch.collect()) or rejected(batch))
    session = stream_session(spark)
    pipelines.ingest(pipelines.read_text_stream(session, d + "/requests"), d + "/lake", d + "/dead", d + "/ckpt").awaitTermination()
    assert sorted(seen, key=str) == [("{bad", "malformed"), (None, None)]
    assert [tuple(r) for r in spark.read.parquet(d + "/dead").select("value", "reject_reason").collect()] == [("{bad", "malformed")]
    assert lake.read(spark, d + "/lake", with_order=False).select("gps_id").collect()[0][0] == "A"
    assert int(session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == 16 << 20
