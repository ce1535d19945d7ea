"""Exact runs, sketches, samples, and what streams do by themselves."""

from datetime import timedelta

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from roadlens.operators import congestion, trajectory
from roadlens.plans import queries
from roadlens.session import scratch_path, stream_session
from roadlens.sources import lake
from roadlens.streaming import pipelines


def test_runs_see_what_was_received(spark):
    """A ping counts from the first run after its reception to the last one less than five minutes after its stamp."""
    rows = [("a", "12:00:10", "12:00:12", 10.0),   # runs 12:01 to 12:05
            ("b", "12:00:00", "12:03:30", 20.0),   # late: 12:04 only (12:05 is not less than five minutes after)
            ("c", "12:08:00", "12:02:00", 30.0),   # the future: 12:02 to 12:12
            ("d", "12:00:00", "12:07:00", 99.0)]   # too late for any run
    df = spark.createDataFrame(rows, "gps_id string, r string, g string, speed_kmh double").selectExpr(
        "gps_id", "CAST('2026-01-09 ' || r AS TIMESTAMP) AS recorded_at", "CAST('2026-01-09 ' || g AS TIMESTAMP) AS received_at", "speed_kmh",
        "'TL001' AS traffic_light_id", "'off_peak' AS time_window", "'weekday' AS day_type")
    out = congestion.run_stats(df, "TIMESTAMP '2026-01-09 12:11:00'").collect()
    got = {r.analysis_ts.strftime("%H:%M"): (r.veh_count, r.avg_speed) for r in out}
    want = {}
    for minute in range(12):
        seen = [s for v, first, last, s in (("a", 1, 5, 10.0), ("b", 4, 4, 20.0), ("c", 2, 12, 30.0)) if first <= minute <= last]
        if seen:
            want[f"12:{minute:02d}"] = (len(seen), sum(seen) / len(seen))
    assert got == want


def test_sketches_are_close(spark):
    n = 40_000
    df = spark.range(n * 3).selectExpr(
        f"concat('v', id % {n}) AS gps_id", "TIMESTAMP '2026-01-09 12:00:00' + make_dt_interval(0, 0, 0, id % 240) AS recorded_at",
        "CAST(id % 50 AS DOUBLE) AS speed_kmh", "'TL001' AS traffic_light_id", "'off_peak' AS time_window", "'weekday' AS day_type")
    key = lambda stats: {r.analysis_ts: r for r in stats.collect()}
    exact, near = key(congestion.pane_stats(df, 5, 1)), key(congestion.sketched_stats(df, 5, 1, lg_k=12))
    assert exact.keys() == near.keys() and len(exact) > 4
    for at, r in exact.items():
        assert abs(near[at].veh_count - r.veh_count) <= 4 * 1.04 / 64 * r.veh_count and near[at].avg_speed == r.avg_speed
    few = df.filter("length(gps_id) = 2")
    assert {k: r.veh_count for k, r in key(congestion.pane_stats(few, 5, 1)).items()} == {
        k: r.veh_count for k, r in key(congestion.sketched_stats(few, 5, 1)).items()}


def test_samples_start_with_the_run(spark):
    at = [0, 1, 4.9, 5, 9, 12, 26, 29, 31, 33, 100, 104]
    df = spark.createDataFrame([("v", float(t), 1.0) for t in at], "gps_id string, t double, speed_kmh double").selectExpr(
        "gps_id", "timestamp_micros(CAST(1767950000123456 + t * 1000000 AS BIGINT)) AS recorded_at", "t AS latitude", "t AS longitude", "speed_kmh")
    out = sorted((r.run_start, r["sample"], r.latitude) for r in trajectory.run_samples(df).collect())
    assert [(s, t) for _, s, t in out] == [(1, 0), (2, 5), (3, 12), (6, 26), (1, 100)] and out[0][0] != out[-1][0]


def _requests(spark, n):
    body = '{"gps_id": "G%d", "timestamp": "2026-01-09 12:00:00", "latitude": 21.0, "longitude": 105.0}'
    d = scratch_path(spark, "requests")
    spark.createDataFrame([(body % k if k % 5 else "junk%d" % k,) for k in range(n)], "value string").repartition(6).write.text(d)
    return d


def test_limits_make_batches_and_a_failed_one_is_resumed(spark, monkeypatch):
    """The sink fails half way; after a restart from the checkpoint no row is lost or doubled, in the lake and in the audit."""
    d, folder = _requests(spark, 60), scratch_path(spark, "ingest")
    session = stream_session(spark)
    listener = pipelines.StreamAudit(spark, folder + "/audit")
    session.streams.addListener(listener)
    real, calls = lake.write, []

    def failing(*args, **kw):
        calls.append(1)
        real(*args, **kw)
        if len(calls) == 2:
            raise RuntimeError("the sink is gone")

    def run():
        stream = pipelines.read_stream(session, "text", {"path": d}, max_files=2)
        return pipelines.ingest(stream, folder + "/lake", folder + "/dead", folder + "/ckpt", received_at="'now'")

    monkeypatch.setattr(lake, "write", failing)
    with pytest.raises(Exception, match="the sink is gone"):
        run().awaitTermination()
    assert len(calls) == 2
    run().awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    session.streams.removeListener(listener)
    rows = [r.gps_id for r in lake.read(spark, folder + "/lake", with_order=False).collect()]
    assert len(rows) == len(set(rows)) == 48
    assert spark.read.parquet(folder + "/dead").count() == 12
    audit = spark.read.schema(pipelines.AUDIT).parquet(folder + "/audit/*/*")
    assert {r.metric: r.s for r in audit.groupBy("metric").agg(F.sum("value").alias("s")).collect()} == {
        "rows_in": 60, "rows_accepted": 48, "rows_malformed": 12, "rows_invalid": 0}
    assert audit.select("batch_id").distinct().count() == 3


def test_a_stream_emits_what_the_watermark_has_closed(spark, monkeypatch):
    """Before the catch-up: every window that ends ten minutes before the last ping, and at most what the batch has."""
    seen = {}
    monkeypatch.setattr(pipelines, "catch_up", lambda stored, complete, keys: seen.update(stored=stored, complete=complete) or stored)
    queries.stream_verdicts(spark, SF_SMALL)
    emitted = {(r.traffic_light_id, r.analysis_time) for r in seen["stored"].collect()}
    complete = {(r.traffic_light_id, r.analysis_time) for r in seen["complete"].collect()}
    last = queries.base.warehouse_all(spark, SF_SMALL).agg(F.max("recorded_at").alias("t")).first()["t"]
    closed = {k for k in complete if k[1] <= (last - timedelta(minutes=10)).strftime("%Y-%m-%d %H:%M:%S")}
    assert closed <= emitted <= complete and len(closed) > 900
