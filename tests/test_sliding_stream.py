"""Sliding windows: no vehicle's row is copied to the windows that cover it, and the stream closes each window once (finding of round 4)."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roadlens.operators import congestion
from roadlens.session import exists, scratch_path, stream_session
from roadlens.sources import dimensions
from roadlens.streaming import pipelines

PING = "gps_id string, at double, speed_kmh double, traffic_light_id string, time_window string, day_type string"
BASE = 1_767_950_000_000_000 // 60_000_000 * 60_000_000  # a whole minute of 2026-01-09


def pings(spark, rows):
    """``rows``: vehicle, minutes after BASE, speed, light."""
    return spark.createDataFrame([(v, float(at), s, light, "off_peak", None) for v, at, s, light in rows], PING).selectExpr(
        "gps_id", f"timestamp_micros(CAST({BASE} + at * 60000000 AS BIGINT)) AS recorded_at", "speed_kmh", *congestion.GROUP)


def exchanged(plan):
    """Rows written by each shuffle of an executed plan."""
    found = [plan.metrics().apply("shuffleRecordsWritten").value()] if plan.nodeName() == "Exchange" else []
    children = plan.children()
    return found + [n for k in range(children.size()) for n in exchanged(children.apply(k))]


def test_shuffles_have_no_row_per_vehicle_and_window(spark):
    df = congestion.pane_stats(pings(spark, [(f"v{k}", k % 5 / 10, 7.0, "TL001") for k in range(300)]), 5, 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = df.collect()
        rows = exchanged(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(out) == 5 and {(r.veh_count, r.avg_speed) for r in out} == {(300, 7.0)}
    assert max(rows) <= 300, rows  # 1500 when panes of a vehicle are copied to its windows


@pytest.mark.parametrize("minutes, slide", [(5, 1), (6, 2), (90, 1), (3, 3)])
def test_vehicles_are_counted_once_over_gaps_and_blocks(spark, minutes, slide):
    rng = random.Random(minutes)
    rows = [(rng.choice(["a", "b", "c", None]), rng.uniform(-40, 1300) if k % 3 else 60 * (k % 20) - rng.random() / 9, rng.choice([None, 1.0, 2.5]),
             rng.choice(["TL001", "TL001", "TL002", None])) for k in range(700)]
    df = pings(spark, rows)
    panes = congestion.pane_stats(df, minutes, slide)
    listed = congestion.group_stats(df.withColumn("w", F.window("recorded_at", f"{minutes} minutes", f"{slide} minutes")), ["w"]).selectExpr(
        "w.end AS analysis_ts", *congestion.GROUP, "veh_count", "avg_speed").select(panes.columns)
    assert panes.exceptAll(listed).isEmpty() and listed.exceptAll(panes).isEmpty() and panes.count() > 100


BATCHES = [
    [("a", 0.2, 10.0, "TL001"), ("b", 0.9, 20.0, "TL001"), ("a", 3.5, 30.0, "TL001"), ("c", 3.6, None, "TL002")],  # closes nothing
    [("a", 13.2, 2.0, "TL001"), ("n", 40.0, 1.0, None)],  # a ping without a light moves no watermark: closed to minute 3
    # open windows only (4 and 5), none at all, and one that is in time; closed to minute 6
    [("d", 0.5, 90.0, "TL001"), ("e", -6.0, 90.0, "TL001"), ("b", 12.7, 4.0, "TL001"), ("a", 16.0, 4.0, "TL001")],
    [("f", 60.0, 5.0, "TL003")]]  # closes all that is older


def expected():
    """Of each batch: window end → light → (vehicles, mean speed), as the watermark closes them."""
    seen, wm, out = [], None, []
    for batch in BATCHES:
        seen += [(*p, wm) for p in batch if p[3]]
        now = max(p[1] for p in seen) - 10
        windows = defaultdict(list)
        for v, at, speed, light, late in seen:
            for end in range(int(at // 1) + 1, int(at // 1) + 6):
                if end <= now and (wm is None or end > wm) and (late is None or end > late):
                    windows[end, light].append((v, speed))
        out.append({k: (len({v for v, _ in w}), sum(s for _, s in w if s is not None) / len([s for _, s in w if s is not None]))
                    for k, w in windows.items() if any(s is not None for _, s in w)})
        wm = now
    return out


@pytest.mark.parametrize("fails", [False, True])
def test_a_sliding_stream_closes_each_window_once(spark, monkeypatch, fails):
    """Late pings count in open windows only. With ``fails``, each batch's sink fails once after it has written, and is resumed."""
    d, session, writer, calls = scratch_path(spark, "sliding"), stream_session(spark), pipelines.verdict_batch_writer, []

    def failing(*args):
        write = writer(*args)

        def run(stats, batch_id):
            write(stats, batch_id)
            calls.append(batch_id)
            if fails and calls.count(batch_id) == 1:
                raise RuntimeError("the sink is gone")
        return run

    monkeypatch.setattr(pipelines, "verdict_batch_writer", failing)
    for k, batch in enumerate(BATCHES):
        df = pings(spark, batch)
        df.write.mode("append").parquet(d + "/in")
        for attempt in range(1 + fails):
            stream = session.readStream.schema(df.schema).parquet(d + "/in")
            query = pipelines.verdicts(stream, dimensions.light_schedule(session), d + "/out", d + "/ckpt", slide=1)
            if fails and not attempt:
                with pytest.raises(Exception, match="the sink is gone"):
                    query.awaitTermination()
            else:
                query.awaitTermination()
        progress = query.lastProgress
        assert not progress["stateOperators"]  # five rows a vehicle before
        state = spark.read.parquet(f"{d}/ckpt/panes/batch_id={k}")
        assert state.count() == state.select("__p", "gps_id", "traffic_light_id").distinct().count() <= sum(map(len, BATCHES[:k + 1]))
        assert not exists(spark, f"{d}/ckpt/panes/batch_id={k - 2}")
        got = {((r.m - BASE) // 60_000_000, r.traffic_light_id): (r.vehicle_count, r.avg_speed_kmh) for r in spark.read.parquet(f"{d}/out/batch_id={k}")
               .selectExpr("unix_micros(CAST(analysis_time AS TIMESTAMP)) AS m", "*").collect() if r.avg_speed_kmh is not None}
        assert got == {key: (n, pytest.approx(mean, abs=0.005)) for key, (n, mean) in expected()[k].items()}, k
    assert [len(e) for e in expected()] == [0, 3, 3, 11]
