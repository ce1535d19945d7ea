"""Properties: idempotent load, permutation invariance, keep-first under skew."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from roadlens.operators import congestion, load
from roadlens.operators.joins import keep_first
from roadlens.plans import base
from roadlens.sources import dimensions


def test_load_twice_equals_once(spark):
    pings = base.warehouse_pings(spark, SF_SMALL)
    first = load.insert_or_ignore(pings.limit(0), pings, ["gps_id", "recorded_at"], ["speed_kmh"])
    again = load.insert_or_ignore(first, pings, ["gps_id", "recorded_at"], ["speed_kmh"])
    assert again.count() == 0
    assert first.count() == pings.count()


def test_permuted_input_same_verdicts(spark):
    pings = base.warehouse_pings(spark, SF_SMALL)
    sched = dimensions.light_schedule(spark)
    a = congestion.windowed(pings, sched)
    b = congestion.windowed(pings.repartition(7, "speed_kmh").orderBy(F.rand(3)), sched)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_keep_first_hot_key(spark):
    # one key holds most rows: the first by order must win, nulls last
    rows = [("hot", i, float(i)) for i in range(5000, 0, -1)] + [("cold", None, 1.0), ("cold", 7, 2.0)]
    df = spark.createDataFrame(rows, "k string, o long, v double").repartition(8)
    got = {r.k: (r.o, r.v) for r in keep_first(df, ["k"], ["o"]).collect()}
    assert got == {"hot": (1, 1.0), "cold": (7, 2.0)}


def test_accepted_plus_rejected_is_input(spark):
    from roadlens.sources import decode, fixtures
    req = fixtures.gps_requests(spark, SF_SMALL)
    d = decode.decode_requests(req)
    assert decode.accepted(d).count() + decode.rejected(d).count() == req.count()


def test_clean_plus_rejects_is_input(spark):
    from roadlens.operators import clean
    raw = base.raw_pings(spark, SF_SMALL)
    assert clean.clean(raw).count() + clean.rejects(raw).count() == raw.count()


def test_lake_partition_pruning_in_plan(spark):
    import tempfile
    from roadlens.sources import lake
    root = tempfile.mkdtemp(prefix="roadlens-lake-")
    raw = base.raw_pings(spark, SF_SMALL)
    lake.write(lake.with_partitions(raw, "prod", F.to_timestamp("received_at")), root)
    df = lake.read(spark, root, env="prod").filter(F.col("day") == 9)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:200]
    assert df.count() == raw.filter(F.dayofmonth(F.to_timestamp("received_at")) == 9).count()


def test_bucketed_sessions_equal_native_session_window(spark):
    """Runs crossing many hour buckets (a continuously active vehicle) and random gaps."""
    from roadlens.operators.trajectory import sessions
    gap = 600
    ts = (F.timestamp_seconds(F.lit(1767916800) + F.col("t")))
    # vehicle A: every 59 s for 10 h (one run across 10 buckets); B: pseudo-random gaps up to 20 min
    a = spark.range(0, 610).select(F.lit("A").alias("gps_id"), (F.col("id") * 59).alias("t"))
    b = spark.range(0, 3000).select(F.lit("B").alias("gps_id"),
                                    F.sum(F.abs(F.hash("id")) % 1300 + 1).over(Window.orderBy("id")).alias("t"))
    pings = a.unionByName(b).select("gps_id", ts.alias("recorded_at"),
                                    F.lit(21.0).alias("latitude"), F.lit(105.0).alias("longitude"))
    mine = sorted((r.gps_id, r.session_start, r.n_points) for r in sessions(pings, gap).collect())
    native = (pings.groupBy("gps_id", F.session_window("recorded_at", f"{gap} seconds").alias("s"))
              .agg(F.count(F.lit(1)).alias("n"), F.min("recorded_at").alias("f")))
    want = sorted((r.gps_id, r.f.strftime("%Y-%m-%d %H:%M:%S"), r.n) for r in native.collect())
    assert mine == want
    assert any(n == 610 for g, _, n in mine if g == "A")


def test_sub_second_gaps(spark):
    """A gap is compared as an instant, also across the edge of a bucket."""
    from roadlens.operators.trajectory import route_points, sessions
    start = 1767916790_000_000  # ten seconds before a full minute
    steps = [0, 29_999_999, 30_000_000, 30_000_001, 5, 59_400_000, 30_000_000]
    rows, t = [], start
    for s in steps:
        t += s
        rows.append(("A", t))
    pings = spark.createDataFrame(rows, "gps_id string, us bigint").selectExpr(
        "gps_id", "timestamp_micros(us) AS recorded_at", "1.0D AS latitude", "2.0D AS longitude", "3.0D AS speed_kmh")
    assert sorted(r.n_points for r in sessions(pings, 30).collect()) == [2, 2, 3]
    points = route_points(pings, 30).collect()
    assert len(points) == len(rows) and len({p.run_start for p in points}) == 3
    native = pings.groupBy("gps_id", F.session_window("recorded_at", "30 seconds")).count()
    assert sorted(r["count"] for r in native.collect()) == [2, 2, 3]


def test_fixture_keys_grow_with_the_table(spark):
    """Only the injected copies are duplicates."""
    from roadlens.operators import clean
    raw = base.raw_pings(spark, SF_SMALL)
    valid = clean.valid(raw)
    keys = valid.select("gps_id", "timestamp").distinct().count()
    assert keys == valid.filter("src_file = 0").count() + valid.filter("src_file = 1").join(
        valid.filter("src_file = 0").select("gps_id", "timestamp"), ["gps_id", "timestamp"], "left_anti").count()


def test_audit_balances(spark):
    from roadlens.plans.queries import QUERIES
    m = {r.metric: r.value for r in QUERIES["load_audit"](spark, SF_SMALL).collect()}
    assert m["rows_offered"] == m["rows_loaded"] + m["rows_rejected_rule"] + m["rows_duplicate"]
    assert m["rows_bad_timestamp"] > 0 and m["rows_duplicate"] > 0


def test_bad_value_does_not_end_a_lake_write(spark):
    from roadlens.sources import lake
    bad = spark.createDataFrame([("G", "junk", "abc")], "gps_id string, timestamp string, latitude string")
    row = lake.align(bad).first()
    assert row.latitude is None and row.timestamp == "junk"


def test_panes_equal_windows(spark):
    """Sliding windows from panes equal those that list every ping under every window."""
    pings = base.warehouse_pings(spark, SF_SMALL)
    panes = congestion.pane_stats(pings, 5, 1)
    listed = congestion.group_stats(pings.withColumn("w", F.window("recorded_at", "5 minutes", "1 minute")), ["w"]).selectExpr(
        "w.end AS analysis_ts", *congestion.GROUP, "veh_count", "avg_speed").select(panes.columns)
    assert panes.exceptAll(listed).isEmpty() and listed.exceptAll(panes).isEmpty()


def test_warehouse_day_pruning_in_plan(spark):
    import tempfile
    from roadlens.sources import warehouse
    root = tempfile.mkdtemp(prefix="roadlens-wh-") + "/t"
    pings = base.warehouse_pings(spark, SF_SMALL)
    warehouse.write(pings, root)
    since = f"TIMESTAMP '{base.AS_OF}' - INTERVAL 5 MINUTES"
    df = warehouse.read_since(spark, root, since)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ymd" in plan.split("PartitionFilters")[1][:300]
    assert "recorded_at" in plan.split("PushedFilters")[1][:300]
    assert df.count() == pings.filter(f"recorded_at > {since}").count()


def test_rocksdb_state(spark):
    """The state store that streams use runs here too."""
    import tempfile
    from roadlens.session import ROCKSDB, stream_session
    s = stream_session(spark, 2)
    assert s.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
    d = tempfile.mkdtemp(prefix="roadlens-state-")
    spark.range(100).selectExpr("id % 7 AS k").write.parquet(d + "/in")
    counted = s.readStream.schema("k bigint").parquet(d + "/in").groupBy("k").count()
    (counted.writeStream.outputMode("complete").foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(d + "/out"))
     .option("checkpointLocation", d + "/ckpt").trigger(availableNow=True).start().awaitTermination())
    assert spark.read.parquet(d + "/out").count() == 7
