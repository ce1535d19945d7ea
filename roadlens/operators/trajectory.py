"""Trajectory jobs over warehouse pings: down-sampling, runs and feeds.

The phone collects one ping at start and then one every 5 s for a 30 s run;
the legacy page shows a marker per ping and the route of a run. Here they are
table jobs:

* :func:`downsample` — first ping per (vehicle, N-second bucket).
* :func:`sessions` — runs as gap sessions (``session_window``), with point
  count, first/last instant and start/current position.
* :func:`marker_feed` — one display row per ping with a popup text.

Both aggregations are partial (map-side) or bucketed so a vehicle with a
third of all pings never sits whole in one task: ``min_by``/``max_by`` are
declarative aggregates, and sessions are built per (vehicle, hour bucket)
first, then stitched across bucket edges (see :func:`sessions`).
A run is not in the data (the phone clears its list on a button press), so a
gap delimits it: a ping at most ``gap`` after the previous one continues the
run (``session_window`` merges at exactly one gap).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.congestion import round_dec_sql
from roadlens.functions.timeparts import ts_text_sql


def downsample(pings: DataFrame, seconds: int = 5, vehicle_col: str = "gps_id") -> DataFrame:
    w = F.window("recorded_at", f"{int(seconds)} seconds")
    first = ("min_by(named_struct('recorded_at', recorded_at, 'latitude', latitude, "
             "'longitude', longitude, 'speed_kmh', speed_kmh), recorded_at) AS __p")
    return (pings.groupBy(F.col(vehicle_col), w.alias("__b"))
                 .agg(F.expr(first))
                 .selectExpr(f"`{vehicle_col}`",
                             f"{ts_text_sql('__b.start')} AS bucket_start",
                             f"{ts_text_sql('__p.recorded_at')} AS recorded_at",
                             "__p.latitude AS latitude", "__p.longitude AS longitude",
                             "__p.speed_kmh AS speed_kmh"))


def _runs(pings: DataFrame, gap_seconds: int, vehicle_col: str, bucket_seconds: int | None) -> DataFrame:
    """One row per run: instants ``f`` and ``l``, points ``n``, positions ``sp`` and ``cp``.

    Two levels, so no vehicle's whole timeline is ever one group:

    1. ``session_window`` inside each (vehicle, time bucket) group — a group is
       bounded by one bucket of one vehicle, and a hot vehicle spreads over
       many buckets/tasks (Spark's batch session merge runs after the shuffle
       on the vehicle key, without it one device would be one task).
    2. Sessions that can reach across a bucket edge
       (``first - gap < bucket start`` or ``last + gap >= bucket end``) are
       stitched by gaps-and-islands per vehicle: at most two per bucket, a
       count bounded by the time span, not by data volume. Interior sessions
       are final after level 1; they pass the same window partitioned by
       (vehicle, bucket), where each is its own island (sessions of one
       bucket are more than ``gap`` apart).

    Both kinds flow through one window and one aggregate (no union of two
    branches, so level 1 is computed once), and the aggregate reuses the
    window's partitioning. A ping at most ``gap`` after the previous one
    continues the run, as ``session_window`` does.
    """
    g = int(gap_seconds) * 1_000_000
    bs = int(bucket_seconds or max(60, 2 * gap_seconds)) * 1_000_000  # all in microseconds: gaps are compared as instants
    v = f"`{vehicle_col}`"
    lvl1 = (pings.groupBy(F.col(vehicle_col), F.expr(f"unix_micros(recorded_at) div {bs} AS __b"),
                          F.session_window("recorded_at", f"{int(gap_seconds)} seconds").alias("__s"))
                 .agg(F.expr("count(1) AS n"), F.expr("min(recorded_at) AS f"), F.expr("max(recorded_at) AS l"),
                      F.expr("min_by(named_struct('latitude', latitude, 'longitude', longitude), recorded_at) AS sp"),
                      F.expr("max_by(named_struct('latitude', latitude, 'longitude', longitude), recorded_at) AS cp")))
    edge = f"unix_micros(f) - {g} < __b * {bs} OR unix_micros(l) + {g} >= (__b + 1) * {bs}"
    x = lvl1.selectExpr(v, "n", "f", "l", "sp", "cp", f"{edge} AS __edge",
                        f"CASE WHEN {edge} THEN NULL ELSE __b END AS __part")
    w = Window.partitionBy(vehicle_col, "__edge", "__part").orderBy("f")
    islands = (x.withColumn("__prev", F.lag("l").over(w))
                .withColumn("__new", F.expr(f"CASE WHEN __prev IS NULL OR "
                                            f"unix_micros(f) - unix_micros(__prev) > {g} THEN 1 ELSE 0 END"))
                .withColumn("__isl", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return (islands.groupBy(vehicle_col, "__edge", "__part", "__isl")
            .agg(F.expr("sum(n) AS n"), F.expr("min(f) AS f"), F.expr("max(l) AS l"),
                 F.expr("min_by(sp, f) AS sp"), F.expr("max_by(cp, l) AS cp")))


def sessions(pings: DataFrame, gap_seconds: int = 30, vehicle_col: str = "gps_id",
             bucket_seconds: int | None = None) -> DataFrame:
    """One row per run: start/end instants, points, start and current position (see :func:`_runs`)."""
    return _runs(pings, gap_seconds, vehicle_col, bucket_seconds).selectExpr(
        f"`{vehicle_col}`",
        f"{ts_text_sql('f')} AS session_start",
        f"{ts_text_sql('l')} AS last_ping",
        "CAST(n AS INT) AS n_points",
        "CAST((unix_micros(l) - unix_micros(f)) div 1000000 AS INT) AS duration_s",
        "sp.latitude AS start_latitude", "sp.longitude AS start_longitude",
        "cp.latitude AS current_latitude", "cp.longitude AS current_longitude")


def route_points(pings: DataFrame, gap_seconds: int = 30, vehicle_col: str = "gps_id",
                 bucket_seconds: int | None = None) -> DataFrame:
    """The points of every run, one row each: the run's first instant and the point's, in whose order they form the route.

    A point finds its run by an equi-join on (vehicle, time bucket): a run is
    listed under every bucket that it touches, so a busy vehicle's points
    spread over its buckets.

    Both sides are the same rows, with the same filters, so the shuffle that made them is read twice and not run twice.
    """
    pings = pings.filter(f"`{vehicle_col}` IS NOT NULL AND recorded_at IS NOT NULL")
    bs = int(bucket_seconds or max(60, 2 * gap_seconds)) * 1_000_000
    runs = _runs(pings, gap_seconds, vehicle_col, bucket_seconds).selectExpr(
        f"`{vehicle_col}` AS __v", "f", "l", f"explode(sequence(unix_micros(f) div {bs}, unix_micros(l) div {bs})) AS __b")
    # coalesce: no filter on the bucket is inferred, which only this side would have
    points = pings.withColumn("__b", F.expr(f"coalesce(unix_micros(recorded_at) div {bs}, 0L)"))
    return (points.join(runs, (points[vehicle_col] == runs["__v"]) & (points["__b"] == runs["__b"])
                        & F.col("recorded_at").between(F.col("f"), F.col("l")))
            .selectExpr(f"`{vehicle_col}`", "f AS run_start", "recorded_at", "latitude", "longitude", "speed_kmh"))


def run_samples(pings: DataFrame, gap_seconds: int = 30, seconds: int = 5, at_most: int = 6, vehicle_col: str = "gps_id") -> DataFrame:
    """What a phone sends of each run: the ping at its start, then one every ``seconds`` seconds, ``at_most`` in all.

    Steps are counted from the run's first instant; a sample is the first ping of its step, and steps without a ping have none.
    """
    step = f"(unix_micros(recorded_at) - unix_micros(run_start)) div {int(seconds) * 1_000_000}"
    points = route_points(pings, gap_seconds, vehicle_col).withColumn("__k", F.expr(step)).filter(F.col("__k") < at_most)
    first = ("min_by(named_struct('recorded_at', recorded_at, 'latitude', latitude, 'longitude', longitude, "
             "'speed_kmh', speed_kmh), recorded_at) AS __p")
    return (points.groupBy(vehicle_col, "run_start", "__k").agg(F.expr(first))
            .selectExpr(f"`{vehicle_col}`", "run_start", "CAST(__k + 1 AS INT) AS sample", "__p.*"))


# FIXED VALUES: popup labels of the marker feed.
POPUP_FMT = "GPS ID: %s | Xe: %s | Tốc độ: %s km/h | Độ chính xác: %s m | Thời gian: %s"
NA = "N/A"


def marker_feed(pings: DataFrame, accuracy_col: str | None = None) -> DataFrame:
    """Position plus popup text per ping; speed with one decimal (HALF_UP)."""
    na = f"'{NA}'"
    acc = f"coalesce(CAST(`{accuracy_col}` AS STRING), {na})" if accuracy_col else na
    speed_txt = f"format_string('%.1f', {round_dec_sql('speed_kmh', 1)})"
    popup = f"format_string('{POPUP_FMT}', gps_id, vehicle_id, {speed_txt}, {acc}, {ts_text_sql('recorded_at')})"
    return pings.selectExpr(
        "gps_id", "vehicle_id",
        f"{ts_text_sql('recorded_at')} AS recorded_at",
        "latitude", "longitude",
        f"{popup} AS popup")
