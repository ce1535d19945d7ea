"""Congestion verdicts per traffic light.

Statistics per (light, time_window, day_type): mean speed and distinct
vehicles; indicators from ``roadlens.functions.congestion``; the red duration
active at the analysis time; then one verdict per (light, analysis_time).

Two time frames share one code path:

* :func:`snapshot` — the warehouse job's exact frame for one ``as_of``:
  pings with ``recorded_at > as_of - 5 min`` (no upper bound unless
  ``bound_above``), analysis time ``as_of``.
* :func:`windowed` — event-time windows ``[start, end)`` (tumbling or
  hopping), each evaluated as if ``as_of`` were the window end. This is the
  batch back-fill and the Structured Streaming form.

Scale: sums + ``count_distinct`` are planned by Catalyst as a two-level
aggregation (group keys + vehicle, then group keys), both levels with
map-side partial aggregation, so a light carrying a third of all pings is
pre-reduced in every task. Dimensions are broadcast with a static bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.congestion import indicator_sql
from roadlens.functions.timeparts import seconds_of_day_sql, ts_text_sql
from roadlens.operators.joins import keep_first
from roadlens.operators.schedule import lookup_red
from roadlens.sources import dimensions, seeds

VERDICT_COLS = ["traffic_light_id", "analysis_time", "time_id", "time_window", "day_type",
                "avg_speed_kmh", "vehicle_count", "congestion_level", "congestion_label",
                "avg_waiting_time", "queue_length", "scheduled_red_duration", "is_inefficient"]

GROUP = ["traffic_light_id", "time_window", "day_type"]


# Speeds are summed as DECIMAL: the sum, and so the mean that is held against
# the thresholds, does not depend on the order in which tasks are merged.
SPEED_DEC = "CAST(speed_kmh AS DECIMAL(18,6))"


def _mean(total: str, n: str) -> str:
    return f"CAST({total} AS DOUBLE) / {n}"


def group_stats(pings: DataFrame, extra_keys=(), vehicle_col: str = "gps_id") -> DataFrame:
    """Mean speed and COUNT(DISTINCT vehicle) per light/time_window/day_type."""
    return (pings.filter("traffic_light_id IS NOT NULL")
                 .groupBy(*extra_keys, *GROUP)
                 .agg(F.expr(f"sum({SPEED_DEC}) AS __sum"), F.expr("count(speed_kmh) AS __n"),
                      F.expr(f"count(DISTINCT `{vehicle_col}`) AS veh_count"))
                 .withColumn("avg_speed", F.expr(_mean("__sum", "__n"))).drop("__sum", "__n"))


def sketched_stats(pings: DataFrame, minutes: int, slide: int, vehicle_col: str = "gps_id", lg_k: int = 12) -> DataFrame:
    """:func:`pane_stats` with estimated numbers of vehicles, for windows with very many of them.

    Every pane has one sketch per group, and a window merges the sketches of its
    panes, so no vehicle is copied and a row's size is bounded. The relative
    standard error is about 1.04 / sqrt(2 ** lg_k): 1.6 % at the default, and none for a few vehicles.
    """
    panes = (pings.filter("traffic_light_id IS NOT NULL")
             .groupBy(F.window("recorded_at", f"{slide} minutes").alias("__p"), *GROUP)
             .agg(F.expr(f"sum({SPEED_DEC}) AS __sum"), F.expr("count(speed_kmh) AS __n"), F.hll_sketch_agg(vehicle_col, lg_k).alias("__s")))
    ends = panes.selectExpr(*GROUP, "__s", "__sum", "__n", "explode(sequence(__p.end, __p.end + "
                            f"INTERVAL {minutes - slide} MINUTES, INTERVAL {slide} MINUTES)) AS analysis_ts")
    return (ends.groupBy("analysis_ts", *GROUP)
            .agg(F.expr("sum(__sum) AS __sum"), F.expr("sum(__n) AS __n"), F.hll_union_agg("__s").alias("__s"))
            .selectExpr("analysis_ts", *GROUP, "hll_sketch_estimate(__s) AS veh_count", f"{_mean('__sum', '__n')} AS avg_speed"))


# Panes of a block, at least; a block's first windows need the panes before it, which are copied to it.
BLOCK_PANES = 60


def vehicle_panes(pings: DataFrame, slide: int, vehicle_col: str = "gps_id") -> DataFrame:
    """Pings with a light reduced to one row per vehicle, group and pane of ``slide`` minutes (number ``__p``): sum and count of speeds."""
    return (pane_rows(pings, slide, vehicle_col).groupBy("__p", *GROUP, vehicle_col)
            .agg(F.expr("sum(__speed) AS __sum"), F.expr("count(__speed) AS __n")))


def pane_rows(pings: DataFrame, slide: int, vehicle_col: str = "gps_id") -> DataFrame:
    """Pings with a light as rows of their pane, the number of whole ``slide`` minutes before them."""
    us = slide * 60_000_000
    return (pings.filter("traffic_light_id IS NOT NULL AND recorded_at IS NOT NULL")
            .selectExpr(f"(unix_micros(recorded_at) - pmod(unix_micros(recorded_at), {us})) div {us} AS __p", *GROUP, f"`{vehicle_col}`",
                        f"{SPEED_DEC} AS __speed", "unix_micros(recorded_at) AS __at"))


def slide_panes(panes: DataFrame, minutes: int, slide: int, vehicle_col: str = "gps_id") -> DataFrame:
    """Statistics of sliding windows, keyed by the window end ``analysis_ts``, from :func:`vehicle_panes`.

    A vehicle is counted for a window by its first pane in it: a pane that comes ``d`` panes after the vehicle's last one is
    the first of the ``d`` latest windows that cover it. So the windows are never listed per vehicle: a vehicle's rows are
    brought together once, by blocks of panes, and only sums and counts per group, pane and ``d`` are copied to the windows.
    Several rows of one vehicle and pane are counted once.
    """
    n = minutes // slide
    block = max(BLOCK_PANES, 10 * n)
    of = lambda p: f"({p} - pmod({p}, {block})) div {block}"
    own = Window.partitionBy("__b", *GROUP, vehicle_col).orderBy("__p")
    first = (panes.selectExpr(*GROUP, f"`{vehicle_col}`", "__p", "__sum", "__n", f"explode(sequence({of('__p')}, {of(f'(__p + {n - 1})')})) AS __b")
             .withColumn("__d", F.least(F.lit(n), F.coalesce(F.col("__p") - F.lag("__p").over(own), F.lit(n))))
             .filter(f"__b = {of('__p')}"))
    groups = (first.groupBy("__p", *GROUP, "__d")
              .agg(F.expr("sum(__sum) AS __sum"), F.expr("sum(__n) AS __n"), F.expr(f"count(`{vehicle_col}`) AS __c")))
    ends = groups.selectExpr("*", f"explode(sequence(0, {n - 1})) AS __i").selectExpr(
        *GROUP, "__p + __i AS __e", "__sum", "__n", f"CASE WHEN __i >= {n} - __d THEN __c ELSE 0 END AS __c")
    return (ends.groupBy("__e", *GROUP)
            .agg(F.expr("sum(__sum) AS __sum"), F.expr("sum(__n) AS __n"), F.expr("sum(__c) AS veh_count"))
            .selectExpr(f"timestamp_micros((__e + 1) * {slide * 60_000_000}) AS analysis_ts", *GROUP, "veh_count", f"{_mean('__sum', '__n')} AS avg_speed"))


def pane_stats(pings: DataFrame, minutes: int, slide: int, vehicle_col: str = "gps_id") -> DataFrame:
    """:func:`group_stats` of sliding windows, keyed by the window end ``analysis_ts``.

    Pings are first reduced to one row per vehicle and pane of ``slide`` minutes; no
    vehicle's row is copied to the windows that cover its pane (:func:`slide_panes`).
    """
    return slide_panes(vehicle_panes(pings, slide, vehicle_col), minutes, slide, vehicle_col)


def run_stats(pings: DataFrame, last_run: str, minutes: int = 5, every: int = 1, received: str = "received_at",
              vehicle_col: str = "gps_id") -> DataFrame:
    """:func:`group_stats` of every run of a recurring job, as that run saw the data, keyed by the run's instant ``analysis_ts``.

    The run at a whole ``every`` minutes sees the pings received by then and recorded less
    than ``minutes`` minutes before (no upper bound: pings stamped in the future count until their time is over). A ping that is
    received late is missing from earlier runs, which are never revised. ``last_run`` is SQL text of the last run's instant.

    Pings are first reduced to one row per vehicle and the same first and last run; only these are copied to the runs.
    """
    step = every * 60_000_000
    first = f"unix_micros({received}) + pmod(-unix_micros({received}), {step})"
    # the last run strictly before recorded_at + minutes
    over = f"unix_micros(recorded_at) + {minutes * 60_000_000} - 1"
    last = f"least(({over}) - pmod({over}, {step}), unix_micros({last_run}))"
    seen = (pings.filter("traffic_light_id IS NOT NULL").selectExpr(*GROUP, f"`{vehicle_col}`", "speed_kmh", f"{first} AS __a", f"{last} AS __b")
            .filter("__a <= __b").groupBy("__a", "__b", *GROUP, vehicle_col)
            .agg(F.expr(f"sum({SPEED_DEC}) AS __sum"), F.expr("count(speed_kmh) AS __n")))
    runs = seen.selectExpr(*GROUP, f"`{vehicle_col}`", "__sum", "__n", f"explode(sequence(__a, __b, {step})) AS __run")
    return (runs.groupBy("__run", *GROUP)
            .agg(F.expr("sum(__sum) AS __sum"), F.expr("sum(__n) AS __n"), F.expr(f"count(DISTINCT `{vehicle_col}`) AS veh_count"))
            .selectExpr(*GROUP, "timestamp_micros(__run) AS analysis_ts", f"{_mean('__sum', '__n')} AS avg_speed", "veh_count"))


def as_run(pings: DataFrame, schedule: DataFrame, last_run: str, minutes: int = 5, every: int = 1, mode: str = "strict", **kw) -> DataFrame:
    """The verdicts that a job running every ``every`` minutes has stored (see :func:`run_stats`)."""
    return verdicts(run_stats(pings, last_run, minutes, every, **kw), schedule, "analysis_ts", mode)


def verdicts(stats: DataFrame, schedule: DataFrame, as_of_col: str = "analysis_ts",
             mode: str = "strict", congested: float = seeds.SPEED_CONGESTED_KMH,
             slow: float = seeds.SPEED_SLOW_KMH, collapse: bool = True) -> DataFrame:
    """Indicators + schedule + time id, one verdict per (light, analysis time).

    ``collapse`` keeps one row when several (time_window, day_type) groups or a
    doubled schedule match share a light and analysis time. The kept row is
    deterministic: most vehicles, then time_window, day_type and red duration
    ascending, NULLs last.
    """
    s = stats.selectExpr("*", f"{seconds_of_day_sql(as_of_col)} AS __tod")
    s = lookup_red(s, schedule, "__tod", "day_type", mode)
    ind = indicator_sql("avg_speed", "veh_count", congested, slow)
    out = s.selectExpr(
        "traffic_light_id",
        f"`{as_of_col}` AS __as_of",
        f"{dimensions.time_id_sql(as_of_col)} AS time_id",
        "time_window", "day_type",
        *[f"{c} AS {n}" for n, c in ind.items()],
        "scheduled_red_duration",
    )
    if collapse:
        out = keep_first(out, ["traffic_light_id", "__as_of"],
                         ["-vehicle_count", "time_window", "day_type", "scheduled_red_duration"])
    return out.selectExpr(*[f"{ts_text_sql('__as_of')} AS analysis_time" if c == "analysis_time" else c
                            for c in VERDICT_COLS])


def snapshot(pings: DataFrame, schedule: DataFrame, as_of: str, minutes: int = 5,
             bound_above: bool = False, mode: str = "strict", collapse: bool = True,
             **kw) -> DataFrame:
    """Verdicts for one analysis instant ``as_of`` (text, UTC)."""
    t = f"to_timestamp('{as_of}')"
    recent = pings.filter(f"recorded_at > {t} - INTERVAL {int(minutes)} MINUTES")
    if bound_above:
        recent = recent.filter(f"recorded_at <= {t}")
    stats = group_stats(recent).selectExpr("*", f"{t} AS analysis_ts")
    return verdicts(stats, schedule, "analysis_ts", mode, collapse=collapse, **kw)


def windowed(pings: DataFrame, schedule: DataFrame, minutes: int = 5,
             slide: int | None = None, mode: str = "strict", collapse: bool = True,
             sketch_lg_k: int | None = None, **kw) -> DataFrame:
    """Verdicts per event-time window of ``minutes`` (every ``slide`` minutes), analysis time = window end.

    Vehicles are counted exactly unless ``sketch_lg_k`` asks for sketches (:func:`sketched_stats`).
    """
    if sketch_lg_k:
        return verdicts(sketched_stats(pings, minutes, slide or minutes, lg_k=sketch_lg_k), schedule, "analysis_ts", mode, collapse=collapse, **kw)
    if slide:
        return verdicts(pane_stats(pings, minutes, slide), schedule, "analysis_ts", mode, collapse=collapse, **kw)
    w = F.window("recorded_at", f"{minutes} minutes")
    stats = (group_stats(pings.withColumn("__w", w), extra_keys=["__w"])
             .selectExpr("*", "__w.end AS analysis_ts").drop("__w"))
    return verdicts(stats, schedule, "analysis_ts", mode, collapse=collapse, **kw)
