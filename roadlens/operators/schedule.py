"""Time-of-day schedule lookup (interval join against the light schedule).

``mode="strict"`` keeps the warehouse query's behaviour: ``tod BETWEEN start
AND end`` closed at both ends, so a boundary instant (09:00:00) matches two
rows and an overnight row (20:00 → 06:00, start > end) never matches.
``mode="wrap"`` is half-open ``[start, end)`` with midnight wrap-around.

A small schedule (as the seed table's 22 rows) is broadcast; the join has
equi keys (light, applicable days) plus the interval condition, so Spark plans
a broadcast hash join with a residual filter, no shuffle of the big side.

A schedule beyond the broadcast bound is joined by bins instead: each of its rows is
listed under the bins of the day that its interval touches, and every ping asks
its own bin only, with the interval tested exactly after. Pings of one light,
day type and bin are dealt over ``SALTS`` salts, the schedule's few rows are repeated for each,
so a light with a large share of all pings is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.operators.joins import BROADCAST_MAX_BYTES, plan_size_bytes


def interval_match_sql(tod: str, start: str, end: str, mode: str = "strict") -> str:
    if mode == "strict":
        return f"({tod} BETWEEN {start} AND {end})"
    if mode == "wrap":
        return (f"(CASE WHEN {start} <= {end} THEN {tod} >= {start} AND {tod} < {end} "
                f"ELSE {tod} >= {start} OR {tod} < {end} END)")
    raise ValueError(f"unknown schedule mode {mode!r}")


def interval_match(tod: str, start: str, end: str, mode: str = "strict") -> Column:
    return F.expr(interval_match_sql(tod, start, end, mode))


BIN_SECONDS = 900
SALTS = 16


def _bins_sql(mode: str) -> str:
    """Numbers of the bins that hold an instant of the interval, those of its ends included."""
    span = lambda a, b: f"sequence({a} div {BIN_SECONDS}, {b} div {BIN_SECONDS})"
    last = 86_400 - 1
    over = "array()" if mode == "strict" else f"array_union({span('__s_start', last)}, {span('0', '__s_end')})"
    return f"CASE WHEN __s_start <= __s_end THEN {span('__s_start', f'least(__s_end, {last})')} ELSE {over} END"


def lookup_red(df: DataFrame, schedule: DataFrame, tod_col: str, day_col: str = "day_type",
               mode: str = "strict", light_col: str = "traffic_light_id", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left join each row to the schedule rows active at ``tod_col`` seconds.

    Adds ``scheduled_red_duration`` (NULL when none matches). A row matching
    two schedule rows comes out twice, as in the reference query. Times of day are in [0, 86400).
    """
    s = schedule.selectExpr(
        "traffic_light_id AS __s_light", "applicable_days AS __s_days", "CAST(start_sec AS INT) AS __s_start",
        "CAST(end_sec AS INT) AS __s_end", "CAST(red_duration AS INT) AS scheduled_red_duration")
    cond = (f"`{light_col}` = __s_light AND `{day_col}` = __s_days AND "
            + interval_match_sql(f"`{tod_col}`", "__s_start", "__s_end", mode))
    helpers = ["__s_light", "__s_days", "__s_start", "__s_end"]
    if plan_size_bytes(s) <= max_bytes:
        return df.join(F.broadcast(s), F.expr(cond), "left").drop(*helpers)
    binned = (s.selectExpr("*", f"explode({_bins_sql(mode)}) AS __s_bin")
              .selectExpr("*", f"explode(sequence(0, {SALTS - 1})) AS __s_salt"))
    asked = df.withColumn("__bin", F.expr(f"CAST(floor(`{tod_col}` / {BIN_SECONDS}) AS INT)")).withColumn(
        "__salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    return (asked.join(binned, F.expr(cond + " AND __bin = __s_bin AND __salt = __s_salt"), "left")
            .drop(*helpers, "__bin", "__salt", "__s_bin", "__s_salt"))
