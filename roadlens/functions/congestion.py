"""Congestion indicators over (avg speed, vehicle count).

``avg`` is the unrounded mean speed of a group and ``n`` its distinct vehicle
count (column names or SQL expression text). Rounding goes through DECIMAL so
that the result is half-away-from-zero on the decimal value, identical to a
SQL NUMERIC round. Each rule is Spark SQL expression text (``*_sql``); the
Column forms wrap it in ``F.expr`` (one JVM call per rule).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlens.sources.seeds import (LABEL_CONGESTED, LABEL_FREE, LABEL_SLOW,
                                    SPEED_CONGESTED_KMH, SPEED_SLOW_KMH)

DEC = "decimal(28,12)"


def _num(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def round_dec_sql(x: str, scale: int) -> str:
    """ROUND through DECIMAL(28,12), returned as DOUBLE."""
    return f"CAST(round(CAST({x} AS {DEC}), {int(scale)}) AS DOUBLE)"


def round_dec(x: str | Column, scale: int) -> Column:
    if isinstance(x, Column):
        return F.round(x.cast(DEC), scale).cast("double")
    return F.expr(round_dec_sql(x, scale))


def avg_speed_kmh_sql(avg: str) -> str:
    return round_dec_sql(avg, 2)


def congestion_level_sql(avg: str) -> str:
    """0..100: 100 at a standstill, 0 from 50 km/h up, linear between."""
    raw = (f"CASE WHEN {avg} <= 0 THEN 100.0D WHEN {avg} >= 50 THEN 0.0D "
           f"ELSE (1.0D - {avg} / 50.0D) * 100.0D END")
    return round_dec_sql(f"greatest(0.0D, least(100.0D, {raw}))", 1)


def congestion_label_sql(avg: str, congested: float = SPEED_CONGESTED_KMH,
                         slow: float = SPEED_SLOW_KMH) -> str:
    return (f"CASE WHEN {avg} < {_num(congested)} THEN '{LABEL_CONGESTED}' "
            f"WHEN {avg} < {_num(slow)} THEN '{LABEL_SLOW}' ELSE '{LABEL_FREE}' END")


def avg_waiting_time_sql(avg: str, congested: float = SPEED_CONGESTED_KMH,
                         slow: float = SPEED_SLOW_KMH) -> str:
    return (f"CASE WHEN {avg} < 1 THEN 120.0D WHEN {avg} < {_num(congested)} THEN 60.0D "
            f"WHEN {avg} < {_num(slow)} THEN 20.0D ELSE 5.0D END")


def queue_length_sql(avg: str, n: str, congested: float = SPEED_CONGESTED_KMH) -> str:
    """max(0, (c - avg) / nullif(c, 0) * n), rounded to 6 places."""
    c = _num(congested)
    return round_dec_sql(f"greatest(0.0D, ({c} - {avg}) / nullif({c}, 0.0D) * {n})", 6)


def is_inefficient_sql(avg: str, n: str) -> str:
    """At least 3 vehicles crawling below 5 km/h."""
    return f"coalesce({n} >= 3 AND {avg} < 5.0D, false)"


def indicator_sql(avg: str = "avg_speed", n: str = "veh_count",
                  congested: float = SPEED_CONGESTED_KMH,
                  slow: float = SPEED_SLOW_KMH) -> dict[str, str]:
    """All verdict indicators as SQL text, keyed by output column name."""
    return {
        "avg_speed_kmh": avg_speed_kmh_sql(avg),
        "vehicle_count": f"CAST({n} AS INT)",
        "congestion_level": congestion_level_sql(avg),
        "congestion_label": congestion_label_sql(avg, congested, slow),
        "avg_waiting_time": avg_waiting_time_sql(avg, congested, slow),
        "queue_length": queue_length_sql(avg, n, congested),
        "is_inefficient": is_inefficient_sql(avg, n),
    }


def indicator_columns(avg: str = "avg_speed", n: str = "veh_count",
                      congested: float = SPEED_CONGESTED_KMH,
                      slow: float = SPEED_SLOW_KMH) -> dict[str, Column]:
    """All verdict indicators as Columns, keyed by output column name."""
    return {k: F.expr(v) for k, v in indicator_sql(avg, n, congested, slow).items()}
