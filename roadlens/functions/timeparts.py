"""Expressions over instants: day type, time window, season, parts.

Each rule is written once as Spark SQL expression text (``*_sql``, taking a
column name or expression text) and exposed as a :class:`Column` through
``F.expr``. A SQL text costs one call into the JVM, where the same rule built
from ``F.*`` column objects costs one call per node; the expressions are the
same built-ins either way and stay inside whole-stage codegen. The session
time zone is UTC (see ``roadlens.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlens.sources.seeds import PEAK_HOURS

_PEAK = ", ".join(str(h) for h in PEAK_HOURS)


def dow0_sql(ts: str) -> str:
    """Day of week with 0 = Sunday … 6 = Saturday."""
    return f"(dayofweek({ts}) - 1)"


def day_type_sql(ts: str) -> str:
    """``weekend`` on Saturday and Sunday, else ``weekday``."""
    return f"(CASE WHEN dayofweek({ts}) IN (1, 7) THEN 'weekend' ELSE 'weekday' END)"


def time_window_sql(ts: str) -> str:
    """``peak_hour`` for hours 6-8 and 16-19, else ``off_peak``."""
    return f"(CASE WHEN hour({ts}) IN ({_PEAK}) THEN 'peak_hour' ELSE 'off_peak' END)"


def season_sql(ts: str) -> str:
    return (f"(CASE WHEN month({ts}) IN (3, 4, 5) THEN 'spring' WHEN month({ts}) IN (6, 7, 8) THEN 'summer' "
            f"WHEN month({ts}) IN (9, 10, 11) THEN 'autumn' ELSE 'winter' END)")


def seconds_of_day_sql(ts: str) -> str:
    """Time of day of an instant in seconds since midnight, with its microseconds."""
    return f"(CAST(pmod(unix_micros({ts}), 86400000000) AS DOUBLE) / 1000000)"


def ts_text_sql(ts: str) -> str:
    """Instant as ``yyyy-MM-dd HH:mm:ss`` text (stable across engines)."""
    return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')"


def parse_ts_sql(text: str, assume_tz: str = "UTC") -> str:
    """Text → instant; unparsable text becomes NULL instead of failing.

    Accepts ``yyyy-MM-dd HH:mm:ss``, ISO with ``T`` and with or without an
    offset. Zone-less text is read in ``assume_tz``.
    """
    parsed = f"try_cast({text} AS TIMESTAMP)"
    if assume_tz and assume_tz.upper() != "UTC":
        tz = assume_tz.replace("'", "")
        return (f"(CASE WHEN {text} RLIKE '(Z|[+-]\\\\d{{2}}:?\\\\d{{2}})$' THEN {parsed} "
                f"ELSE to_utc_timestamp({parsed}, '{tz}') END)")
    return parsed


def dow0(ts: str) -> Column:
    return F.expr(dow0_sql(ts))


def day_type_of(ts: str) -> Column:
    return F.expr(day_type_sql(ts))


def time_window_of(ts: str) -> Column:
    return F.expr(time_window_sql(ts))


def season_of(ts: str) -> Column:
    return F.expr(season_sql(ts))


def seconds_of_day(ts: str) -> Column:
    return F.expr(seconds_of_day_sql(ts))


def ts_text(ts: str) -> Column:
    return F.expr(ts_text_sql(ts))


def parse_ts(text: str, assume_tz: str = "UTC") -> Column:
    return F.expr(parse_ts_sql(text, assume_tz))
