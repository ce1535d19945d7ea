"""Ping validation and keep-first de-duplication.

Rules, in the order the warehouse loader applies them:
required fields present (gps_id, timestamp, latitude, longitude; NaN counts as
missing), a timestamp that parses, latitude in [-90, 90], longitude in [-180, 180], speed in [0, 200],
not at the null island (|lat| < 0.001 and |lon| < 0.001), then keep the first
row per (gps_id, timestamp text) in lake order (``src_file``, ``src_row``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.timeparts import parse_ts_sql
from roadlens.operators.joins import keep_first

REQUIRED = ("gps_id", "timestamp", "latitude", "longitude")
ORDER = ("src_file", "src_row")


def _missing_sql(c: str, dtype: str) -> str:
    if dtype in ("double", "float"):
        return f"({c} IS NULL OR isnan({c}))"
    return f"{c} IS NULL"


def _missing_any(df: DataFrame) -> str:
    types = dict(df.dtypes)
    return " OR ".join(_missing_sql(c, types.get(c, "string")) for c in REQUIRED)


def reject_reason_sql(df: DataFrame) -> str:
    """First failing rule of a ping, NULL when it passes all."""
    return (f"CASE WHEN {_missing_any(df)} THEN 'missing_field' "
            f"WHEN {parse_ts_sql('timestamp')} IS NULL THEN 'bad_timestamp' "
            "WHEN NOT latitude BETWEEN -90 AND 90 THEN 'latitude_range' "
            "WHEN NOT longitude BETWEEN -180 AND 180 THEN 'longitude_range' "
            "WHEN NOT coalesce(speed_kmh BETWEEN 0 AND 200, false) THEN 'speed_range' "
            "WHEN abs(latitude) < 0.001D AND abs(longitude) < 0.001D THEN 'null_island' END")


def reject_reason(df: DataFrame) -> Column:
    return F.expr(reject_reason_sql(df))


def passes_sql(df: DataFrame) -> str:
    """The rules as one conjunction (cheaper to evaluate than the reason chain).

    Equivalent to ``reject_reason(df) IS NULL``.
    """
    return (f"NOT ({_missing_any(df)}) AND {parse_ts_sql('timestamp')} IS NOT NULL AND latitude BETWEEN -90 AND 90 "
            "AND longitude BETWEEN -180 AND 180 AND speed_kmh BETWEEN 0 AND 200 "
            "AND NOT (abs(latitude) < 0.001D AND abs(longitude) < 0.001D)")


def passes(df: DataFrame) -> Column:
    return F.expr(passes_sql(df))


def valid(df: DataFrame) -> DataFrame:
    """Rows that pass every rule (a single filter, pushed to the scan)."""
    return df.filter(passes_sql(df))


def clean(df: DataFrame, key=("gps_id", "timestamp"), order=ORDER) -> DataFrame:
    """Validated pings, first copy per ``key`` in lake order."""
    return keep_first(valid(df), list(key), list(order))


def rejects(df: DataFrame, key=("gps_id", "timestamp"), order=ORDER) -> DataFrame:
    """Every input row that ``clean`` drops, with the reason.

    A valid row is dropped if its key's first row is another one, which takes a
    key with several rows. So only these keys are joined to the tagged input, with the
    place of their first row: the first aggregate carries places, no payload, and few of its
    rows reach the join, where AQE splits the input's side of a hot key. A row is
    known by key and order; one with a null among these is no key's first row.
    """
    tagged = df.selectExpr("*", f"{reject_reason_sql(df)} AS __reason")
    first = ", ".join(f"'n{i}', `{o}` IS NULL, 'o{i}', `{o}`" for i, o in enumerate(order))
    unplaced = " OR ".join(f"__first.n{i}" for i in range(len(order)))
    several = (valid(df).groupBy(*key).agg(F.expr(f"min(named_struct({first})) AS __first"), F.expr("count(1) AS __n"))
               .filter(f"__n > 1 OR {unplaced}").drop("__n"))
    unnamed = " OR ".join(f"`{k}` IS NULL" for k in key)
    is_first = " AND ".join(f"`{o}` = __first.o{i}" for i, o in enumerate(order))
    cols = [f"`{c}`" for c in df.columns]
    return (tagged.join(several, list(key), "left")
                  .filter(f"__reason IS NOT NULL OR {unnamed} OR (__first IS NOT NULL AND NOT coalesce({is_first}, false))")
                  .selectExpr(*cols, "coalesce(__reason, 'duplicate') AS reject_reason"))
