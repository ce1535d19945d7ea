"""Warehouse enrichment of clean pings and referential checks.

Derived columns (filled only where the payload leaves them NULL):
``recorded_at`` (text → instant), ``traffic_light_id`` (sentinel ``unknown``
→ NULL), ``vehicle_id`` (= gps_id), ``geom`` (point of lon/lat),
``time_id`` (hour in the time dimension), ``day_type`` (Saturday/Sunday →
weekend) and ``time_window`` (peak hours → peak_hour). All are row-local
column expressions, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.timeparts import day_type_sql, parse_ts_sql, time_window_sql
from roadlens.operators.joins import keep_first, small_side
from roadlens.sources import dimensions

WAREHOUSE_COLS = ["gps_id", "vehicle_id", "recorded_at", "latitude", "longitude", "geom",
                  "speed_kmh", "heading", "traffic_light_id", "day_type", "time_window", "time_id"]


def enrich(df: DataFrame, assume_tz: str = "UTC", unknown_light: str = "unknown") -> DataFrame:
    cols = set(df.columns)
    rec = "recorded_at" if "recorded_at" in cols else parse_ts_sql("timestamp", assume_tz)
    veh = "coalesce(vehicle_id, gps_id)" if "vehicle_id" in cols else "gps_id"
    light = unknown_light.replace("'", "''")
    out = df.withColumn("recorded_at", F.expr(rec))
    return out.selectExpr(
        "CAST(gps_id AS STRING) AS gps_id",
        f"{veh} AS vehicle_id",
        "recorded_at",
        "latitude", "longitude",
        f"{dimensions.point_sql('longitude', 'latitude')} AS geom",
        "speed_kmh",
        f"{'heading' if 'heading' in cols else 'CAST(NULL AS DOUBLE)'} AS heading",
        f"nullif(traffic_light_id, '{light}') AS traffic_light_id",
        f"coalesce(day_type, {day_type_sql('recorded_at')}) AS day_type",
        f"coalesce(time_window, {time_window_sql('recorded_at')}) AS time_window",
        f"{dimensions.time_id_sql('recorded_at')} AS time_id",
        *[c for c in ("src_file", "src_row") if c in cols],
    )


def to_warehouse(clean_pings: DataFrame, assume_tz: str = "UTC") -> DataFrame:
    """Enriched pings, first copy per (gps_id, recorded_at instant).

    Two timestamp texts of one instant collapse here, as the warehouse key
    does. Rows whose timestamp does not parse never get here: validation rejects
    them with a reason of their own. Applied to *validated* (not yet
    de-duplicated) pings this one keep-first equals the text-key dedupe
    followed by the instant-key one: equal texts are equal instants, and the
    first row of an instant group is also first in its text group. That saves
    a whole shuffle of the ping table.
    """
    return first_pings(enrich(clean_pings, assume_tz).filter("recorded_at IS NOT NULL"), ["src_file", "src_row"])


def first_pings(enriched: DataFrame, order: Sequence[str], only: str = "true") -> DataFrame:
    """The first of the enriched pings of each (gps_id, recorded_at) by ``order``, as warehouse rows, if it satisfies ``only``.

    The point and the time id are functions of the columns beside them: they do
    not cross the shuffle but are made again after it.
    """
    derived = {"geom": dimensions.point_sql("longitude", "latitude"), "time_id": dimensions.time_id_sql("recorded_at")}
    kept = keep_first(enriched.drop(*derived), ["gps_id", "recorded_at"], list(order)).filter(only)
    return kept.selectExpr(*[f"{derived[c]} AS {c}" if c in derived else c for c in WAREHOUSE_COLS])


def flag_known_lights(pings: DataFrame, lights: DataFrame) -> DataFrame:
    """Add ``light_known``: NULL light or a light of the dimension.

    One broadcast left join against the (bounded) light dimension, so the ping
    side is scanned once whether the caller keeps the known or the unknown part.
    """
    dim = small_side(lights.selectExpr("traffic_light_id", "true AS __in_dim"))
    return (pings.join(dim, "traffic_light_id", "left")
                 .selectExpr("*", "traffic_light_id IS NULL OR coalesce(__in_dim, false) AS light_known")
                 .drop("__in_dim"))


def quarantine_unknown_lights(pings: DataFrame, lights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split pings into (known or no light, unknown light)."""
    f = flag_known_lights(pings, lights)
    return (f.filter("light_known").drop("light_known"),
            f.filter("NOT light_known").drop("light_known"))


def attach_time(pings: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Lookup join of each ping's hour against the time dimension (bounded, broadcast)."""
    td = small_side(time_dim.select(F.col("full_timestamp").alias("__hour"),
                                    F.col("time_id").alias("dim_time_id"),
                                    F.col("season"), F.col("is_weekend")))
    return (pings.withColumn("__hour", F.date_trunc("hour", "recorded_at"))
                 .join(td, "__hour", "left").drop("__hour"))


def with_light_info(df: DataFrame, lights: DataFrame, inters: DataFrame) -> DataFrame:
    """Light ↔ intersection enrichment (broadcast left joins on tiny dims)."""
    li = small_side(lights.select("traffic_light_id", "intersection_id",
                                  F.col("latitude").alias("light_latitude"),
                                  F.col("longitude").alias("light_longitude")))
    it = small_side(inters.select("intersection_id", "intersection_name", "description"))
    return df.join(li, "traffic_light_id", "left").join(it, "intersection_id", "left")
