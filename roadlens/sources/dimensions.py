"""Dimension tables: intersections, traffic lights, light schedule, time.

All four have a size fixed by their definition (5, 5, 22 and 26 280 rows), so
they are safe broadcast sides.
Each builder has a SQL twin used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.timeparts import day_type_sql, dow0_sql, season_sql, time_window_sql
from roadlens.sources import seeds

# Largest dimension we ever broadcast (the hourly time dimension).

INTERSECTION_COLS = ["intersection_id", "intersection_name", "latitude", "longitude", "description"]
LIGHT_COLS = ["traffic_light_id", "intersection_id", "intersection_name", "latitude", "longitude",
              "direction_degree", "default_green", "default_yellow", "default_red", "is_adaptive"]
SCHEDULE_COLS = ["schedule_id", "traffic_light_id", "start_sec", "end_sec", "green_duration",
                 "yellow_duration", "red_duration", "applicable_days", "control_mode"]


def point_sql(lon: str, lat: str) -> str:
    """Point geometry (SRID 4326) kept as a plain struct."""
    return f"named_struct('lon', {lon}, 'lat', {lat}, 'srid', 4326)"


def point(lon: str, lat: str) -> F.Column:
    return F.expr(point_sql(lon, lat))


def _typed_sql(values_sql: str, columns: list[str], types: dict, extra: str = "") -> str:
    cols = ", ".join(f"CAST({c} AS {types[c]}) AS {c}" if c in types else c for c in columns)
    return f"SELECT {cols}{extra} FROM {values_sql}"


def intersections(spark: SparkSession) -> DataFrame:
    """5 seeded intersections (inline table: a local scan, no job)."""
    return spark.sql(_typed_sql(
        seeds.sql_values(seeds.INTERSECTIONS, INTERSECTION_COLS), INTERSECTION_COLS,
        {"intersection_id": "int", "latitude": "double", "longitude": "double"},
        f", {point_sql('CAST(longitude AS DOUBLE)', 'CAST(latitude AS DOUBLE)')} AS geom"))


def traffic_lights(spark: SparkSession) -> DataFrame:
    """5 seeded traffic lights."""
    return spark.sql(_typed_sql(
        seeds.sql_values(seeds.TRAFFIC_LIGHTS, LIGHT_COLS), LIGHT_COLS, {
            "intersection_id": "int", "latitude": "double", "longitude": "double",
            "direction_degree": "smallint", "default_green": "smallint", "default_yellow": "smallint",
            "default_red": "smallint", "is_adaptive": "boolean"},
        f", {point_sql('CAST(longitude AS DOUBLE)', 'CAST(latitude AS DOUBLE)')} AS geom, "
        "true AS active_status"))


def light_schedule(spark: SparkSession) -> DataFrame:
    """22 seeded schedule rows; TIME of day kept as seconds (start_sec, end_sec)."""
    return spark.sql(_typed_sql(
        seeds.sql_values(seeds.schedule_rows(), SCHEDULE_COLS), SCHEDULE_COLS, {
            "schedule_id": "int", "start_sec": "int", "end_sec": "int", "green_duration": "smallint",
            "yellow_duration": "smallint", "red_duration": "smallint"}))


def time_dimension(spark: SparkSession) -> DataFrame:
    """Hourly time dimension, one row per hour of 2025-2027 (26 280 rows).

    Generated with ``spark.range`` (a distributed generator), ids follow the
    hour order from 1 like a SERIAL filled in timestamp order.
    """
    ts = "full_timestamp"
    return (spark.range(seeds.TIME_DIM_HOURS)
            .selectExpr("CAST(id + 1 AS INT) AS time_id",
                        f"timestampadd(HOUR, id, TIMESTAMP '{seeds.TIME_DIM_START}') AS full_timestamp")
            .selectExpr(
                "time_id", ts,
                f"to_date({ts}) AS date_val",
                f"CAST(year({ts}) AS SMALLINT) AS year",
                f"CAST(month({ts}) AS SMALLINT) AS month",
                f"CAST(dayofmonth({ts}) AS SMALLINT) AS day",
                f"CAST(hour({ts}) AS SMALLINT) AS hour",
                "CAST(0 AS SMALLINT) AS minute",
                f"CAST({dow0_sql(ts)} AS SMALLINT) AS day_of_week",
                f"CAST(weekofyear({ts}) AS SMALLINT) AS week_of_year",
                f"CAST(quarter({ts}) AS SMALLINT) AS quarter",
                f"dayofweek({ts}) IN (1, 7) AS is_weekend",
                "false AS is_holiday",
                f"{day_type_sql(ts)} AS day_type",
                f"{time_window_sql(ts)} AS time_window",
                f"{season_sql(ts)} AS season",
            ))


def time_id_sql(ts: str) -> str:
    """time_id of the hour holding ``ts``; NULL outside the dimension.

    Equals the lookup join on (date, hour) against :func:`time_dimension`
    because the dimension is dense and hourly from its start; computing it
    avoids a join per ping.
    """
    hours = (f"(CAST(floor((unix_timestamp({ts}) - unix_timestamp(TIMESTAMP '{seeds.TIME_DIM_START}'))"
             f" / 3600) AS BIGINT) + 1)")
    return f"(CASE WHEN {hours} BETWEEN 1 AND {seeds.TIME_DIM_HOURS} THEN CAST({hours} AS INT) END)"


def time_id_of(ts: str) -> F.Column:
    return F.expr(time_id_sql(ts))


# --------------------------------------------------------------------------- SQL twins

def sql_intersections() -> str:
    return "SELECT * FROM " + seeds.sql_values(seeds.INTERSECTIONS, INTERSECTION_COLS)


def sql_traffic_lights() -> str:
    return "SELECT * FROM " + seeds.sql_values(seeds.TRAFFIC_LIGHTS, LIGHT_COLS)


def sql_light_schedule() -> str:
    return "SELECT * FROM " + seeds.sql_values(seeds.schedule_rows(), SCHEDULE_COLS)


def sql_time_dimension() -> str:
    peak = ", ".join(str(h) for h in seeds.PEAK_HOURS)
    return f"""
    SELECT CAST(row_number() OVER (ORDER BY ts) AS INTEGER) AS time_id,
           ts AS full_timestamp, CAST(ts AS DATE) AS date_val,
           CAST(year(ts) AS SMALLINT) AS year, CAST(month(ts) AS SMALLINT) AS month,
           CAST(day(ts) AS SMALLINT) AS day, CAST(hour(ts) AS SMALLINT) AS hour,
           CAST(0 AS SMALLINT) AS minute, CAST(dayofweek(ts) AS SMALLINT) AS day_of_week,
           CAST(weekofyear(ts) AS SMALLINT) AS week_of_year, CAST(quarter(ts) AS SMALLINT) AS quarter,
           dayofweek(ts) IN (0, 6) AS is_weekend, FALSE AS is_holiday,
           CASE WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type,
           CASE WHEN hour(ts) IN ({peak}) THEN 'peak_hour' ELSE 'off_peak' END AS time_window,
           CASE WHEN month(ts) IN (3,4,5) THEN 'spring' WHEN month(ts) IN (6,7,8) THEN 'summer'
                WHEN month(ts) IN (9,10,11) THEN 'autumn' ELSE 'winter' END AS season
    FROM generate_series(TIMESTAMP '{seeds.TIME_DIM_START}', TIMESTAMP '{seeds.TIME_DIM_END}',
                         INTERVAL 1 HOUR) AS g(ts)
    """
