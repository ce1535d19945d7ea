"""SQL twins of the Spark stages, for the DuckDB oracle.

Each helper returns SQL text over the pre-registered ``events`` view. They are
written independently from the DataFrame code (window functions where the
Spark side uses aggregates) so that agreement is a real check.
"""

from __future__ import annotations

from roadlens.sources import dimensions, seeds
from roadlens.sources.fixtures import sql_gps_raw

PEAK = ", ".join(str(h) for h in seeds.PEAK_HOURS)


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def tod(expr: str) -> str:
    return f"(CAST(microsecond({expr}) + 1000000 * (60 * minute({expr}) + 3600 * hour({expr})) AS DOUBLE) / 1000000)"


def time_id(expr: str) -> str:
    h = (f"(CAST(floor(epoch({expr}) - epoch(TIMESTAMP '{seeds.TIME_DIM_START}')) AS BIGINT)"
         f" // 3600 + 1)")
    return f"(CASE WHEN {h} BETWEEN 1 AND {seeds.TIME_DIM_HOURS} THEN CAST({h} AS INTEGER) END)"


def dec_round(expr: str, scale: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,12)), {scale}) AS DOUBLE)"


def instant(text: str) -> str:
    """Text to UTC instant; the one offset that occurs is taken off by hand, so no session zone plays a part."""
    return (f"CASE WHEN {text} LIKE '%+07:00' THEN try_cast(replace({text}, '+07:00', '') AS TIMESTAMP) - INTERVAL 7 HOURS "
            f"ELSE try_cast({text} AS TIMESTAMP) END")


VALID_PRED = """gps_id IS NOT NULL AND timestamp IS NOT NULL AND try_cast(timestamp AS TIMESTAMP) IS NOT NULL
        AND latitude IS NOT NULL AND NOT isnan(latitude)
        AND longitude IS NOT NULL AND NOT isnan(longitude)
        AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
        AND speed_kmh BETWEEN 0 AND 200
        AND NOT (abs(latitude) < 0.001 AND abs(longitude) < 0.001)"""


def ctes() -> str:
    """WITH-list: raw → valid → clean (text key) → wh (enriched, instant key) → known."""
    return f"""
raw AS ({sql_gps_raw()}),
lights AS ({dimensions.sql_traffic_lights()}),
inters AS ({dimensions.sql_intersections()}),
sched AS ({dimensions.sql_light_schedule()}),
valid AS (SELECT * FROM raw WHERE {VALID_PRED}),
clean AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY gps_id, timestamp ORDER BY src_file, src_row) AS rn
        FROM valid) WHERE rn = 1),
enr AS (
    SELECT gps_id, gps_id AS vehicle_id, {instant('timestamp')} AS recorded_at,
           latitude, longitude, speed_kmh, CAST(NULL AS DOUBLE) AS heading,
           NULLIF(traffic_light_id, 'unknown') AS traffic_light_id,
           day_type AS p_day_type, time_window AS p_time_window, src_file, src_row
    FROM clean),
wh_all AS (
    SELECT gps_id, vehicle_id, recorded_at, latitude, longitude, speed_kmh, heading, traffic_light_id,
           COALESCE(p_day_type, CASE WHEN dayofweek(recorded_at) IN (0, 6) THEN 'weekend' ELSE 'weekday' END) AS day_type,
           COALESCE(p_time_window, CASE WHEN hour(recorded_at) IN ({PEAK}) THEN 'peak_hour' ELSE 'off_peak' END) AS time_window,
           {time_id('recorded_at')} AS time_id, src_file, src_row
    FROM (
        SELECT *, row_number() OVER (PARTITION BY gps_id, recorded_at ORDER BY src_file, src_row) AS rn
        FROM enr WHERE recorded_at IS NOT NULL) WHERE rn = 1),
wh AS (
    SELECT * FROM wh_all
    WHERE traffic_light_id IS NULL OR traffic_light_id IN (SELECT traffic_light_id FROM lights))"""


def with_ctes(body: str, extra: str = "") -> str:
    return f"WITH {ctes()}{',' + extra if extra else ''}\n{body}"


def sched_match(tod_expr: str, mode: str) -> str:
    if mode == "strict":
        return f"{tod_expr} BETWEEN s.start_sec AND s.end_sec"
    return (f"(CASE WHEN s.start_sec <= s.end_sec THEN {tod_expr} >= s.start_sec AND {tod_expr} < s.end_sec"
            f" ELSE {tod_expr} >= s.start_sec OR {tod_expr} < s.end_sec END)")


# Mean of DECIMAL speeds: exact sums, so no threshold depends on the order of addition.
MEAN = "CAST(SUM(CAST(speed_kmh AS DECIMAL(18,6))) AS DOUBLE) / COUNT(speed_kmh)"


def _bands() -> str:
    """Speed bands with their label and waiting time, as a table."""
    edges = [(-1e9, 1, seeds.LABEL_CONGESTED, 120), (1, seeds.SPEED_CONGESTED_KMH, seeds.LABEL_CONGESTED, 60),
             (seeds.SPEED_CONGESTED_KMH, seeds.SPEED_SLOW_KMH, seeds.LABEL_SLOW, 20), (seeds.SPEED_SLOW_KMH, 1e9, seeds.LABEL_FREE, 5)]
    rows = ", ".join(f"(CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE), '{label}', CAST({wait} AS DOUBLE))" for lo, hi, label, wait in edges)
    return f"(VALUES {rows}) band(from_kmh, below_kmh, label, wait_s)"


VERDICT_OUT = {
    "traffic_light_id": "traffic_light_id", "analysis_time": ts_text("moment"), "time_id": time_id("moment"), "time_window": "time_window",
    "day_type": "day_type", "avg_speed_kmh": dec_round("mean_kmh", 2), "vehicle_count": "CAST(vehicles AS INTEGER)",
    "congestion_level": dec_round("least(greatest((1.0 - mean_kmh / 50.0) * 100.0, 0.0), 100.0)", 1),
    "congestion_label": "label", "avg_waiting_time": "wait_s",
    "queue_length": dec_round(f"greatest(({seeds.SPEED_CONGESTED_KMH} - mean_kmh) / CAST({seeds.SPEED_CONGESTED_KMH} AS DOUBLE) * vehicles, 0.0)", 6),
    "scheduled_red_duration": "red_s", "is_inefficient": "vehicles >= 3 AND mean_kmh < 5.0",
}


def verdict_select(stats: str, mode: str, collapse: bool = True) -> str:
    """Verdicts of ``stats`` (traffic_light_id, time_window, day_type, moment, mean_kmh, vehicles).

    Label and waiting time are looked up in the table of speed bands, the red
    phase in the schedule at the time of day of ``moment``.
    """
    columns = ", ".join(f"{e} AS {c}" for c, e in VERDICT_OUT.items())
    one = ("QUALIFY row_number() OVER (PARTITION BY g.traffic_light_id, moment ORDER BY vehicles DESC, time_window NULLS LAST, "
           "day_type NULLS LAST, red_s NULLS LAST) = 1") if collapse else ""
    return f"""
    SELECT {columns} FROM (
        SELECT g.*, band.label, band.wait_s, CAST(s.red_duration AS INTEGER) AS red_s
        FROM ({stats}) g
        JOIN {_bands()} ON g.mean_kmh >= band.from_kmh AND g.mean_kmh < band.below_kmh
        LEFT JOIN sched s ON s.applicable_days = g.day_type AND s.traffic_light_id = g.traffic_light_id
            AND {sched_match(tod('g.moment'), mode)}
        {one})"""


def _per_group(source: str, at: str) -> str:
    return f"""
        SELECT traffic_light_id, time_window, day_type, {at} AS moment, {MEAN} AS mean_kmh, COUNT(DISTINCT gps_id) AS vehicles
        FROM {source} WHERE traffic_light_id IS NOT NULL GROUP BY ALL"""


def window_stats(minutes: int = 5, slide: int | None = None) -> str:
    """Statistics by window end; sliding windows list each ping under every window that covers it."""
    if slide is None:
        return _per_group("wh", f"time_bucket(INTERVAL {minutes} MINUTES, recorded_at) + INTERVAL {minutes} MINUTES")
    listed = f"(SELECT *, unnest(range({minutes // slide})) AS i FROM wh)"
    return _per_group(listed, f"time_bucket(INTERVAL {slide} MINUTES, recorded_at) + to_minutes(CAST(i * {slide} + {slide} AS BIGINT))")


def snapshot_stats(as_of: str, bounded: bool, minutes: int = 5) -> str:
    """Statistics of the pings of the last minutes before ``as_of`` (and later ones, unless bounded)."""
    ages = f"(SELECT *, TIMESTAMP '{as_of}' - recorded_at AS age FROM wh)"
    frame = f"(SELECT * FROM {ages} WHERE age < INTERVAL {minutes} MINUTES{' AND age >= INTERVAL 0 SECONDS' if bounded else ''})"
    return _per_group(frame, f"TIMESTAMP '{as_of}'")
