"""Raw lake pings derived from the ``events`` table.

``events`` covers January 2024, outside the time dimension, so instants are
shifted by 735 days: 105 whole weeks, which keeps weekdays and times of day.
Each event becomes one collection run of its user's device: seven pings, one
every five seconds, with the event's microseconds kept. The keys grow with the
table (no two events are folded onto one key); only the injected copies are
duplicates. The rule is deterministic and row-local (no shuffle), and is
written once in Spark and once in SQL for the oracle. Every 50th ping appears
a second time as a later copy (``src_file`` 1) with speed + 1, which the
keep-first dedupe must drop; other pings carry broken values, among them
timestamps that do not parse and timestamps with an offset. Every 61st event is a
jam: two more vehicles stand in it, and all three are slow.

Output is the lake ping layout (timestamp as text) plus the two ordering
columns ``src_file`` and ``src_row`` that define "first" for dedupe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.session import input_bytes
from roadlens.sources import seeds

# FIXED VALUES of the fixture rule (also spelled out in FIXTURES.md §3)
SHIFT_DAYS = 735
RUN_POINTS, STEP_SECONDS = 7, 5
JAM = "event_id % 61 = 9"
LAT_MULT, LON_MULT, JITTER_MOD, JITTER_HALF = 7919, 104729, 4001, 2000


# Seconds from a ping's stamp to its reception, by the second of the stamp: a moment as a rule, some come late
# (beyond the window, too), and some devices stamp the future. SQL text for both engines.
DELAY_SQL = "CASE {second} % 11 WHEN 3 THEN 130 WHEN 5 THEN -400 WHEN 7 THEN 700 WHEN 8 THEN -45 ELSE 2 END"


# Bytes of compressed events per task: an event becomes some hundred times that many bytes of pings.
EVENT_TASK_BYTES = 4 * 1024 * 1024


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' columns that pings are made of, dealt evenly over tasks.

    A scan has as many tasks as the file has row groups, and each event becomes
    seven pings and more: expanded as they lie, a few tasks would do all the
    work and sort more pings than their memory holds. The narrow rows are dealt before that.
    """
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(events(spark, sf_dir)) // EVENT_TASK_BYTES))
    return ev.repartition(tasks, "event_id", "ts")


def _light_attr_sql(idx: int) -> str:
    """Attribute ``idx`` of light number ``event_id % 5``: one lookup in a literal array."""
    arr = ", ".join(f"{float(row[idx])!r}D" for row in seeds.TRAFFIC_LIGHTS)
    return f"element_at(array({arr}), CAST(event_id % 5 + 1 AS INT))"


def gps_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lake pings, one scan of ``events``.

    The points of a run and the later copies come from generators on the same
    scan, so the table is read once, and its rows are dealt evenly over tasks
    before they multiply (:func:`spread_events`). All rules are SQL expression text: one
    JVM call for the whole projection.
    """
    peak = ", ".join(str(h) for h in seeds.PEAK_HOURS)
    is_peak = f"hour(at) IN ({peak})"
    weekday = "dayofweek(at) NOT IN (1, 7)"
    plain = "date_format(at, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    offset = "concat(date_format(at + INTERVAL 7 HOURS, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+07:00')"
    jitter_lat = f"((event_id * {LAT_MULT}) % {JITTER_MOD} - {JITTER_HALF} + k * 20) / 1000000.0D"
    jitter_lon = f"((event_id * {LON_MULT}) % {JITTER_MOD} - {JITTER_HALF} + k * 20) / 1000000.0D"
    speed = (f"CASE WHEN src_row % 107 = 3 THEN -1.0D WHEN {JAM} THEN (member + k) * 0.5D WHEN {is_peak} THEN value * 0.125D + k * 0.25D "
             "ELSE value * 0.5D + k * 0.25D END")
    return (spread_events(spark, sf_dir)
            .selectExpr("event_id", "ts", "user_id", "value", f"explode(sequence(0, {RUN_POINTS - 1})) AS k")
            .selectExpr("*", f"explode(CASE WHEN {JAM} THEN array(0, 1, 2) ELSE array(0) END) AS member")
            .selectExpr("event_id", "user_id", "value", "k", "member", f"event_id * {RUN_POINTS} + k AS src_row",
                        f"CAST(ts AS TIMESTAMP) + make_interval(0, 0, 0, {SHIFT_DAYS}, 0, 0, k * {STEP_SECONDS}) AS at")
            .selectExpr("*", "explode(CASE WHEN src_row % 50 = 0 THEN array(0, 1) ELSE array(0) END) AS src_file")
            .selectExpr(
                "concat('GPS_', CAST(user_id AS STRING), CASE WHEN member > 0 THEN concat('_', CAST(member AS STRING)) ELSE '' END) AS gps_id",
                f"CASE WHEN src_row % 109 = 7 THEN 'junk' WHEN src_row % 13 = 4 THEN {offset} ELSE {plain} END AS timestamp",
                "CASE WHEN src_row % 97 = 0 THEN CAST(NULL AS DOUBLE) WHEN src_row % 101 = 1 THEN 91.0D "
                f"WHEN src_row % 103 = 2 THEN 0.0D ELSE {_light_attr_sql(3)} + {jitter_lat} END AS latitude",
                f"CASE WHEN src_row % 103 = 2 THEN 0.0D ELSE {_light_attr_sql(4)} + {jitter_lon} END AS longitude",
                f"CASE WHEN src_file = 1 THEN ({speed}) + 1.0D ELSE {speed} END AS speed_kmh",
                "CASE WHEN event_id % 23 = 0 THEN 'unknown' WHEN event_id % 211 = 5 THEN 'TL999' "
                "ELSE concat('TL00', CAST(event_id % 5 + 1 AS STRING)) END AS traffic_light_id",
                f"CASE WHEN event_id % 3 = 0 THEN CAST(NULL AS STRING) WHEN {weekday} THEN 'weekday' "
                "ELSE 'weekend' END AS day_type",
                f"CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS STRING) WHEN {is_peak} THEN 'peak_hour' "
                "ELSE 'off_peak' END AS time_window",
                f"{plain} AS received_at",
                "src_file",
                "src_row",
            ))


def _sql_light_case(idx: int) -> str:
    parts = " ".join(f"WHEN {i} THEN CAST({row[idx]!r} AS DOUBLE)"
                     for i, row in enumerate(seeds.TRAFFIC_LIGHTS))
    return f"CASE event_id % 5 {parts} END"


def sql_gps_raw() -> str:
    peak = ", ".join(str(x) for x in seeds.PEAK_HOURS)
    jlat = f"CAST((event_id * {LAT_MULT}) % {JITTER_MOD} - {JITTER_HALF} + k * 20 AS DOUBLE) / CAST(1000000 AS DOUBLE)"
    jlon = f"CAST((event_id * {LON_MULT}) % {JITTER_MOD} - {JITTER_HALF} + k * 20 AS DOUBLE) / CAST(1000000 AS DOUBLE)"
    base = f"""
    SELECT 'GPS_' || CAST(user_id AS VARCHAR) || CASE WHEN member > 0 THEN '_' || CAST(member AS VARCHAR) ELSE '' END AS gps_id,
           CASE WHEN src_row % 109 = 7 THEN 'junk'
                WHEN src_row % 13 = 4 THEN strftime(pt + INTERVAL 7 HOURS, '%Y-%m-%dT%H:%M:%S.%f') || '+07:00'
                ELSE strftime(pt, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp,
           CASE WHEN src_row % 97 = 0 THEN CAST(NULL AS DOUBLE)
                WHEN src_row % 101 = 1 THEN CAST(91.0 AS DOUBLE)
                WHEN src_row % 103 = 2 THEN CAST(0.0 AS DOUBLE)
                ELSE {_sql_light_case(3)} + {jlat} END AS latitude,
           CASE WHEN src_row % 103 = 2 THEN CAST(0.0 AS DOUBLE)
                ELSE {_sql_light_case(4)} + {jlon} END AS longitude,
           CASE WHEN src_row % 107 = 3 THEN CAST(-1.0 AS DOUBLE)
                WHEN {JAM} THEN (member + k) * CAST(0.5 AS DOUBLE)
                WHEN hour(pt) IN ({peak}) THEN value * CAST(0.125 AS DOUBLE) + k * CAST(0.25 AS DOUBLE)
                ELSE value * CAST(0.5 AS DOUBLE) + k * CAST(0.25 AS DOUBLE) END AS speed_kmh,
           CASE WHEN event_id % 23 = 0 THEN 'unknown'
                WHEN event_id % 211 = 5 THEN 'TL999'
                ELSE 'TL00' || CAST(1 + event_id % 5 AS VARCHAR) END AS traffic_light_id,
           CASE WHEN event_id % 3 = 0 THEN NULL
                WHEN dayofweek(pt) NOT IN (0, 6) THEN 'weekday' ELSE 'weekend' END AS day_type,
           CASE WHEN event_id % 4 = 0 THEN NULL
                WHEN hour(pt) IN ({peak}) THEN 'peak_hour' ELSE 'off_peak' END AS time_window,
           strftime(pt, '%Y-%m-%d %H:%M:%S.%f') AS received_at,
           0 AS src_file,
           src_row
    FROM (SELECT event_id, user_id, value, k, member, event_id * {RUN_POINTS} + k AS src_row,
                 CAST(ts AS TIMESTAMP) + INTERVAL {SHIFT_DAYS} DAYS + to_seconds(k * {STEP_SECONDS}) AS pt
          FROM (SELECT *, unnest(CASE WHEN {JAM} THEN [0, 1, 2] ELSE [0] END) AS member
                FROM (SELECT *, unnest(range({RUN_POINTS})) AS k FROM events)) e) p"""
    return f"""
    SELECT * FROM ({base}) b
    UNION ALL
    SELECT gps_id, timestamp, latitude, longitude, speed_kmh + CAST(1.0 AS DOUBLE) AS speed_kmh,
           traffic_light_id, day_type, time_window, received_at, 1 AS src_file, src_row
    FROM ({base}) c WHERE src_row % 50 = 0"""


# ---------------------------------------------------------------- JSON requests
#
# Gateway request bodies built from the same pings, one per ping (the first
# copy). ``case = src_row % 37`` injects the decode cases: 0 not JSON, 1 a
# JSON array, 2 an empty object, 3 longitude absent, 4 gps_id null, 5
# latitude as a numeric string, 6 latitude "abc", 7 latitude 90.5, 8 speed
# "abc", 9 speed absent, 10 speed null, 11 an extra accuracy_m key, 12 speed
# 60 m/s, 13 speed -3 m/s, 14 single quotes, 15 text after the object, 16
# latitude "21.0d", 17 brackets and text after the object, 18 latitude repeated
# (the last one counts); otherwise a regular body. Numbers are written as
# fixed-scale DECIMAL text after a HALF_UP round so both engines print the same
# text. Keys with NULL payload values are left out (absent → default).
REQUEST_CASES = 37


def _fmt_sql(c: str, places: int) -> str:
    return (f"coalesce(CAST(CAST(round(CAST({c} AS decimal(28,12)), {places}) AS decimal(20,{places})) "
            f"AS STRING), 'null')")


def _q(c: str) -> str:
    """SQL text of ``c`` wrapped in JSON double quotes."""
    return f"concat('\"', {c}, '\"')"


def _kv(key: str, v: str) -> str:
    return f"concat('\"{key}\": ', {v})"


def gps_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, value)`` with ``value`` the JSON body of one request.

    A key whose value is NULL drops out by itself: ``concat`` with a NULL is
    NULL and ``concat_ws`` skips NULLs.
    """
    case = f"(src_row % {REQUEST_CASES})"
    lat_v = (f"CASE WHEN {case} = 5 THEN {_q(_fmt_sql('latitude', 6))} WHEN {case} = 6 THEN '\"abc\"' "
             f"WHEN {case} = 7 THEN '90.5' WHEN {case} = 16 THEN '\"21.0d\"' ELSE {_fmt_sql('latitude', 6)} END")
    speed_v = (f"CASE WHEN {case} = 8 THEN '\"abc\"' WHEN {case} = 9 THEN CAST(NULL AS STRING) "
               f"WHEN {case} = 10 THEN 'null' WHEN {case} = 12 THEN '60' WHEN {case} = 13 THEN '-3' "
               f"ELSE {_fmt_sql('speed_kmh / 3.6D', 4)} END")
    parts = [
        _kv("gps_id", f"CASE WHEN {case} = 4 THEN 'null' ELSE {_q('gps_id')} END"),
        _kv("device_id", _q("concat('DEV', substring(gps_id, -4, 4))")),
        _kv("timestamp", _q("timestamp")),
        _kv("latitude", lat_v),
        f"CASE WHEN {case} != 3 THEN {_kv('longitude', _fmt_sql('longitude', 6))} END",
        _kv("speed", speed_v),
        _kv("traffic_light_id", _q("traffic_light_id")),
        _kv("day_type", _q("day_type")),
        _kv("time_window", _q("time_window")),
        f"CASE WHEN {case} = 11 THEN '\"accuracy_m\": 5.0' END",
    ]
    body = f"concat('{{', concat_ws(', ', {', '.join(parts)}), '}}')"
    value = (f"CASE WHEN {case} = 0 THEN '{{bad' WHEN {case} = 1 THEN '[1]' WHEN {case} = 2 THEN '{{}}' "
             f"WHEN {case} = 14 THEN replace({body}, '\"', chr(39)) WHEN {case} = 15 THEN concat({body}, ' trailing') "
             f"WHEN {case} = 17 THEN concat({body}, ']}} more') WHEN {case} = 18 THEN concat('{{\"latitude\": 1.5, ', substring({body}, 2)) "
             f"ELSE {body} END")
    return (gps_raw(spark, sf_dir).filter("src_file = 0")
            .selectExpr("src_row AS event_id", f"{value} AS value"))


def sql_gps_requests() -> str:
    def fmt(c, places):
        return (f"COALESCE(CAST(CAST(ROUND(CAST({c} AS DECIMAL(28,12)), {places}) "
                f"AS DECIMAL(20,{places})) AS VARCHAR), 'null')")

    case = f"(src_row % {REQUEST_CASES})"
    lat_v = (f"CASE WHEN {case} = 5 THEN '\"' || {fmt('latitude', 6)} || '\"' "
             f"WHEN {case} = 6 THEN '\"abc\"' WHEN {case} = 7 THEN '90.5' WHEN {case} = 16 THEN '\"21.0d\"' ELSE {fmt('latitude', 6)} END")
    speed_v = (f"CASE WHEN {case} = 8 THEN '\"abc\"' WHEN {case} = 9 THEN NULL "
               f"WHEN {case} = 10 THEN 'null' WHEN {case} = 12 THEN '60' WHEN {case} = 13 THEN '-3' "
               f"ELSE {fmt('speed_kmh / CAST(3.6 AS DOUBLE)', 4)} END")
    parts = [
        f"'\"gps_id\": ' || (CASE WHEN {case} = 4 THEN 'null' ELSE '\"' || gps_id || '\"' END)",
        "'\"device_id\": \"DEV' || right(gps_id, 4) || '\"'",
        "'\"timestamp\": \"' || timestamp || '\"'",
        f"'\"latitude\": ' || ({lat_v})",
        f"CASE WHEN {case} <> 3 THEN '\"longitude\": ' || {fmt('longitude', 6)} END",
        f"'\"speed\": ' || ({speed_v})",
        "'\"traffic_light_id\": \"' || traffic_light_id || '\"'",
        "'\"day_type\": \"' || day_type || '\"'",
        "'\"time_window\": \"' || time_window || '\"'",
        f"CASE WHEN {case} = 11 THEN '\"accuracy_m\": 5.0' END",
    ]
    body = "'{' || concat_ws(', ', " + ", ".join(parts) + ") || '}'"
    return f"""
    SELECT src_row AS event_id,
           CASE WHEN {case} = 0 THEN '{{bad' WHEN {case} = 1 THEN '[1]' WHEN {case} = 2 THEN '{{}}'
                WHEN {case} = 14 THEN replace({body}, '"', chr(39)) WHEN {case} = 15 THEN {body} || ' trailing'
                WHEN {case} = 17 THEN {body} || ']}} more' WHEN {case} = 18 THEN '{{"latitude": 1.5, ' || substring({body}, 2)
                ELSE {body} END AS value
    FROM ({sql_gps_raw()}) r WHERE src_file = 0"""


# ---------------------------------------------------------------- phone payloads

def phone_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, value)`` with the body the phone sends: speed in km/h under ``speed``, ``accuracy_m``, a zoned timestamp."""
    zoned = "concat(date_format(to_timestamp(received_at) + INTERVAL 7 HOURS, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+07:00')"
    parts = [_kv("gps_id", _q("concat('G', CAST(src_row AS STRING))")), _kv("device_id", _q("gps_id")), _kv("timestamp", _q(zoned)),
             _kv("latitude", _fmt_sql("latitude", 6)), _kv("longitude", _fmt_sql("longitude", 6)),
             _kv("speed", _fmt_sql("speed_kmh", 4)), _kv("accuracy_m", _fmt_sql("src_row % 17 / 2.0D", 1)), _kv("day_type", _q("day_type"))]
    return (gps_raw(spark, sf_dir).filter("src_file = 0")
            .selectExpr("src_row AS event_id", f"concat('{{', concat_ws(', ', {', '.join(parts)}), '}}') AS value"))
