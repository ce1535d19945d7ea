"""Registered queries: name → (Spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the given tables (through the
``events``-derived ping fixture) and returns a DataFrame whose column names
equal those of its SQL twin.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlens.operators import congestion
from roadlens.plans import base, oracle
from roadlens.sources import dimensions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ verdicts

@register("congestion_by_window", oracle.with_ctes(
    oracle.verdict_select(oracle.window_stats(5), "strict")))
def congestion_by_window(spark, sf_dir):
    """Flagship: tumbling 5-minute verdicts per light, strict schedule."""
    return congestion.windowed(base.warehouse_pings(spark, sf_dir),
                               dimensions.light_schedule(spark), 5, mode="strict")


@register("congestion_by_window_wrap", oracle.with_ctes(
    oracle.verdict_select(oracle.window_stats(5), "wrap")))
def congestion_by_window_wrap(spark, sf_dir):
    return congestion.windowed(base.warehouse_pings(spark, sf_dir),
                               dimensions.light_schedule(spark), 5, mode="wrap")


@register("congestion_hopping", oracle.with_ctes(
    oracle.verdict_select(oracle.window_stats(5, 1), "strict")))
def congestion_hopping(spark, sf_dir):
    """Sliding 5-minute windows every minute (the 60 s verdict cadence)."""
    return congestion.windowed(base.warehouse_pings(spark, sf_dir),
                               dimensions.light_schedule(spark), 5, 1, mode="strict")


@register("verdict_snapshot", oracle.with_ctes(
    oracle.verdict_select(oracle.snapshot_stats(base.AS_OF, True), "strict")))
def verdict_snapshot(spark, sf_dir):
    """Verdicts at one analysis instant, pings in (as_of - 5 min, as_of]."""
    return congestion.snapshot(base.warehouse_pings(spark, sf_dir), dimensions.light_schedule(spark),
                               base.AS_OF, bound_above=True)


@register("verdict_snapshot_unbounded", oracle.with_ctes(
    oracle.verdict_select(oracle.snapshot_stats(base.AS_OF, False), "strict", collapse=False)))
def verdict_snapshot_unbounded(spark, sf_dir):
    """As the warehouse job: no upper bound, every group before the per-light collapse."""
    return congestion.snapshot(base.warehouse_pings(spark, sf_dir), dimensions.light_schedule(spark),
                               base.AS_OF, bound_above=False, collapse=False)


@register("verdict_snapshot_collapsed", oracle.with_ctes(
    oracle.verdict_select(oracle.snapshot_stats(base.AS_OF, False), "strict")))
def verdict_snapshot_collapsed(spark, sf_dir):
    """As the warehouse job, one stored verdict per light (insert-or-ignore on the key)."""
    return congestion.snapshot(base.warehouse_pings(spark, sf_dir), dimensions.light_schedule(spark),
                               base.AS_OF, bound_above=False)


# ------------------------------------------------------------------ cleaning and enrichment

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from roadlens.functions.timeparts import seconds_of_day, ts_text  # noqa: E402
from roadlens.operators import clean as clean_ops  # noqa: E402
from roadlens.operators import enrich, load, quality, trajectory  # noqa: E402
from roadlens.operators.joins import keep_first  # noqa: E402
from roadlens.operators.schedule import lookup_red  # noqa: E402
from roadlens.sources import decode, fixtures, lake, ping_table, verdict_store, warehouse  # noqa: E402
from roadlens.session import exists, scratch_path, stream_session  # noqa: E402

RAW_COLS = ["gps_id", "timestamp", "latitude", "longitude", "speed_kmh", "traffic_light_id",
            "day_type", "time_window", "received_at", "src_file", "src_row"]


@register("clean_pings", oracle.with_ctes("SELECT * FROM clean"))
def clean_pings(spark, sf_dir):
    """Validated pings, first copy per (gps_id, timestamp text) in lake order."""
    return base.clean_pings(spark, sf_dir).select(*RAW_COLS)


_REASON_SQL = """CASE
    WHEN gps_id IS NULL OR timestamp IS NULL OR latitude IS NULL OR isnan(latitude)
         OR longitude IS NULL OR isnan(longitude) THEN 'missing_field'
    WHEN try_cast(timestamp AS TIMESTAMP) IS NULL THEN 'bad_timestamp'
    WHEN NOT latitude BETWEEN -90 AND 90 THEN 'latitude_range'
    WHEN NOT longitude BETWEEN -180 AND 180 THEN 'longitude_range'
    WHEN NOT COALESCE(speed_kmh BETWEEN 0 AND 200, FALSE) THEN 'speed_range'
    WHEN abs(latitude) < 0.001 AND abs(longitude) < 0.001 THEN 'null_island' END"""


@register("clean_rejects", oracle.with_ctes(f"""
    SELECT *, {_REASON_SQL} AS reject_reason FROM raw WHERE NOT ({oracle.VALID_PRED})
    UNION ALL
    SELECT v.*, 'duplicate' AS reject_reason FROM valid v
    WHERE NOT EXISTS (SELECT 1 FROM clean c WHERE c.gps_id = v.gps_id AND c.timestamp = v.timestamp
                      AND c.src_file = v.src_file AND c.src_row = v.src_row)"""))
def clean_rejects(spark, sf_dir):
    """Every dropped raw row with its first failing rule (or ``duplicate``)."""
    return clean_ops.rejects(base.raw_pings(spark, sf_dir)).select(*RAW_COLS, "reject_reason")


ENRICHED_OUT = ["gps_id", "vehicle_id", "recorded_at", "latitude", "longitude", "speed_kmh", "heading",
                "traffic_light_id", "day_type", "time_window", "time_id"]
POINT = ["geom.lon AS geom_lon", "geom.lat AS geom_lat", "geom.srid AS geom_srid"]


def _enriched_out(df):
    return df.selectExpr("*", *POINT).select(
        *[ts_text(c).alias(c) if c == "recorded_at" else F.col(c) for c in ENRICHED_OUT], "geom_lon", "geom_lat", "geom_srid")


@register("enriched_pings", oracle.with_ctes(
    f"SELECT * EXCLUDE (recorded_at, src_file, src_row), {oracle.ts_text('recorded_at')} AS recorded_at, "
    "longitude AS geom_lon, latitude AS geom_lat, 4326 AS geom_srid FROM wh_all"))
def enriched_pings(spark, sf_dir):
    """Warehouse rows: instant key, sentinel → NULL, derived day type, time window, time id."""
    return _enriched_out(base.warehouse_all(spark, sf_dir))


@register("unknown_lights", oracle.with_ctes(
    f"SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at, traffic_light_id FROM wh_all "
    "WHERE traffic_light_id IS NOT NULL AND traffic_light_id NOT IN (SELECT traffic_light_id FROM lights)"))
def unknown_lights(spark, sf_dir):
    """Quarantined pings: light not in the light dimension (anti-join)."""
    return base.unknown_light_pings(spark, sf_dir).select(
        "gps_id", ts_text("recorded_at").alias("recorded_at"), "traffic_light_id")


def _sched_sql(mode: str) -> str:
    return oracle.with_ctes(f"""
    SELECT p.gps_id, {oracle.ts_text('p.recorded_at')} AS recorded_at, p.traffic_light_id, p.day_type,
           CAST(floor({oracle.tod('p.recorded_at')}) AS BIGINT) AS tod_sec, CAST(s.red_duration AS INTEGER) AS scheduled_red_duration
    FROM wh p LEFT JOIN sched s ON s.traffic_light_id = p.traffic_light_id
        AND s.applicable_days = p.day_type AND {oracle.sched_match(oracle.tod('p.recorded_at'), mode)}""")


def _sched_query(spark, sf_dir, mode):
    p = base.warehouse_pings(spark, sf_dir).withColumn("tod_sec", seconds_of_day("recorded_at"))
    return lookup_red(p, dimensions.light_schedule(spark), "tod_sec", "day_type", mode).select(
        "gps_id", ts_text("recorded_at").alias("recorded_at"), "traffic_light_id", "day_type",
        F.col("tod_sec").cast("bigint").alias("tod_sec"), "scheduled_red_duration")


@register("schedule_strict", _sched_sql("strict"))
def schedule_strict(spark, sf_dir):
    """Red duration active at each ping's time of day, closed intervals, no wrap."""
    return _sched_query(spark, sf_dir, "strict")


@register("schedule_wrap", _sched_sql("wrap"))
def schedule_wrap(spark, sf_dir):
    """Red duration active at each ping's time of day, half-open with midnight wrap."""
    return _sched_query(spark, sf_dir, "wrap")


@register("time_lookup", oracle.with_ctes(f"""
    SELECT p.gps_id, {oracle.ts_text('p.recorded_at')} AS recorded_at, p.time_id,
           td.time_id AS dim_time_id, td.season, td.is_weekend
    FROM wh p LEFT JOIN td ON td.full_timestamp = date_trunc('hour', p.recorded_at)""",
    extra=f"td AS ({dimensions.sql_time_dimension()})"))
def time_lookup(spark, sf_dir):
    """Hour lookup of each ping in the generated time dimension (broadcast join)."""
    p = enrich.attach_time(base.warehouse_pings(spark, sf_dir), dimensions.time_dimension(spark))
    return p.select("gps_id", ts_text("recorded_at").alias("recorded_at"), "time_id",
                    "dim_time_id", "season", "is_weekend")


# ------------------------------------------------------------------ decode layer

RECEIVED_AT = "2026-01-09T08:30:00+00:00"


def _decoded(spark, sf_dir):
    return decode.decode_requests(fixtures.gps_requests(spark, sf_dir), received_at=f"'{RECEIVED_AT}'")


_DECODE_SQL = f"""
req AS ({fixtures.sql_gps_requests()}),
rq AS (
    SELECT event_id, value,
           CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE FALSE END AS is_obj
    FROM req),
fld AS (
    SELECT event_id, value, is_obj,
           CASE WHEN is_obj THEN len(json_keys(value)) END AS n_keys,
           CASE WHEN is_obj THEN json_extract_string(value, '$.gps_id') END AS gps_id,
           CASE WHEN is_obj THEN json_extract_string(value, '$.device_id') END AS vehicle_id,
           CASE WHEN is_obj THEN json_extract_string(value, '$.timestamp') END AS timestamp,
           (SELECT list_last(list(j.value ->> '$' ORDER BY j.id)) FROM json_each(CASE WHEN is_obj THEN rq.value ELSE '{{}}' END) j
            WHERE j.key = 'latitude') AS lat_t,
           CASE WHEN is_obj THEN json_extract_string(value, '$.longitude') END AS lon_t,
           CASE WHEN is_obj THEN json_extract_string(value, '$.speed') END AS spd_t,
           CASE WHEN is_obj THEN json_extract_string(value, '$.traffic_light_id') END AS light_t,
           CASE WHEN is_obj THEN json_extract_string(value, '$.day_type') END AS day_t,
           CASE WHEN is_obj THEN json_extract_string(value, '$.time_window') END AS tw_t
    FROM rq),
num AS (
    SELECT *, try_cast(lat_t AS DOUBLE) AS latitude, try_cast(lon_t AS DOUBLE) AS longitude,
           try_cast(spd_t AS DOUBLE) AS spd FROM fld),
dec AS (
    SELECT *,
      CASE WHEN NOT is_obj THEN 'malformed'
           WHEN n_keys = 0 THEN 'empty'
           WHEN gps_id IS NULL OR timestamp IS NULL OR lat_t IS NULL OR lon_t IS NULL THEN 'missing_field'
           WHEN latitude IS NULL OR longitude IS NULL THEN 'not_a_number'
           WHEN NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) THEN 'coordinates'
           WHEN spd_t IS NOT NULL AND spd IS NULL THEN 'not_a_number' END AS reject_reason,
      COALESCE(CASE WHEN spd IS NULL THEN NULL WHEN isnan(spd) THEN 0.0 ELSE
          {oracle.dec_round('GREATEST(0.0, LEAST(spd * CAST(3.6 AS DOUBLE), 200.0))', 2)} END, 0.0) AS speed_kmh
    FROM num)"""


@register("gateway_decode", oracle.with_ctes(f"""
    SELECT event_id, gps_id, vehicle_id, timestamp, latitude, longitude, speed_kmh,
           COALESCE(light_t, 'unknown') AS traffic_light_id, COALESCE(day_t, 'weekday') AS day_type,
           COALESCE(tw_t, 'off_peak') AS time_window, '{RECEIVED_AT}' AS received_at
    FROM dec WHERE reject_reason IS NULL""", extra=_DECODE_SQL))
def gateway_decode(spark, sf_dir):
    """Accepted JSON requests as typed queue messages (defaults, km/h speed)."""
    return _decoded(spark, sf_dir).filter(F.col("reject_reason").isNull()).select(
        "event_id", *decode.MESSAGE_COLS)


@register("gateway_rejects", oracle.with_ctes(
    "SELECT event_id, value, reject_reason FROM dec WHERE reject_reason IS NOT NULL", extra=_DECODE_SQL))
def gateway_rejects(spark, sf_dir):
    """Rejected JSON requests with the reason (accepted + rejected = input)."""
    return _decoded(spark, sf_dir).filter(F.col("reject_reason").isNotNull()).select(
        "event_id", "value", "reject_reason")


@register("queue_roundtrip", oracle.with_ctes(f"""
    SELECT gps_id AS key, gps_id, vehicle_id, timestamp, latitude, longitude, speed_kmh,
           COALESCE(light_t, 'unknown') AS traffic_light_id, COALESCE(day_t, 'weekday') AS day_type,
           COALESCE(tw_t, 'off_peak') AS time_window, '{RECEIVED_AT}' AS received_at
    FROM dec WHERE reject_reason IS NULL""", extra=_DECODE_SQL))
def queue_roundtrip(spark, sf_dir):
    """Accepted requests encoded as keyed queue records and decoded again as messages: nothing changes on the way."""
    sent = decode.encode_message(decode.accepted(_decoded(spark, sf_dir)))
    back = decode.decode_requests(sent, speed_unit="km/h", speed_key="speed_kmh")
    return back.filter("reject_reason IS NULL").select("key", *decode.MESSAGE_COLS)


@register("phone_decode", oracle.with_ctes(f"""
    SELECT src_row AS event_id, 'G' || CAST(src_row AS VARCHAR) AS gps_id, gps_id AS vehicle_id, received_at AS recorded_at,
           {oracle.dec_round('latitude', 6)} AS latitude, {oracle.dec_round('longitude', 6)} AS longitude,
           {oracle.dec_round(f"GREATEST(0.0, LEAST({oracle.dec_round('speed_kmh', 4)}, 200.0))", 2)} AS speed_kmh,
           CAST(src_row % 17 AS DOUBLE) / 2.0 AS accuracy_m, COALESCE(day_type, 'weekday') AS day_type
    FROM raw WHERE src_file = 0 AND latitude BETWEEN -90 AND 90 AND longitude IS NOT NULL"""))
def phone_decode(spark, sf_dir):
    """Phone payloads: speed already in km/h, accuracy kept, the zoned timestamp as a UTC instant."""
    out = decode.decode_requests(fixtures.phone_requests(spark, sf_dir), received_at=f"'{RECEIVED_AT}'", speed_unit="km/h")
    return out.filter("reject_reason IS NULL").selectExpr(
        "event_id", "gps_id", "vehicle_id", "date_format(try_cast(timestamp AS TIMESTAMP), 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS recorded_at",
        "latitude", "longitude", "speed_kmh", "accuracy_m", "day_type")


@register("speed_normalize", f"""
    SELECT event_id, CASE WHEN isnan(value) THEN 0.0 ELSE
        {oracle.dec_round('GREATEST(0.0, LEAST(value * CAST(3.6 AS DOUBLE), 200.0))', 2)} END AS speed_kmh
    FROM events""")
def speed_normalize(spark, sf_dir):
    """m/s → km/h clamped to [0, 200], rounded 2 HALF_UP, over every event value."""
    ev = fixtures.events(spark, sf_dir)
    return ev.select("event_id", decode.speed_to_kmh("value").alias("speed_kmh"))


# ------------------------------------------------------------------ verdicts of a job's runs

RUN_EVERY = 1


@register("verdicts_as_run", oracle.with_ctes(oracle.verdict_select(f"""
        SELECT traffic_light_id, time_window, day_type, run AS moment, {oracle.MEAN} AS mean_kmh, COUNT(DISTINCT gps_id) AS vehicles
        FROM (SELECT *, unnest(CASE WHEN a <= b THEN generate_series(a, b, INTERVAL {RUN_EVERY} MINUTE) END) AS run
              FROM (SELECT *, time_bucket(INTERVAL {RUN_EVERY} MINUTE, got + INTERVAL {RUN_EVERY} MINUTE - INTERVAL 1 MICROSECOND) AS a,
                           least(time_bucket(INTERVAL {RUN_EVERY} MINUTE, recorded_at + INTERVAL 5 MINUTE - INTERVAL 1 MICROSECOND), final) AS b
                    FROM got, (SELECT time_bucket(INTERVAL {RUN_EVERY} MINUTE, max(got) + INTERVAL 5 MINUTE) AS final FROM got)))
        WHERE traffic_light_id IS NOT NULL GROUP BY ALL""", "strict"), extra=f"""
    got AS (SELECT *, recorded_at + to_seconds({fixtures.DELAY_SQL.format(second='CAST(floor(epoch(recorded_at)) AS BIGINT)')}) AS got FROM wh)"""))
def verdicts_as_run(spark, sf_dir):
    """The verdicts of every minute's run as the job saw the data then: late pings are missing, pings stamped in the future count."""
    delay = fixtures.DELAY_SQL.format(second="unix_seconds(recorded_at)")
    pings = base.warehouse_pings(spark, sf_dir).withColumn("received_at", F.expr(f"recorded_at + make_dt_interval(0, 0, 0, {delay})"))
    # a scalar subquery of the same plan: it shares the main query's shuffle of pings
    view = "as_run_" + uuid.uuid4().hex
    pings.createOrReplaceTempView(view)
    last_run = f"(SELECT date_trunc('MINUTE', max(received_at) + INTERVAL 5 MINUTES) FROM {view})"
    return congestion.as_run(pings, dimensions.light_schedule(spark), last_run, 5, RUN_EVERY)


# ------------------------------------------------------------------ read queries over verdicts

def _flagship_sql() -> str:
    return oracle.verdict_select(oracle.window_stats(5), "strict")


def _verdict_root(spark, sf_dir):
    """A verdict store loaded with the verdicts of all windows."""
    root = scratch_path(spark, "verdicts")
    verdict_store.load(congestion_by_window(spark, sf_dir), root)
    return root


def _stored(spark, sf_dir):
    return verdict_store.read(spark, _verdict_root(spark, sf_dir)).select(*congestion.VERDICT_COLS)


@register("latest_verdicts", oracle.with_ctes(
    "SELECT * FROM v ORDER BY analysis_time DESC, traffic_light_id LIMIT 10", extra=f"v AS ({_flagship_sql()})"))
def latest_verdicts(spark, sf_dir):
    """Top-10 most recent stored verdicts (the limit is the feature): only the newest days of the store are read."""
    return verdict_store.latest(spark, _verdict_root(spark, sf_dir), 10)


@register("latest_per_light", oracle.with_ctes(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY traffic_light_id "
    "ORDER BY analysis_time DESC) AS rn FROM v) WHERE rn = 1", extra=f"v AS ({_flagship_sql()})"))
def latest_per_light(spark, sf_dir):
    """Most recent verdict per light (max_by, partially aggregated), from the newest days that have one."""
    return verdict_store.latest_per_light(spark, _verdict_root(spark, sf_dir), dimensions.traffic_lights(spark))


@register("inefficient_lights", oracle.with_ctes(
    "SELECT * FROM v WHERE is_inefficient", extra=f"v AS ({_flagship_sql()})"))
def inefficient_lights(spark, sf_dir):
    """Verdicts flagged inefficient (>= 3 vehicles below 5 km/h)."""
    return _stored(spark, sf_dir).filter("is_inefficient")


@register("by_time_window", oracle.with_ctes(
    "SELECT * FROM v WHERE time_window = 'peak_hour' AND day_type = 'weekday'",
    extra=f"v AS ({_flagship_sql()})"))
def by_time_window(spark, sf_dir):
    """Verdicts of weekday peak hours."""
    return _stored(spark, sf_dir).filter((F.col("time_window") == "peak_hour")
                                         & (F.col("day_type") == "weekday"))


# ------------------------------------------------------------------ read queries over pings

@register("pings_per_vehicle", oracle.with_ctes(f"""
    SELECT vehicle_id, CAST(count(*) AS BIGINT) AS n_pings,
           {oracle.ts_text('min(recorded_at)')} AS first_ping, {oracle.ts_text('max(recorded_at)')} AS last_ping,
           {oracle.dec_round('avg(speed_kmh)', 6)} AS avg_speed_kmh
    FROM wh GROUP BY vehicle_id"""))
def pings_per_vehicle(spark, sf_dir):
    """Per vehicle: ping count, first and last ping, mean speed."""
    from roadlens.functions.congestion import round_dec
    return (base.warehouse_pings(spark, sf_dir).groupBy("vehicle_id")
            .agg(F.count(F.lit(1)).alias("n_pings"), F.min("recorded_at").alias("f"),
                 F.max("recorded_at").alias("l"), F.avg("speed_kmh").alias("a"))
            .select("vehicle_id", "n_pings", ts_text("f").alias("first_ping"),
                    ts_text("l").alias("last_ping"), round_dec("a", 6).alias("avg_speed_kmh")))


ONE_VEHICLE, ONE_LIGHT = "GPS_7", "TL003"
LIGHT_FROM, LIGHT_UNTIL = "2026-01-09 06:00:00", "2026-01-12 09:30:00"


def _ping_store(spark, sf_dir):
    root = scratch_path(spark, "point-reads")
    warehouse.write(base.warehouse_pings(spark, sf_dir), root)
    return root


@register("vehicle_pings", oracle.with_ctes(f"""
    SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at, latitude, longitude, speed_kmh, traffic_light_id
    FROM wh WHERE gps_id = '{ONE_VEHICLE}'"""))
def vehicle_pings(spark, sf_dir):
    """The pings of one vehicle over time, from the store (Bloom filters skip row groups without it)."""
    rows = warehouse.vehicle_pings(spark, _ping_store(spark, sf_dir), ONE_VEHICLE)
    return rows.orderBy("recorded_at").select("gps_id", ts_text("recorded_at").alias("recorded_at"), "latitude", "longitude", "speed_kmh", "traffic_light_id")


@register("light_pings", oracle.with_ctes(f"""
    SELECT traffic_light_id, {oracle.ts_text('recorded_at')} AS recorded_at, gps_id, speed_kmh
    FROM wh WHERE traffic_light_id = '{ONE_LIGHT}' AND recorded_at >= TIMESTAMP '{LIGHT_FROM}' AND recorded_at < TIMESTAMP '{LIGHT_UNTIL}'"""))
def light_pings(spark, sf_dir):
    """The pings at one light between two instants, from the store (days pruned by folder, hours by row group)."""
    rows = warehouse.light_pings(spark, _ping_store(spark, sf_dir), ONE_LIGHT, LIGHT_FROM, LIGHT_UNTIL)
    return rows.orderBy("recorded_at").select("traffic_light_id", ts_text("recorded_at").alias("recorded_at"), "gps_id", "speed_kmh")


@register("pings_per_light", oracle.with_ctes(f"""
    SELECT traffic_light_id, {oracle.ts_text("date_trunc('hour', recorded_at)")} AS hour_start,
           CAST(count(*) AS BIGINT) AS n_pings, CAST(count(DISTINCT gps_id) AS BIGINT) AS n_vehicles
    FROM wh GROUP BY ALL"""))
def pings_per_light(spark, sf_dir):
    """Per light and hour: pings and distinct vehicles (NULL light kept as its own group)."""
    return (base.warehouse_pings(spark, sf_dir)
            .groupBy("traffic_light_id", ts_text("date_trunc('hour', recorded_at)").alias("hour_start"))
            .agg(F.count(F.lit(1)).alias("n_pings"), F.count_distinct("gps_id").alias("n_vehicles")))


@register("light_enriched", oracle.with_ctes(f"""
    SELECT p.gps_id, {oracle.ts_text('p.recorded_at')} AS recorded_at, p.traffic_light_id,
           l.intersection_id, i.intersection_name, i.description,
           l.latitude AS light_latitude, l.longitude AS light_longitude
    FROM wh p LEFT JOIN lights l ON l.traffic_light_id = p.traffic_light_id
    LEFT JOIN inters i ON i.intersection_id = l.intersection_id"""))
def light_enriched(spark, sf_dir):
    """Pings with their light's intersection (broadcast joins on the bounded dims)."""
    p = enrich.with_light_info(base.warehouse_pings(spark, sf_dir), dimensions.traffic_lights(spark),
                               dimensions.intersections(spark))
    return p.select("gps_id", ts_text("recorded_at").alias("recorded_at"), "traffic_light_id",
                    "intersection_id", "intersection_name", "description", "light_latitude",
                    "light_longitude")


@register("ping_count", oracle.with_ctes("SELECT CAST(count(*) AS BIGINT) AS n_pings FROM wh"))
def ping_count(spark, sf_dir):
    """Total stored pings (health check count)."""
    return base.warehouse_pings(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_pings"))


@register("legacy_projection", oracle.with_ctes(f"""
    SELECT sha256(vehicle_id || '|' || strftime(recorded_at, '%Y-%m-%d %H:%M:%S.%f')) AS legacy_id, vehicle_id,
           {oracle.ts_text('recorded_at')} AS timestamp, CAST(NULL AS DOUBLE) AS speed_kmh,
           CAST(NULL AS DOUBLE) AS heading, longitude, latitude
    FROM wh"""))
def legacy_projection(spark, sf_dir):
    """Legacy ping table view: stable generated id, speed and heading NULL, point columns."""
    p = base.warehouse_pings(spark, sf_dir)
    t = ts_text("recorded_at")
    instant = F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return p.select(F.sha2(F.concat_ws("|", "vehicle_id", instant), 256).alias("legacy_id"), "vehicle_id",
                    t.alias("timestamp"), F.lit(None).cast("double").alias("speed_kmh"),
                    F.lit(None).cast("double").alias("heading"), "longitude", "latitude")


# ------------------------------------------------------------------ trajectories

SESSION_GAP_S = 30


@register("downsample_5s", oracle.with_ctes(f"""
    SELECT gps_id, {oracle.ts_text('b')} AS bucket_start, {oracle.ts_text('recorded_at')} AS recorded_at,
           latitude, longitude, speed_kmh
    FROM (SELECT *, time_bucket(INTERVAL 5 SECONDS, recorded_at) AS b,
                 row_number() OVER (PARTITION BY gps_id, time_bucket(INTERVAL 5 SECONDS, recorded_at)
                                    ORDER BY recorded_at) AS rn FROM wh) WHERE rn = 1"""))
def downsample_5s(spark, sf_dir):
    """First ping per vehicle and 5-second bucket (the phone's sampling cadence)."""
    return trajectory.downsample(base.warehouse_pings(spark, sf_dir), 5)


_SESS_SQL = f"""
sess AS (
    SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(recorded_at) - epoch_us(prev) > {SESSION_GAP_S} * 1000000
                       THEN 1 ELSE 0 END)
              OVER (PARTITION BY gps_id ORDER BY recorded_at ROWS UNBOUNDED PRECEDING) AS sid
    FROM (SELECT *, lag(recorded_at) OVER (PARTITION BY gps_id ORDER BY recorded_at) AS prev FROM wh)),
runs AS (
    SELECT gps_id, min(recorded_at) AS f, max(recorded_at) AS l, count(*) AS n,
           arg_min(latitude, recorded_at) AS slat, arg_min(longitude, recorded_at) AS slon,
           arg_max(latitude, recorded_at) AS clat, arg_max(longitude, recorded_at) AS clon
    FROM sess GROUP BY gps_id, sid)"""


@register("route_sessions", oracle.with_ctes(f"""
    SELECT gps_id, {oracle.ts_text('f')} AS session_start, {oracle.ts_text('l')} AS last_ping,
           slat AS start_latitude, slon AS start_longitude, clat AS current_latitude, clon AS current_longitude
    FROM runs""", extra=_SESS_SQL))
def route_sessions(spark, sf_dir):
    """Per run (30 s gap sessions): start marker and current marker positions."""
    return trajectory.sessions(base.warehouse_pings(spark, sf_dir), SESSION_GAP_S).select(
        "gps_id", "session_start", "last_ping", "start_latitude", "start_longitude",
        "current_latitude", "current_longitude")


@register("run_summary", oracle.with_ctes(f"""
    SELECT gps_id, {oracle.ts_text('f')} AS session_start, {oracle.ts_text('l')} AS last_ping,
           CAST(n AS INTEGER) AS n_points, CAST((epoch_us(l) - epoch_us(f)) // 1000000 AS INTEGER) AS duration_s
    FROM runs""", extra=_SESS_SQL))
def run_summary(spark, sf_dir):
    """Per run: point count, first and last ping, duration in seconds."""
    return trajectory.sessions(base.warehouse_pings(spark, sf_dir), SESSION_GAP_S).select(
        "gps_id", "session_start", "last_ping", "n_points", "duration_s")


@register("run_samples", oracle.with_ctes("""
    SELECT gps_id, strftime(run_start, '%Y-%m-%d %H:%M:%S.%f') AS run_start, CAST(k + 1 AS INTEGER) AS sample,
           strftime(recorded_at, '%Y-%m-%d %H:%M:%S.%f') AS recorded_at, latitude, longitude, speed_kmh
    FROM (SELECT *, (epoch_us(recorded_at) - epoch_us(run_start)) // 5000000 AS k
          FROM (SELECT *, min(recorded_at) OVER (PARTITION BY gps_id, sid) AS run_start FROM sess))
    WHERE k < 6 QUALIFY row_number() OVER (PARTITION BY gps_id, sid, k ORDER BY recorded_at) = 1""", extra=_SESS_SQL))
def run_samples(spark, sf_dir):
    """What a phone sends of each run: a ping at its start and every 5 s from there, six at most."""
    micros = "date_format({0}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {0}"
    return trajectory.run_samples(base.warehouse_pings(spark, sf_dir), SESSION_GAP_S).selectExpr(
        "gps_id", micros.format("run_start"), "sample", micros.format("recorded_at"), "latitude", "longitude", "speed_kmh")


@register("route_points", oracle.with_ctes(f"""
    SELECT gps_id, strftime(min(recorded_at) OVER (PARTITION BY gps_id, sid), '%Y-%m-%d %H:%M:%S.%f') AS run_start,
           strftime(recorded_at, '%Y-%m-%d %H:%M:%S.%f') AS recorded_at, latitude, longitude, speed_kmh
    FROM sess""", extra=_SESS_SQL))
def route_points(spark, sf_dir):
    """The points of every run, one row per point with its run; in order of time they are the route."""
    micros = "date_format({0}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {0}"
    return trajectory.route_points(base.warehouse_pings(spark, sf_dir), SESSION_GAP_S).selectExpr(
        "gps_id", micros.format("run_start"), micros.format("recorded_at"), "latitude", "longitude", "speed_kmh")


@register("marker_feed", oracle.with_ctes(f"""
    SELECT gps_id, vehicle_id, {oracle.ts_text('recorded_at')} AS recorded_at, latitude, longitude,
           printf('{trajectory.POPUP_FMT.replace("%s", "%s")}', gps_id, vehicle_id,
                  printf('%.1f', {oracle.dec_round('speed_kmh', 1)}), '{trajectory.NA}',
                  {oracle.ts_text('recorded_at')}) AS popup
    FROM wh"""))
def marker_feed(spark, sf_dir):
    """Map marker per ping with the popup text (speed one decimal, accuracy N/A)."""
    return trajectory.marker_feed(base.warehouse_pings(spark, sf_dir))


@register("phone_marker_feed", oracle.with_ctes(f"""
    SELECT 'G' || CAST(src_row AS VARCHAR) AS gps_id, gps_id AS vehicle_id, strftime(CAST(received_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS recorded_at,
           {oracle.dec_round('latitude', 6)} AS latitude, {oracle.dec_round('longitude', 6)} AS longitude,
           printf('{trajectory.POPUP_FMT}', 'G' || CAST(src_row AS VARCHAR), gps_id,
                  printf('%.1f', {oracle.dec_round(oracle.dec_round(f"GREATEST(0.0, LEAST({oracle.dec_round('speed_kmh', 4)}, 200.0))", 2), 1)}),
                  printf('%.1f', CAST(src_row % 17 AS DOUBLE) / 2.0), strftime(CAST(received_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')) AS popup
    FROM raw WHERE src_file = 0 AND latitude BETWEEN -90 AND 90 AND longitude IS NOT NULL"""))
def phone_marker_feed(spark, sf_dir):
    """Map markers of the phones' pings, whose popups show their accuracy."""
    out = decode.decode_requests(fixtures.phone_requests(spark, sf_dir), received_at=f"'{RECEIVED_AT}'", speed_unit="km/h")
    return trajectory.marker_feed(out.filter("reject_reason IS NULL").withColumn("recorded_at", F.expr("try_cast(timestamp AS TIMESTAMP)")), "accuracy_m")


# ------------------------------------------------------------------ loading, retention, quality

FIRST_LOAD_BEFORE = "2026-01-10 00:00:00"


WH_ORDER = ["speed_kmh", "latitude", "longitude"]  # offered rows are unique per key here; any total order will do


@register("load_idempotent", oracle.with_ctes(f"""
    SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at, speed_kmh,
           CASE WHEN recorded_at < TIMESTAMP '{FIRST_LOAD_BEFORE}' THEN 1 ELSE 2 END AS load_batch
    FROM wh"""))
def load_idempotent(spark, sf_dir):
    """Two overlapping loads (the first days, then everything) with insert-or-ignore on the key."""
    pings = base.warehouse_pings(spark, sf_dir)
    first = pings.filter(F.col("recorded_at") < F.to_timestamp(F.lit(FIRST_LOAD_BEFORE)))
    added = load.insert_or_ignore(first, pings, ["gps_id", "recorded_at"], WH_ORDER)
    stored = first.withColumn("load_batch", F.lit(1)).unionByName(added.withColumn("load_batch", F.lit(2)))
    return stored.select("gps_id", ts_text("recorded_at").alias("recorded_at"), "speed_kmh", "load_batch")


@register("warehouse_load", oracle.with_ctes(
    f"SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at, speed_kmh FROM wh_all"))
def warehouse_load(spark, sf_dir):
    """Loads into a stored table: the first days, then everything, then everything again; each key is stored once.

    The offered rows are validated pings with their copies; the first copy in lake order is the one stored.
    """
    root = scratch_path(spark, "warehouse-load")
    offered = enrich.enrich(clean_ops.valid(base.raw_pings(spark, sf_dir)))
    for batch in (offered.filter(f"recorded_at < TIMESTAMP '{FIRST_LOAD_BEFORE}'"), offered, offered):
        warehouse.load(batch, root, ["src_file", "src_row"])
    return warehouse.read(spark, root).select("gps_id", ts_text("recorded_at").alias("recorded_at"), "speed_kmh")


@register("table_load", oracle.with_ctes(
    f"SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at, speed_kmh FROM wh_all"))
def table_load(spark, sf_dir):
    """The same loads into a table in buckets of the key, whose stored rows are never shuffled."""
    path = scratch_path(spark, "ping-table")
    table = "pings_" + path.rsplit("-", 1)[1]
    offered = enrich.enrich(clean_ops.valid(base.raw_pings(spark, sf_dir)))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for batch in (offered.filter(f"recorded_at < TIMESTAMP '{FIRST_LOAD_BEFORE}'"), offered, offered):
        ping_table.load(batch, table, path, ["src_file", "src_row"], buckets)
    return spark.table(table).select("gps_id", ts_text("recorded_at").alias("recorded_at"), "speed_kmh")


# Pings that reach the warehouse only after the first verdict run (a late device).
LATE = "gps_id LIKE '%7'"


@register("verdict_load_idempotent", oracle.with_ctes("""
    SELECT *, 1 AS load_batch FROM early
    UNION ALL
    SELECT *, 2 AS load_batch FROM complete c
    WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.traffic_light_id = c.traffic_light_id AND e.analysis_time = c.analysis_time)""",
    extra=f"""
    complete AS ({oracle.verdict_select(oracle.window_stats(5), "strict")}),
    early AS ({oracle.verdict_select(oracle.window_stats(5).replace("FROM wh ", f"FROM (SELECT * FROM wh WHERE NOT {LATE}) "), "strict")})"""))
def verdict_load_idempotent(spark, sf_dir):
    """Result store: a run without the late device's pings, then one with them. The rerun computes other verdicts for
    keys that are stored, and the first ones stay; only new keys are added."""
    root = scratch_path(spark, "verdicts")
    pings = base.warehouse_pings(spark, sf_dir).select("gps_id", "recorded_at", "speed_kmh", *congestion.GROUP)
    pings = spark.read.schema(pings.schema).parquet(_written(pings, root + "-pings"))  # both runs read them
    sched = dimensions.light_schedule(spark)
    verdict_store.load(congestion.windowed(pings.filter(f"NOT {LATE}"), sched), root)
    first = verdict_store.read(spark, root).drop("day")
    keys = first.select(*verdict_store.KEY, F.lit(1).alias("first_run"))
    keys = spark.read.schema(keys.schema).parquet(_written(keys, root + "-keys"))
    complete = congestion.windowed(pings, sched)
    complete = spark.read.schema(complete.schema).parquet(_written(complete, root + "-complete"))
    verdict_store.load(complete, root)
    verdict_store.load(complete, root)
    stored = verdict_store.read(spark, root).drop("day").join(keys, verdict_store.KEY, "left")
    return stored.select(*congestion.VERDICT_COLS, F.when(F.col("first_run") == 1, 1).otherwise(2).alias("load_batch"))


def _written(df, path):
    df.write.parquet(path)
    return path


RETENTION_AS_OF = "2026-01-17 06:00:00"


@register("retention_7d", oracle.with_ctes(f"""
    SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at,
           recorded_at >= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 7 DAYS AS retained
    FROM wh"""))
def retention_7d(spark, sf_dir):
    """7-day retention at a fixed instant: strictly older rows are marked for deletion."""
    pings = base.warehouse_pings(spark, sf_dir)
    as_of = F.to_timestamp(F.lit(RETENTION_AS_OF))
    return pings.select("gps_id", ts_text("recorded_at").alias("recorded_at"),
                        (F.col("recorded_at") >= as_of - F.expr("INTERVAL 7 DAYS")).alias("retained"))


@register("retention_store", oracle.with_ctes(f"""
    SELECT env, gps_id, {oracle.ts_text('recorded_at')} AS recorded_at FROM wh, (VALUES ('mock'), ('prod')) e(env)
    WHERE env = 'prod' OR recorded_at >= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 7 DAYS"""))
def retention_store(spark, sf_dir):
    """The stored pings after retention: expired days are gone from the mock store, production keeps all."""
    root = scratch_path(spark, "retention")
    out = None
    warehouse.write(base.warehouse_pings(spark, sf_dir), f"{root}-prod")
    # the mock store gets the same pings, from where they are stored
    warehouse.write(warehouse.read(spark, f"{root}-prod").drop("ymd"), f"{root}-mock")
    for env in ("mock", "prod"):
        warehouse.retain(spark, f"{root}-{env}", RETENTION_AS_OF, env=env)
        part = warehouse.read(spark, f"{root}-{env}").select(F.lit(env).alias("env"), "gps_id", ts_text("recorded_at").alias("recorded_at"))
        out = part if out is None else out.unionByName(part)
    return out


def _null_sql(table: str, src: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, 'not_null:{c}' AS check_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {src}" for c in cols)


WH_NOT_NULL = ["gps_id", "recorded_at", "latitude", "longitude", "speed_kmh"]
RAW_NOT_NULL = ["gps_id", "timestamp", "latitude", "longitude"]


V_NOT_NULL = ["traffic_light_id", "analysis_time"]
LIGHT_NOT_NULL = ["traffic_light_id", "latitude", "longitude"]
SCHED_NOT_NULL = ["traffic_light_id", "start_sec", "end_sec", "red_duration", "applicable_days"]
TIME_NOT_NULL = ["time_id", "full_timestamp", "year", "month", "day", "hour", "day_of_week", "is_weekend", "day_type", "time_window", "season"]
INTER_NOT_NULL = ["intersection_id", "intersection_name"]
SCHED_KEY = ["traffic_light_id", "start_sec", "applicable_days"]
# (table, its SQL name, column, referenced SQL name) of every declared reference
REFERENCES = [
    ("vehicle_gps_offered", "wh_all", "traffic_light_id", "lights"), ("vehicle_gps_offered", "wh_all", "time_id", "td"),
    ("traffic_lights", "lights", "intersection_id", "inters"), ("light_schedule", "sched", "traffic_light_id", "lights"),
    ("congestion_analysis", "v", "traffic_light_id", "lights"), ("congestion_analysis", "v", "time_id", "td"),
]
UNIQUE = [
    ("vehicle_gps_offered", "enr", ["gps_id", "recorded_at"]), ("vehicle_gps", "wh", ["gps_id", "recorded_at"]),
    ("congestion_analysis", "v", ["traffic_light_id", "analysis_time"]), ("traffic_lights", "lights", ["traffic_light_id"]),
    ("light_schedule", "sched", SCHED_KEY), ("intersections", "inters", ["intersection_id"]),
    ("time_dimension", "td", ["time_id"]), ("time_dimension", "td", ["full_timestamp"]),
]
NOT_NULL = [
    ("lake_raw", "raw", RAW_NOT_NULL), ("vehicle_gps", "wh", WH_NOT_NULL), ("congestion_analysis", "v", V_NOT_NULL),
    ("traffic_lights", "lights", LIGHT_NOT_NULL), ("light_schedule", "sched", SCHED_NOT_NULL), ("intersections", "inters", INTER_NOT_NULL),
    ("time_dimension", "td", TIME_NOT_NULL),
]
# before the value is clamped, and after
LEVELS = [("congestion_offered", "lvl", "raw_level"), ("congestion_analysis", "v", "congestion_level")]


def _constraint_sql() -> str:
    parts = [_null_sql(t, src, cols) for t, src, cols in NOT_NULL]
    parts += [f"SELECT '{t}' AS table_name, 'unique:{','.join(k)}' AS check_name, CAST(count(*) AS BIGINT) AS violations "
              f"FROM (SELECT {', '.join(k)} FROM {src} GROUP BY ALL HAVING count(*) > 1)" for t, src, k in UNIQUE]
    parts += [f"SELECT '{t}', 'references:{c}', CAST(count(*) AS BIGINT) FROM {src} x WHERE {c} IS NOT NULL "
              f"AND NOT EXISTS (SELECT 1 FROM {ref} r WHERE r.{c} = x.{c})" for t, src, c, ref in REFERENCES]
    parts += [f"SELECT '{t}', 'check:{c} in [0,100]', CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND NOT {c} BETWEEN 0 AND 100) AS BIGINT) "
              f"FROM {src}" for t, src, c in LEVELS]
    return oracle.with_ctes(" UNION ALL ".join(parts), extra=f"""
    v AS ({_flagship_sql()}), td AS ({dimensions.sql_time_dimension()}),
    lvl AS (SELECT (1.0 - mean_kmh / 50.0) * 100.0 AS raw_level FROM ({oracle.window_stats(5)}))""").replace(
        "FROM enr GROUP BY ALL", "FROM offered GROUP BY ALL").replace(
        "enr AS (", f"offered AS (SELECT gps_id, {oracle.instant('timestamp')} AS recorded_at FROM valid),\nenr AS (", 1)


@register("constraint_report", _constraint_sql())
def constraint_report(spark, sf_dir):
    """NOT NULL / unique / CHECK / reference violations per table (0 = constraint holds).

    Uniqueness is measured on the rows that are offered as well as on those stored, the level before it is clamped as
    well as after, so a violation in the input shows.
    """
    raw, wh_all, wh = base.pipeline(spark, sf_dir)
    sched = dimensions.light_schedule(spark)
    stats = congestion.group_stats(wh.withColumn("__w", F.window("recorded_at", "5 minutes")), ["__w"])
    tables = {"raw": raw, "wh": wh, "wh_all": wh_all, "enr": enrich.enrich(clean_ops.valid(raw)),
              "v": congestion.windowed(wh, sched, 5, mode="strict"), "lights": dimensions.traffic_lights(spark), "sched": sched,
              "inters": dimensions.intersections(spark), "td": dimensions.time_dimension(spark),
              "lvl": stats.withColumn("raw_level", F.expr("(1.0D - avg_speed / 50.0D) * 100.0D"))}
    parts = []
    for t, src in dict.fromkeys([(t, src) for t, src, *_ in (*NOT_NULL, *UNIQUE, *REFERENCES, *LEVELS)]):
        mine = lambda rules: [r[2:] for r in rules if r[:2] == (t, src)]  # noqa: B023, E731
        keys = mine(UNIQUE) or [([],)]
        refs = [(c, tables[ref], c) for c, ref in mine(REFERENCES)]
        parts.append(quality.report(tables[src], t, quality.Rules([c for cols, in mine(NOT_NULL) for c in cols], keys[0][0],
                                                                  [(c, 0, 100) for c, in mine(LEVELS)], refs)))
        parts += [quality.report(tables[src], t, quality.Rules(unique=k)) for k, in keys[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


LAKE_RANGES = [("latitude", -90, 90), ("longitude", -180, 180), ("speed_kmh", 0, 200)]


def _violations_sql() -> str:
    text = lambda rules: "[x FOR x IN [" + ", ".join(f"CASE WHEN {e} THEN '{n}' END" for n, e in rules) + "] IF x IS NOT NULL]"
    lake_rules = [(f"not_null:{c}", f"{c} IS NULL") for c in RAW_NOT_NULL]
    lake_rules += [(f"check:{c} in [{lo},{hi}]", f"{c} IS NOT NULL AND ({c} < {lo} OR {c} > {hi})") for c, lo, hi in LAKE_RANGES]
    offered = [("references:traffic_light_id", "traffic_light_id IS NOT NULL AND traffic_light_id NOT IN (SELECT traffic_light_id FROM lights)"),
               ("unique:gps_id,recorded_at", "count(*) OVER (PARTITION BY gps_id, recorded_at) > 1")]
    at = oracle.instant("timestamp")
    return oracle.with_ctes(f"""
    SELECT table_name, row_key, array_to_string(r, '; ') AS rules FROM (
        SELECT 'lake_raw' AS table_name, src_file || ':' || gps_id || ':' || src_row AS row_key, {text(lake_rules)} AS r FROM raw
        UNION ALL
        SELECT 'vehicle_gps_offered', src_file || ':' || gps_id || ':' || src_row, {text(offered)}
        FROM (SELECT src_file, src_row, gps_id, NULLIF(traffic_light_id, 'unknown') AS traffic_light_id, {at} AS recorded_at FROM valid))
    WHERE len(r) > 0""")


@register("constraint_violations", _violations_sql())
def constraint_violations(spark, sf_dir):
    """The rows that break a constraint, each with all rules that it breaks: raw pings, and those offered to the warehouse."""
    raw = base.raw_pings(spark, sf_dir)
    key = "concat_ws(':', src_file, gps_id, src_row)"
    lake_rules = quality.Rules(RAW_NOT_NULL, (), LAKE_RANGES)
    offered = quality.Rules(unique=["gps_id", "recorded_at"], references=[("traffic_light_id", dimensions.traffic_lights(spark), "traffic_light_id")])
    out = quality.violations(raw, "lake_raw", key, lake_rules).unionByName(
        quality.violations(enrich.enrich(clean_ops.valid(raw)), "vehicle_gps_offered", key, offered))
    return out.select("table_name", "row_key", F.array_join("rules", "; ").alias("rules"))


@register("load_audit", oracle.with_ctes(f"""
    SELECT 'rows_offered' AS metric, CAST(count(*) AS BIGINT) AS value FROM raw
    UNION ALL SELECT 'rows_valid', CAST(count(*) AS BIGINT) FROM valid
    UNION ALL SELECT 'rows_rejected_rule', CAST(count(*) AS BIGINT) FROM raw WHERE NOT ({oracle.VALID_PRED})
    UNION ALL SELECT 'rows_bad_timestamp', CAST(count(*) FILTER (WHERE try_cast(timestamp AS TIMESTAMP) IS NULL AND timestamp IS NOT NULL) AS BIGINT) FROM raw
    UNION ALL SELECT 'files_offered', CAST(count(DISTINCT src_file) AS BIGINT) FROM raw
    UNION ALL SELECT 'rows_duplicate', (SELECT count(*) FROM valid) - (SELECT count(*) FROM wh_all)
    UNION ALL SELECT 'rows_loaded', CAST(count(*) AS BIGINT) FROM wh_all
    UNION ALL SELECT 'rows_without_light', CAST(count(*) FILTER (WHERE traffic_light_id IS NULL) AS BIGINT) FROM wh_all
    UNION ALL SELECT 'rows_unknown_light', CAST(count(*) FILTER (WHERE traffic_light_id IS NOT NULL
        AND traffic_light_id NOT IN (SELECT traffic_light_id FROM lights)) AS BIGINT) FROM wh_all
    UNION ALL SELECT 'results_written', CAST(count(*) AS BIGINT) FROM v""",
    extra=f"v AS ({_flagship_sql()})"))
def load_audit(spark, sf_dir):
    """Load metrics: offered, valid, rejected, loaded, no-light and unknown-light rows, results."""
    raw, wh_all, wh = base.pipeline(spark, sf_dir)
    reason = clean_ops.reject_reason(raw)
    m1 = load.metrics_table([("rows_offered", F.count(F.lit(1))),
                             ("rows_valid", F.count_if(reason.isNull())),
                             ("rows_rejected_rule", F.count_if(reason.isNotNull())),
                             ("rows_bad_timestamp", F.count_if(F.col("timestamp").isNotNull() & F.expr("try_cast(timestamp AS TIMESTAMP) IS NULL"))),
                             ("files_offered", F.count_distinct("src_file"))], raw)
    # copies: one row less than there are offered, for every key
    keys = enrich.enrich(clean_ops.valid(raw)).groupBy("gps_id", "recorded_at").agg(F.count(F.lit(1)).alias("n"))
    m1 = m1.unionByName(load.metrics_table([("rows_duplicate", F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))], keys))
    flagged = enrich.flag_known_lights(wh_all, dimensions.traffic_lights(spark))
    m2 = load.metrics_table([("rows_loaded", F.count(F.lit(1))),
                             ("rows_without_light", F.count_if(F.col("traffic_light_id").isNull())),
                             ("rows_unknown_light", F.count_if(~F.col("light_known")))], flagged)
    v = congestion.windowed(wh, dimensions.light_schedule(spark), 5, mode="strict")
    m3 = load.metrics_table([("results_written", F.count(F.lit(1)))], v)
    return m1.unionByName(m2).unionByName(m3)


# ------------------------------------------------------------------ lake

# Lake partitions are by the day of reception: a ping's own timestamp may not parse.
RECEIVED = "try_to_timestamp(received_at)"


def _lake_from_raw(spark, sf_dir, env_col):
    """Write the raw pings to a fresh lake folder (partitions by day of reception) and read it back."""
    root = scratch_path(spark, "lake")
    raw = base.raw_pings(spark, sf_dir)
    lake.write(lake.with_partitions(raw, env_col, F.expr(RECEIVED)), root)
    return lake.read(spark, root)


LAKE_COLS = [f.name for f in lake.LAKE_SCHEMA.fields]
_LAKE_SQL_COLS = ("gps_id, timestamp, latitude, longitude, speed_kmh, traffic_light_id, day_type, "
                  "time_window, received_at")


@register("lake_roundtrip", oracle.with_ctes(f"""
    SELECT {_LAKE_SQL_COLS}, 'prod' AS env, CAST(year(CAST(received_at AS TIMESTAMP)) AS INTEGER) AS year,
           CAST(month(CAST(received_at AS TIMESTAMP)) AS INTEGER) AS month,
           CAST(day(CAST(received_at AS TIMESTAMP)) AS INTEGER) AS day
    FROM raw"""))
def lake_roundtrip(spark, sf_dir):
    """Raw pings written to the partitioned Parquet lake and read back with the fixed schema."""
    back = _lake_from_raw(spark, sf_dir, F.lit("prod"))
    return back.drop("src_file", "src_row")


@register("env_union", oracle.with_ctes("""
    SELECT CASE WHEN src_file = 0 THEN 'prod' ELSE 'mock' END AS env, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(DISTINCT gps_id) AS BIGINT) AS n_vehicles
    FROM raw GROUP BY ALL"""))
def env_union(spark, sf_dir):
    """Production and mock streams side by side in one lake; per-env counts via partition pruning."""
    env = F.when(F.col("src_file") == 0, F.lit("prod")).otherwise(F.lit("mock"))
    back = _lake_from_raw(spark, sf_dir, env)
    prod = back.filter(F.col("env") == "prod")
    mock = back.filter(F.col("env") == "mock")
    return (prod.unionByName(mock).groupBy("env")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("gps_id").alias("n_vehicles")))


SECOND_LOAD_FROM = "2026-01-10"


@register("lake_incremental", oracle.with_ctes(f"""
    SELECT {_LAKE_SQL_COLS} FROM raw WHERE NOT (received_at < '{SECOND_LOAD_FROM}')"""))
def lake_incremental(spark, sf_dir):
    """Two lake loads; the ETL run after the second one opens only the files that the first run's manifest lacks."""
    root = scratch_path(spark, "lake-incr")
    raw = base.raw_pings(spark, sf_dir)
    first = F.col("received_at") < F.lit(SECOND_LOAD_FROM)
    for run, part in enumerate((first, ~first)):
        lake.write(lake.with_partitions(raw.filter(part), F.lit("prod"), F.expr(RECEIVED)), root)
        found = lake.record(lake.discover(spark, root, root + "-seen", env="prod"), root + "-seen", str(run))
    return lake.read_files(spark, root, found).select(*LAKE_COLS)


@register("lake_write_metrics", oracle.with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS metric, CAST({e} AS BIGINT) AS value FROM raw" for n, e in lake.WRITE_METRICS.items())))
def lake_write_metrics(spark, sf_dir):
    """Load metrics observed while writing the raw pings to the lake (no second pass)."""
    raw = base.raw_pings(spark, sf_dir)
    m = lake.write_observed(lake.with_partitions(raw, F.lit("prod"), F.expr(RECEIVED)),
                            scratch_path(spark, "lake-obs"))
    return spark.createDataFrame([(k, int(m[k])) for k in lake.WRITE_METRICS], "metric string, value bigint")


@register("verdict_from_store", oracle.with_ctes(
    oracle.verdict_select(oracle.snapshot_stats(base.AS_OF, False), "strict")))
def verdict_from_store(spark, sf_dir):
    """The warehouse job's snapshot read from the day-partitioned store.

    The trailing 5-minute frame is read with the day predicate added, so
    only files of the days that can hold recent rows are opened.
    """
    root = scratch_path(spark, "warehouse")
    warehouse.write(base.warehouse_pings(spark, sf_dir), root)
    recent = warehouse.read_since(spark, root, f"TIMESTAMP '{base.AS_OF}' - INTERVAL 5 MINUTES")
    return congestion.snapshot(recent, dimensions.light_schedule(spark), base.AS_OF, bound_above=False)


# ------------------------------------------------------------------ streaming (availableNow runs)

from roadlens.streaming import pipelines  # noqa: E402



INGEST_BATCHES = 4


def _ingest_run(spark, sf_dir, audit=False):
    """One ``availableNow`` run over the requests' files, a quarter of them a micro-batch."""
    d = scratch_path(spark, "ingest")
    # as many files as there are tasks; whole files are read, so they may be compressed
    fixtures.gps_requests(spark, sf_dir).select("value").write.option("compression", "snappy").text(d + "/requests")
    files = len(spark.read.text(d + "/requests").inputFiles())
    session = stream_session(spark)
    requests = pipelines.read_stream(session, "text", {"path": d + "/requests"}, max_files=-(-files // INGEST_BATCHES))
    listener = pipelines.StreamAudit(spark, d + "/audit") if audit else None
    if listener:
        session.streams.addListener(listener)
    pipelines.ingest(requests, d + "/lake", d + "/dead", d + "/ckpt", received_at=f"'{RECEIVED_AT}'").awaitTermination()
    if listener:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        session.streams.removeListener(listener)
    return d


@register("stream_ingest", oracle.with_ctes(f"""
    SELECT gps_id, timestamp, latitude, longitude, speed_kmh,
           COALESCE(light_t, 'unknown') AS traffic_light_id, COALESCE(day_t, 'weekday') AS day_type,
           COALESCE(tw_t, 'off_peak') AS time_window, '{RECEIVED_AT}' AS received_at
    FROM dec WHERE reject_reason IS NULL""", extra=_DECODE_SQL))
def stream_ingest(spark, sf_dir):
    """JSON request stream → decode → partitioned lake (availableNow run), read back."""
    d = _ingest_run(spark, sf_dir)
    return lake.read(spark, d + "/lake", with_order=False).select(*LAKE_COLS)


@register("stream_audit", oracle.with_ctes("""
    SELECT 'rows_in' AS metric, CAST(count(*) AS BIGINT) AS value FROM dec
    UNION ALL SELECT 'rows_accepted', CAST(count(*) FILTER (WHERE reject_reason IS NULL) AS BIGINT) FROM dec
    UNION ALL SELECT 'rows_malformed', CAST(count(*) FILTER (WHERE reject_reason IN ('malformed', 'empty')) AS BIGINT) FROM dec
    UNION ALL SELECT 'rows_invalid', CAST(count(*) FILTER (WHERE reject_reason NOT IN ('malformed', 'empty')) AS BIGINT) FROM dec""",
    extra=_DECODE_SQL))
def stream_audit(spark, sf_dir):
    """The audit table of the ingest stream: metrics observed in each micro-batch, summed over the run."""
    d = _ingest_run(spark, sf_dir, audit=True)
    return spark.read.schema(pipelines.AUDIT).parquet(d + "/audit/*/*").groupBy("metric").agg(F.sum("value").alias("value"))


@register("stream_dead_letters", oracle.with_ctes(
    "SELECT value, reject_reason FROM dec WHERE reject_reason IS NOT NULL", extra=_DECODE_SQL))
def stream_dead_letters(spark, sf_dir):
    """Rejected requests of the ingest stream, kept with their reason."""
    d = _ingest_run(spark, sf_dir)
    return spark.read.parquet(d + "/dead").select("value", "reject_reason")


BATCHES = 4


def _stream_over(spark, df, name, start, late=None):
    """Let ``df`` arrive in ``BATCHES`` slices of time and run a stream over it: ``start(stream, folder)`` resumes the
    query, which is drained after each slice. Rows that satisfy ``late`` (SQL text) come in one more slice at the end.

    Returns the folder, whose ``in`` has all rows. They are computed and written once, and read from there by all that
    follows; the slices are cut by the clock, so each is written by as many tasks as it has partitions.
    """
    d = scratch_path(spark, name)
    df.write.parquet(d + "/all")
    every = spark.read.schema(df.schema).parquet(d + "/all")
    ends = every.selectExpr("unix_micros(min(recorded_at)) AS a", "unix_micros(max(recorded_at)) AS b").first()
    low, span = ends["a"] or 0, (ends["b"] or 0) - (ends["a"] or 0) + 1
    part = f"CAST((unix_micros(recorded_at) - {low}) * {BATCHES} div {span} AS INT)"
    part = f"CASE WHEN {late} THEN {BATCHES} ELSE {part} END" if late else part
    session = stream_session(spark)
    for k in range(BATCHES + bool(late)):
        every.filter(f"{part} = {k}").write.mode("append").parquet(d + "/in")
        start(session.readStream.schema(df.schema).parquet(d + "/in"), d).awaitTermination()
    return d


def _arrived(spark, d, like):
    """All rows that a stream was given, from the folder that it read."""
    return spark.read.schema(like.schema).parquet(d + "/in")


def _append(transform):
    """``start`` of a query that appends Parquet files."""
    def start(stream, d):
        return (transform(stream).writeStream.outputMode("append").format("parquet").option("path", d + "/out")
                .option("checkpointLocation", d + "/ckpt").trigger(availableNow=True).start())
    return start


def _emitted(spark, d, like):
    return spark.read.schema(like.schema).parquet(d + "/out") if exists(spark, d + "/out") else like.limit(0)


def _stream_verdicts(spark, sf_dir, name, slide=None):
    def start(stream, d):
        session = stream.sparkSession
        # stream-static broadcast join against the bounded light dimension (quarantine)
        flagged = enrich.flag_known_lights(stream, dimensions.traffic_lights(session)).filter("light_known")
        return pipelines.verdicts(flagged, dimensions.light_schedule(session), d + "/out", d + "/ckpt", slide=slide)

    pings = base.warehouse_all(spark, sf_dir).select("gps_id", "recorded_at", "speed_kmh", *congestion.GROUP)
    d = _stream_over(spark, pings, name, start)
    known, _ = enrich.quarantine_unknown_lights(_arrived(spark, d, pings), dimensions.traffic_lights(spark))
    complete = congestion.windowed(known, dimensions.light_schedule(spark), 5, slide)
    return pipelines.catch_up(_emitted(spark, d, complete).select(*congestion.VERDICT_COLS), complete, verdict_store.KEY)


@register("stream_verdicts", oracle.with_ctes("SELECT * FROM v", extra=f"v AS ({_flagship_sql()})"))
def stream_verdicts(spark, sf_dir):
    """Streaming 5-minute verdicts over several micro-batches (watermark, append, foreachBatch sink), then the batch catch-up."""
    return _stream_verdicts(spark, sf_dir, "stream-verdicts")


@register("stream_verdicts_sliding", oracle.with_ctes(oracle.verdict_select(oracle.window_stats(5, 1), "strict")))
def stream_verdicts_sliding(spark, sf_dir):
    """The job's own cadence as a stream: 5-minute windows every minute."""
    return _stream_verdicts(spark, sf_dir, "stream-sliding", slide=1)


def _valid_stream_rows(spark, sf_dir):
    return enrich.enrich(clean_ops.valid(base.raw_pings(spark, sf_dir))).drop("geom")


@register("stream_load", oracle.with_ctes(
    f"SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at, speed_kmh FROM wh_all"))
def stream_load(spark, sf_dir):
    """Streaming warehouse load: insert-or-ignore per micro-batch. Copies and pings that come late are held to the end,
    so the stored copy is the first one and no late ping is lost; all rows are then replayed and add nothing."""
    point = "named_struct('lon', longitude, 'lat', latitude, 'srid', 4326) AS geom"
    rows = _valid_stream_rows(spark, sf_dir)

    def start(stream, d):
        return (stream.selectExpr("*", point).writeStream.foreachBatch(warehouse.load_batches(d + "/store", ["src_file", "src_row"]))
                .option("checkpointLocation", d + "/ckpt").trigger(availableNow=True).start())

    d = _stream_over(spark, rows, "stream-load", start, late="src_file = 1 OR gps_id LIKE '%3'")
    replayed = spark.read.schema(rows.schema).parquet(d + "/in").selectExpr("*", point)
    warehouse.load_batches(d + "/store", ["src_file", "src_row"])(replayed, BATCHES)
    return warehouse.read(spark, d + "/store").select("gps_id", ts_text("recorded_at").alias("recorded_at"), "speed_kmh")


@register("stream_dedupe", oracle.with_ctes(
    f"SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at FROM wh_all"))
def stream_dedupe(spark, sf_dir):
    """Streaming dedupe on (gps_id, recorded_at) within the watermark, first arrival at once; then the batch catch-up."""
    keys = ["gps_id", "recorded_at"]
    rows = _valid_stream_rows(spark, sf_dir).select(*keys)
    d = _stream_over(spark, rows, "stream-dedupe", _append(pipelines.dedupe))
    out = pipelines.catch_up(_emitted(spark, d, rows), _arrived(spark, d, rows).distinct(), keys)
    return out.select("gps_id", ts_text("recorded_at").alias("recorded_at"))


FIRST = ["gps_id", "recorded_at", "src_file", "src_row"]


@register("stream_keep_first", oracle.with_ctes(
    f"SELECT gps_id, {oracle.ts_text('recorded_at')} AS recorded_at, speed_kmh FROM wh_all"))
def stream_keep_first(spark, sf_dir):
    """Skew-safe streaming keep-first (append aggregation, first copy by lake order), then the batch catch-up."""
    rows = _valid_stream_rows(spark, sf_dir)
    d = _stream_over(spark, rows, "stream-keep-first", _append(pipelines.keep_first_stream))
    first = keep_first(_arrived(spark, d, rows).select(*FIRST, "speed_kmh"), FIRST[:2], FIRST[2:])
    complete = first.select("gps_id", "recorded_at", "speed_kmh")
    out = pipelines.catch_up(_emitted(spark, d, complete), complete, ["gps_id", "recorded_at"])
    return out.select("gps_id", ts_text("recorded_at").alias("recorded_at"), "speed_kmh")


@register("stream_sessions", oracle.with_ctes(f"""
    SELECT gps_id, {oracle.ts_text('f')} AS session_start, {oracle.ts_text('l')} AS last_ping,
           CAST(n AS BIGINT) AS n_points
    FROM runs""", extra=_SESS_SQL))
def stream_sessions(spark, sf_dir):
    """Streaming 30 s gap sessions per vehicle, closed by the watermark, then the batch catch-up for the open ones."""
    pings = base.warehouse_pings(spark, sf_dir).select("gps_id", "recorded_at", "latitude", "longitude")
    d = _stream_over(spark, pings, "stream-sessions", _append(lambda s: pipelines.sessions(s, SESSION_GAP_S)))
    complete = trajectory._runs(_arrived(spark, d, pings), SESSION_GAP_S, "gps_id", None).selectExpr("gps_id", "f AS first_ping", "l AS last_ping", "n AS n_points")
    out = pipelines.catch_up(_emitted(spark, d, complete), complete, ["gps_id", "first_ping"])
    return out.select("gps_id", ts_text("first_ping").alias("session_start"), ts_text("last_ping").alias("last_ping"), "n_points")
