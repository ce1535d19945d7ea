"""Decode and validate JSON ping requests / queue messages held in a column.

Input: any DataFrame (batch or streaming) with a ``value`` STRING column of
JSON text. :func:`decode_requests` adds the typed message columns and a
``reject_reason`` (NULL when accepted); :func:`accepted` / :func:`rejected`
split on it, so accepted + rejected = input.

Rules in gateway order: not a JSON object → ``malformed``; an empty object →
``empty``; gps_id/timestamp/latitude/longitude absent *or null* →
``missing_field`` (the gateway lets an explicit null through as the text
``None``; rejecting it is a deliberate change); latitude/longitude not a
number → ``not_a_number``; outside [-90, 90] / [-180, 180] (NaN included) →
``coordinates``; speed not a number → ``not_a_number``. Speed arrives in m/s
(``speed_unit``) and is stored as km/h clamped to [0, 200], NaN → 0, rounded
to 2 places HALF_UP. Missing optional keys get defaults.

The body must be one JSON object and nothing else: single quotes, or text
after the object (brackets that close the parser's own wrapping included), make it ``malformed``. Numbers are read as text (``"21.08"``
is accepted like ``21.08``), must look like decimal numbers or NaN/Infinity
(``"21.0d"`` does not), then are cast with ``try_cast``; a bare ``NaN`` token
comes back quoted and is unquoted first.

The key that holds the speed and the unit it is in are separate parameters:
the gateway sends ``speed`` in m/s, the phone ``speed`` in km/h, a queue
message ``speed_kmh`` in km/h. The vehicle is read from ``vehicle_id`` (queue
message) or ``device_id`` (requests).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.congestion import round_dec_sql

MESSAGE_COLS = ["gps_id", "vehicle_id", "timestamp", "latitude", "longitude", "speed_kmh",
                "traffic_light_id", "day_type", "time_window", "received_at"]

# FIXED VALUES: defaults for absent optional keys.
DEFAULT_LIGHT = "unknown"
DEFAULT_DAY_TYPE = "weekday"
DEFAULT_TIME_WINDOW = "off_peak"
MAX_SPEED_KMH = 200.0


def _num_sql(text: str) -> str:
    """Numeric text → DOUBLE (NULL if not a number); a quoted token is unquoted first."""
    plain = f"trim(CASE WHEN {text} LIKE '\"%\"' THEN substring({text}, 2, length({text}) - 2) ELSE {text} END)"
    return (f"CASE WHEN {plain} RLIKE '^[+-]?([0-9]+\\\\.?[0-9]*|\\\\.[0-9]+)([eE][+-]?[0-9]+)?$' "
            f"OR lower({plain}) RLIKE '^[+-]?(nan|inf|infinity)$' THEN try_cast({plain} AS DOUBLE) END")


def speed_to_kmh_sql(v: str, unit: str = "m/s") -> str:
    """Clamp to [0, 200] km/h, NaN → 0, round 2 (HALF_UP through DECIMAL).

    NULL stays NULL (GREATEST/LEAST skip NULLs, so it is tested first).
    """
    kmh = f"({v} * 3.6D)" if unit == "m/s" else v
    clamped = f"greatest(0.0D, least({kmh}, {MAX_SPEED_KMH!r}D))"
    return (f"CASE WHEN {v} IS NULL THEN CAST(NULL AS DOUBLE) WHEN isnan({v}) THEN 0.0D "
            f"ELSE {round_dec_sql(clamped, 2)} END")


def speed_to_kmh(v: str, unit: str = "m/s") -> Column:
    return F.expr(speed_to_kmh_sql(v, unit))


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def decode_requests(df: DataFrame, received_at: str | None = None, speed_unit: str = "m/s",
                    value_col: str = "value", speed_key: str = "speed") -> DataFrame:
    """Typed message columns plus ``reject_reason`` (NULL when accepted).

    ``received_at`` is SQL expression text (default: now, UTC ISO text). The
    body is parsed inside a generator (``explode`` of a one-element array):
    the optimizer neither copies a generator's input into later expressions nor
    pushes filters on its output below it, so each row is parsed once
    however many columns and filters use the result. The parse puts the body
    into an array, before an object with the body's digest: whatever the body closes or
    opens early, the array then lacks that object as its second and last element.
    Of a repeated key the last value counts, as in the reference's parser.
    """
    digest = "__digest"
    digested = df.selectExpr("*", f"explode(array(sha2(`{value_col}`, 256))) AS {digest}")
    wrapped = f"concat('[', `{value_col}`, ', {{\"end\": \"', {digest}, '\"}}]')"
    parse = f"from_json({wrapped}, 'array<map<string,string>>', map('allowSingleQuotes', 'false'))"
    parsed = digested.selectExpr("*", f"explode(array({parse})) AS __parsed")
    whole = f"size(__parsed) = 2 AND __parsed[1]['end'] = {digest}"
    # entries that no later one of the same key follows
    last = ("map_from_entries(filter(map_entries(__parsed[0]), (e, i) -> "
            "i = size(__parsed[0]) - array_position(reverse(map_keys(__parsed[0])), e.key)))")
    single = "size(array_distinct(map_keys(__parsed[0]))) = size(__parsed[0])"
    j = "__j"
    lat, lon = "__lat", "__lon"
    body = parsed.selectExpr(*[f"`{c}`" for c in df.columns],
                             f"explode(array(CASE WHEN {whole} THEN CASE WHEN {single} THEN __parsed[0] ELSE {last} END END)) AS __j")
    fields = body.selectExpr("*", f"{_num_sql(j + '[' + _lit('latitude') + ']')} AS __lat",
                             f"{_num_sql(j + '[' + _lit('longitude') + ']')} AS __lon",
                             f"{_num_sql(j + '[' + _lit(speed_key) + ']')} AS __spd")
    missing = " OR ".join(f"{j}['{k}'] IS NULL" for k in ("gps_id", "timestamp", "latitude", "longitude"))
    reason = (f"CASE WHEN {j} IS NULL THEN 'malformed' WHEN size({j}) = 0 THEN 'empty' "
              f"WHEN {missing} THEN 'missing_field' "
              f"WHEN {lat} IS NULL OR {lon} IS NULL THEN 'not_a_number' "
              f"WHEN NOT ({lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180) THEN 'coordinates' "
              f"WHEN {j}[{_lit(speed_key)}] IS NOT NULL AND __spd IS NULL THEN 'not_a_number' END")
    rec = received_at or "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")"
    return fields.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"{j}['gps_id'] AS gps_id",
        f"coalesce({j}['vehicle_id'], {j}['device_id']) AS vehicle_id",
        f"{j}['timestamp'] AS timestamp",
        f"{lat} AS latitude",
        f"{lon} AS longitude",
        f"coalesce({speed_to_kmh_sql('__spd', speed_unit)}, 0.0D) AS speed_kmh",
        f"coalesce({j}['traffic_light_id'], {_lit(DEFAULT_LIGHT)}) AS traffic_light_id",
        f"coalesce({j}['day_type'], {_lit(DEFAULT_DAY_TYPE)}) AS day_type",
        f"coalesce({j}['time_window'], {_lit(DEFAULT_TIME_WINDOW)}) AS time_window",
        f"coalesce({j}['received_at'], {rec}) AS received_at",
        f"{_num_sql(j + '[' + _lit('accuracy_m') + ']')} AS accuracy_m",
        f"{reason} AS reject_reason",
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter("reject_reason IS NULL").select(*MESSAGE_COLS)


def rejected(decoded: DataFrame, value_col: str = "value") -> DataFrame:
    return decoded.filter("reject_reason IS NOT NULL").select(value_col, "reject_reason")


def encode_message(df: DataFrame, key_col: str = "gps_id") -> DataFrame:
    """Queue record: ``key`` = gps_id, ``value`` = JSON of the message columns."""
    cols = [c for c in MESSAGE_COLS if c in df.columns]
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*cols)).alias("value"))
