"""Decode cases of FIXTURES.md §1 on the gateway decoder."""

from pyspark.sql import functions as F

from roadlens.sources.decode import accepted, decode_requests, rejected

BASE = '"gps_id": "G1", "timestamp": "2026-03-04 07:08:09", "latitude": 21.0, "longitude": 105.0'

CASES = {
    "{bad": "malformed",
    "[1]": "malformed",
    "": "malformed",
    "{}": "empty",
    '{"gps_id": "G1", "timestamp": "t", "latitude": 21.0}': "missing_field",
    '{"gps_id": null, "timestamp": "t", "latitude": 21.0, "longitude": 105.0}': "missing_field",
    '{"gps_id": "G1", "timestamp": "t", "latitude": 90, "longitude": 180}': None,
    '{"gps_id": "G1", "timestamp": "t", "latitude": -90, "longitude": -180}': None,
    '{"gps_id": "G1", "timestamp": "t", "latitude": 90.0001, "longitude": 1}': "coordinates",
    '{"gps_id": "G1", "timestamp": "t", "latitude": NaN, "longitude": 1}': "coordinates",
    '{"gps_id": "G1", "timestamp": "t", "latitude": "21.08", "longitude": 1}': None,
    '{"gps_id": "G1", "timestamp": "t", "latitude": "abc", "longitude": 1}': "not_a_number",
    "{" + BASE + ', "speed": "abc"}': "not_a_number",
    "{" + BASE + ', "accuracy_m": 5}': None,
    "{'gps_id': 'G1', 'timestamp': 't', 'latitude': 1, 'longitude': 1}": "malformed",
    "{" + BASE + "} trailing": "malformed",
    "{" + BASE + "}, {" + BASE + "}": "malformed",
    "{" + BASE + "}], [{}": "malformed",
    "{" + BASE + "}]} anything": "malformed",
    "{" + BASE + "}]": "malformed",
    "{" + BASE + '}],"w":[1]': "malformed",
    "{" + BASE + '}, {"end": "x"}] , [': "malformed",
    "{" + BASE + "}]}]}": "malformed",
    '{"latitude": "abc", ' + BASE + "}": None,
    "{" + BASE + ', "latitude": 91, "latitude": "abc"}': "not_a_number",
    '{"gps_id": "G1", "timestamp": "t", "latitude": "21.0d", "longitude": 1}': "not_a_number",
    '{"gps_id": "G1", "timestamp": "t", "latitude": " -2.5e1 ", "longitude": ".5"}': None,
}

SPEEDS = [("", 0.0), (', "speed": null', 0.0), (', "speed": 12.25', 44.1), (', "speed": -3', 0.0),
          (', "speed": 60', 200.0), (', "speed": NaN', 0.0)]


def test_reasons(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "value string")
    got = {r.value: r.reject_reason for r in decode_requests(df).collect()}
    assert got == CASES


def test_split_is_complete(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "value string")
    d = decode_requests(df)
    assert accepted(d).count() + rejected(d).count() == len(CASES)


def test_speed_and_defaults(spark):
    df = spark.createDataFrame([("{" + BASE + s + "}",) for s, _ in SPEEDS], "value string")
    rows = decode_requests(df).select("value", "speed_kmh", "traffic_light_id", "day_type",
                                      "time_window", "reject_reason").collect()
    want = {"{" + BASE + s + "}": v for s, v in SPEEDS}
    for r in rows:
        assert r.reject_reason is None
        assert r.speed_kmh == want[r.value], r.value
        assert (r.traffic_light_id, r.day_type, r.time_window) == ("unknown", "weekday", "off_peak")


def test_latitude_string_value(spark):
    df = spark.createDataFrame([('{"gps_id": "G", "timestamp": "t", "latitude": "21.08", "longitude": 1}',)],
                               "value string")
    assert decode_requests(df).select("latitude").first()[0] == 21.08


def test_last_of_repeated_keys_counts(spark):
    body = "{" + BASE + ', "latitude": 1.5, "speed": 1, "speed": 2, "latitude": 7.25, "gps_id": "G9"}'
    row = decode_requests(spark.createDataFrame([(body,)], "value string")).first()
    assert (row.gps_id, row.latitude, row.speed_kmh, row.longitude, row.reject_reason) == ("G9", 7.25, 7.2, 105.0, None)


def test_timestamp_forms(spark):
    from roadlens.functions.timeparts import parse_ts
    df = spark.createDataFrame([("2026-03-04 00:08:09",), ("2026-03-04T00:08:09",),
                                ("2026-03-04T07:08:09+07:00",)], "t string")
    got = {r[0] for r in df.select(F.date_format(parse_ts("t"), "yyyy-MM-dd HH:mm:ss")).collect()}
    assert got == {"2026-03-04 00:08:09"}


def test_timestamp_assume_zone(spark):
    """Zone-less text is read in ``assume_tz``; text with an offset keeps its own zone."""
    from roadlens.functions.timeparts import parse_ts
    df = spark.createDataFrame([("2026-03-04 07:08:09",), ("2026-03-04T07:08:09+07:00",),
                                ("2026-03-04T00:08:09Z",), ("2026-03-04T07:08:09+0700",), ("junk",)],
                               "t string")
    got = [r[0] for r in df.select(F.date_format(parse_ts("t", "Asia/Ho_Chi_Minh"),
                                                 "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2026-03-04 00:08:09"] * 4 + [None]


def test_unit_and_key_are_separate(spark):
    body = spark.createDataFrame([("{" + BASE + ', "speed": 40.0, "speed_kmh": 7.0, "accuracy_m": 4.5, "device_id": "D"}',)], "value string")
    read = lambda **kw: decode_requests(body, **kw).first()
    assert read(speed_unit="km/h").speed_kmh == 40.0  # the phone
    assert read().speed_kmh == 144.0  # the gateway
    message = read(speed_unit="km/h", speed_key="speed_kmh")
    assert (message.speed_kmh, message.accuracy_m, message.vehicle_id) == (7.0, 4.5, "D")


def test_message_survives_the_queue(spark):
    from roadlens.sources.decode import MESSAGE_COLS, encode_message
    sent = accepted(decode_requests(spark.createDataFrame(
        [("{" + BASE + ', "device_id": "D7", "speed": 5}',)], "value string"), received_at="'now'"))
    record = encode_message(sent)
    assert record.first().key == "G1"
    back = decode_requests(record, speed_unit="km/h", speed_key="speed_kmh")
    assert back.select(*MESSAGE_COLS).first() == sent.first() and back.first().vehicle_id == "D7"


def test_body_is_parsed_once(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "value string")
    for part in (accepted, rejected):
        plan = part(decode_requests(df))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
