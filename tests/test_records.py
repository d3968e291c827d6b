"""Payloads, matches, checks, frames and texts on hand-written rows."""

import json
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gustline.functions.frames import add_frame, frame_schema_id, strip_frame
from gustline.functions.text import number_text
from gustline.functions.times import display_clock, ingested_at
from gustline.operators import matches as m
from gustline.operators.quality import MATCH_KEYS, READING_KEYS, ValidationError, check_records, validate
from gustline.operators.readings import PLACES, flatten_payloads, in_places, payload_rejects, with_event_time
from gustline.schemas import ALERT, ENVELOPE, LONG, MATCH, READING, TEXT, record
from gustline.sources import envelopes as e

STAMP = datetime(2024, 3, 1, 12, 0, 0, 250)
PAYLOAD = {
    "id": 5, "name": "Ha Noi", "sys": {"country": "VN"},
    "weather": [{"main": "Rain", "description": "light rain"}, {"main": "Mist"}],
    "main": {"temp": 21.5, "pressure": 1009, "humidity": 88}, "visibility": 7000,
    "wind": {"speed": 2.1}, "dt": 1730615400,
}


def texts(spark, values):
    made = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
    return spark.createDataFrame(made, "value STRING")


def without(*keys):
    return {k: v for k, v in PAYLOAD.items() if k not in keys}


def test_flatten_full_payload(spark):
    row = with_event_time(flatten_payloads(texts(spark, [PAYLOAD]), F.lit(STAMP))).first()
    assert row.asDict() == dict(
        id=5, city="Ha Noi", country="VN", weather_main="Rain", weather_description="light rain",
        temperature=21.5, pressure=1009, humidity=88, visibility=7000,
        wind_speed=pytest.approx(2.1, rel=1e-6), dt=1730615400,
        ingested_at="2024-03-01T12:00:00.000250", event_timestamp=datetime(2024, 11, 3, 6, 30))


def test_flatten_missing_parts(spark):
    values = [without("sys", "wind"), {**PAYLOAD, "weather": []}, without("weather", "main"), {}]
    a, b, c, d = flatten_payloads(texts(spark, values), F.lit(STAMP)).collect()
    assert a.country is None and a.wind_speed is None and a.city == "Ha Noi"
    assert b.weather_main is None and b.temperature == 21.5
    assert c.weather_description is None and c.pressure is None
    assert d.id is None and d.city is None and d.ingested_at is not None


def test_rejects_are_told_apart_and_make_no_reading(spark):
    raw = texts(spark, [PAYLOAD, "{broken", {**PAYLOAD, "dt": "noon"}]).unionByName(spark.createDataFrame([(None,)], "value STRING"))
    assert flatten_payloads(raw).count() == 1
    found = payload_rejects(raw).groupBy("reason").count().collect()
    assert sorted(map(tuple, found)) == [("not an object", 2), ("wrong type", 1)]


def test_reading_columns_and_stamp_default(spark):
    flat = flatten_payloads(texts(spark, [PAYLOAD, PAYLOAD]))
    assert flat.columns == READING.fieldNames()
    assert flat.select("ingested_at").distinct().count() == 1


def test_event_time_keeps_the_repeated_hour(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.createDataFrame([(1730611800,), (1730615400,)], "dt BIGINT")
        back = with_event_time(frame).select(F.unix_seconds("event_timestamp")).collect()
        assert [r[0] for r in back] == [1730611800, 1730615400]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_places_as_list_and_as_frame(spark):
    frame = spark.createDataFrame(
        [("Ha Noi", "VN"), ("Ha Noi", "US"), ("Chicago", "US"), (None, "US")], "city STRING, country STRING")
    other = spark.createDataFrame(PLACES, "city STRING, country STRING")
    for allowed in (PLACES, other):
        assert sorted(map(tuple, in_places(frame, allowed).collect())) == [("Chicago", "US"), ("Ha Noi", "VN")]
    assert in_places(frame, []).count() == 0


def match(id, status="TIMED", day="2024-03-01", **more):
    return {"id": id, "status": status, "utcDate": f"{day}T15:00:00Z",
            "score": {"fullTime": {"home": 1, "away": 0}}, "homeTeam": {"id": 1, "name": "A"},
            "awayTeam": {"id": 2, "name": "B"}, "referees": [], **more}


def test_matches_unpack_and_route(spark):
    polls = [{"matches": [match(1, "FINISHED"), match(2, "IN_PLAY", group="G")]}, {"matches": []}, {},
             {"matches": [match(3, None)]}]
    rows = m.unpack_matches(texts(spark, polls), F.lit(STAMP))
    assert rows.schema.fieldNames() == MATCH.fieldNames()
    routed = {r.id: r for r in m.route(rows).collect()}
    assert {i: r.topic for i, r in routed.items()} == {
        1: "football_history", 2: "football_live", 3: "football_live"}
    assert routed[1].score.fullTime.home == 1 and routed[1].score.penalties is None
    assert routed[2].group == "G" and routed[1].referees == []
    assert m.count_matches(rows).first().asDict() == dict(total=3, live=2, finished=1)


POLLS = [
    json.dumps({"matches": [match(1, "FINISHED")]}), '{"matches":[{"id":2},{"id":', "no json",
    json.dumps({"matches": [match(3), match("x"), 5, None, match(4)]}), "{}", '{"matches":null}', '{"matches":5}', "[1]", "", '{"matches":[null]}',
]


@pytest.mark.parametrize("with_texts", [False, True])
def test_rejected_matches_stay_beside_the_good_ones(spark, with_texts):
    raw = spark.createDataFrame([*enumerate(POLLS), (99, None)], "text_no INT, value STRING")
    found = sorted((r.text_no, r.position, r.match and r.match.id, r.reason) for r in m.parse_polls(raw, with_texts=with_texts).collect())
    broken, typed = "not an object", "wrong type"
    assert found == [
        (0, 0, 1, None), (1, -1, None, broken), (2, -1, None, broken), (3, 0, 3, None), (3, 1, None, typed), (3, 2, None, broken),
        (3, 3, None, broken), (3, 4, 4, None), (6, -1, None, typed), (7, -1, None, broken), (8, -1, None, broken), (9, 0, None, broken), (99, -1, None, broken)]
    assert sorted(r.id for r in m.unpack_matches(raw).collect()) == [1, 3, 4]
    rejects = m.match_rejects(raw)
    assert rejects.columns == ["text_no", "value", "position", "text", "reason"]
    assert {r.text for r in rejects.filter("text_no = 3").collect()} == {json.dumps(match("x"), separators=(",", ":")), "5", None}
    assert m.match_texts(raw).count() == 7


def test_every_text_is_parsed_once(spark):
    raw = texts(spark, [PAYLOAD])
    for made in (flatten_payloads(raw), payload_rejects(raw), with_event_time(flatten_payloads(raw)).filter("dt > 5")):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_match_days_are_inclusive(spark):
    days = ["2024-01-30", "2024-01-31", "2024-02-29", "2024-03-01", "2024-03-02", "2024-03-03"]
    poll = {"matches": [match(i, "FINISHED", d) for i, d in enumerate(days)] + [match(9, "TIMED", days[3])]}
    rows = m.unpack_matches(texts(spark, [poll]))
    as_of = date(2024, 3, 1)
    assert sorted(r.id for r in m.in_days(rows, as_of).collect()) == [3, 4, 9]
    assert sorted(r.id for r in m.history(rows, as_of).collect()) == [1, 2, 3]


KEYS = dict.fromkeys(READING_KEYS)


@pytest.mark.parametrize(
    "name, records, required, status, complete, reasons",
    [
        ("weather", [KEYS, {**KEYS, "more": 1}], READING_KEYS, "PASS", True, 0),
        ("weather", [KEYS, {"city": "x"}], READING_KEYS, "PASS", False, 1),
        ("weather", ["{broken"], READING_KEYS, "PASS", False, 1),
        ("weather", [], READING_KEYS, "FAIL (Zero Count)", False, 2),
        ("weather", [], (), "FAIL (Zero Count)", True, 1),
        ("live_football", [], (), "PASS (Zero allowed)", True, 0),
        ("recent_finish_football", [], MATCH_KEYS, "PASS (Zero allowed)", False, 1),
    ],
)
def test_required_keys(spark, name, records, required, status, complete, reasons):
    frame = texts(spark, records)
    row = check_records(frame, name, required).first()
    assert (row.records_count, row.status, row.has_required_fields) == (len(records), status, complete)
    if reasons:
        with pytest.raises(ValidationError) as raised:
            validate(frame, name, required)
        assert ("FAIL (Zero Count)" in str(raised.value)) + ("Missing one" in str(raised.value)) == reasons
    else:
        assert validate(frame, name, required)["data_name"] == name


def test_frames(spark):
    frame = spark.createDataFrame([(bytearray(b"body"),), (bytearray(b""),)], "body BINARY")
    framed = frame.select(add_frame("body", 7).alias("value"))
    odd = spark.createDataFrame([(bytearray(b"\x01\x00\x00\x00\x07x"),), (bytearray(b"\x00\x00"),)], "value BINARY")
    rows = framed.unionByName(odd).select(frame_schema_id().alias("i"), strip_frame().alias("b")).collect()
    assert [(r.i, bytes(r.b)) for r in rows] == [(7, b"body"), (7, b""), (None, b"x"), (None, b"")]


def test_file_topic_roundtrip(spark, folder):
    sent = flatten_payloads(texts(spark, [PAYLOAD, without("wind")]), F.lit(STAMP))
    e.publish(e.keyed_envelopes(sent, "weather", schema_id=7), "files", folder=folder)
    e.publish(e.keyed_envelopes(sent, "other", schema_id=7), "files", folder=folder)
    topic = e.read_topic(spark, "weather", "files", folder=folder, streaming=False)
    assert topic.columns == ENVELOPE.fieldNames()
    assert {bytes(r.key) for r in topic.collect()} == {b"5"}
    back = e.read_readings(topic, READING)
    assert back.drop("event_timestamp").exceptAll(sent).count() == 0 and back.count() == 2
    assert e.unframed(topic).columns == ["kafka_timestamp", "offset", "partition", "body"]
    with pytest.raises(ValueError):
        e.read_topic(spark, "weather", "pigeon")
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        e.decode(topic, READING, framed=False).collect()


def test_value_schema_must_exist(spark, folder):
    spark.createDataFrame([('{"type": "record"}',)], "t STRING").coalesce(1).write.text(folder)
    assert e.load_value_schema(spark, folder).strip() == '{"type": "record"}'
    with pytest.raises(Exception):
        e.load_value_schema(spark, folder + "-none").strip()


def test_alert_messages_omit_nulls(spark):
    frame = spark.createDataFrame([("change", None)], "alert_type STRING, city STRING")
    row = e.alert_envelopes(frame, "t").first()
    assert row.key is None and row.value == '{"alert_type":"change"}'
    assert e.decode_alerts(e.alert_envelopes(frame, "t")).columns == ALERT.fieldNames()


def test_number_texts(spark):
    numbers = [0.0, -2.0, 38.25, 0.001, 0.0005, 0.0001, 0.00005, -1.5e-7, 9999999.0, 12000000.0,
               123456789012.5, 1e16, 2.5e21, 1e300, 5.555555555555556e-4, 1.2345678901234567e-4, -0.00055,
               9.999999999999999e-4, -1.2345678901234567e7, 1234567890123456.7]
    frame = spark.createDataFrame([(v,) for v in numbers], "v DOUBLE")
    assert [r[0] for r in frame.select(number_text(frame.schema, "v")).collect()] == [repr(v) for v in numbers]
    whole = spark.createDataFrame([(1033, 12.3)], "v BIGINT, f FLOAT")
    row = whole.select(number_text(whole.schema, "v"), number_text(whole.schema, "f")).first()
    assert tuple(row) == ("1033", "12.3")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=20, max_size=20), st.integers(-5, 17))
def test_number_texts_lose_no_digit(spark, numbers, power):
    numbers = [n for n in numbers + [n % 1 * 10.0**power for n in numbers] if abs(n) > 1e-300 or n == 0]
    frame = spark.createDataFrame([(v,) for v in numbers], "v DOUBLE")
    assert [float(r[0]) for r in frame.select(number_text(frame.schema, "v")).collect()] == numbers


def test_clock_texts(spark):
    frame = spark.range(1).select(F.lit(STAMP).cast("timestamp").alias("t"))
    row = frame.select(display_clock("t").alias("c"), ingested_at(F.col("t")).alias("i")).first()
    assert (row.c, row.i) == ("19:00:00", "2024-03-01T12:00:00.000250")


def test_values_are_decoded_by_the_schema_they_name(spark):
    first, second = record(id=LONG, city=TEXT), record(id=LONG, more=TEXT)
    bodies = [(7, '{"id":1,"city":"a"}'), (8, '{"id":2,"more":"b"}'), (9, '{"id":3}'), (7, '{"id":"x"}'), (8, "{"), (7, "{}")]
    rows = [(k, number, body) for k, (number, body) in enumerate(bodies)]
    frame = spark.createDataFrame(rows, "k INT, number INT, body STRING")
    framed = frame.select("k", F.concat(F.unhex(F.concat(F.lit("00"), F.lpad(F.hex("number"), 8, "0"))), F.col("body").cast("binary")).alias("value"))
    bare = spark.createDataFrame([(6, None), (7, bytearray(b"abc"))], "k INT, value BINARY")
    found = e.decode_versions(framed.unionByName(bare), {7: first, 8: second}, record(id=LONG, city=TEXT)).orderBy("k").collect()
    assert [(r.schema_id, r.reason, r.record and tuple(r.record)) for r in found] == [
        (7, None, (1, "a")), (8, None, (2, None)), (9, "unknown schema", None), (7, "not decoded", None), (8, "not decoded", None),
        (7, None, (None, None)), (None, "no frame", None), (None, "no frame", None)]


def test_what_is_no_alert_is_set_aside(spark):
    rows = [('{"alert_type":"change","city":"a"}',), ("no json",), ('{"id":"x"}',), ("{}",), (None,)]
    messages = spark.createDataFrame(rows, "value STRING")
    assert [r.city for r in e.decode_alerts(messages).orderBy("city").collect()] == [None, "a"]
    assert sorted(r.value or "" for r in e.alert_rejects(messages).collect()) == ["", "no json", '{"id":"x"}']
