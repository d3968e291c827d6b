"""Streams on file feeds: late data, restart, suppression state, sinks."""

import json
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from rows import DAY, LAYOUT, reading, readings

from gustline.operators.alerts import explode_anomalies, unite
from gustline.operators.changes import change_alerts
from gustline.operators.suppression import last_emissions, suppress_repeats
from gustline.operators.thresholds import threshold_alerts
from gustline.operators.windows import EVENT_TIME, WATERMARK, WINDOW_MINUTES, window_stats
from gustline.plans import given
from gustline.schemas import ALERT
from gustline.operators.quality import ValidationError
from gustline.sources.envelopes import TRIGGER_LIMITS, alert_envelopes, decode_alerts, once, publish, read_topic
from gustline.sources.polls import archived_payloads, read_payloads
from gustline.sources.shared import CHECKPOINT_SETTING, shared_folder
from gustline.sources.sinks import write_alerts, write_console, write_rows
from gustline.streaming.accounts import Accounts, accounts, counted
from gustline.streaming.audit import held_emissions
from gustline.streaming.delivery import start_notifications
from gustline.streaming.feeds import publish_history, publish_matches, publish_readings, start_feed
from gustline.streaming.jobs import SHUFFLES, delivered, drain, start_detectors, state_settings
from gustline.streaming.panes import pane_stats_stream
from gustline.streaming.suppression import AT, BUCKETS, first_per_time, suppress_repeats_stream

FEW = 2


def feed(spark, folder, rows):
    readings(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    return spark.readStream.schema(LAYOUT).parquet(f"{folder}/feed")


def run(spark, folder, frame):
    with state_settings(spark, FEW):
        query = write_rows(frame, f"{folder}/checkpoint", f"{folder}/rows", available_now=True)
        drain(query)
    return spark.read.parquet(f"{folder}/rows"), query


def windows(stream):
    stats = window_stats(stream.withWatermark(EVENT_TIME, WATERMARK))
    return stats.select("city", "time_window.start", "min_humidity", "max_humidity_info.humidity")


def starts(rows, humidity):
    found = rows.filter(F.col("min_humidity") == humidity).collect()
    return sorted(int((r.start - DAY).total_seconds() // 60) for r in found)


def test_late_rows_are_dropped_per_window(spark, folder):
    arrivals = [
        [reading(minute=10, humidity=90), reading(minute=60, humidity=91)],
        [reading(minute=40, humidity=40), reading(minute=20, humidity=20)],
        [reading(minute=180, humidity=92)],
    ]
    for rows in arrivals:
        out, _ = run(spark, folder, windows(feed(spark, folder, rows)))
    # The watermark stood at 00:58 when 00:40 and 00:20 came.
    assert starts(out, 40) == [30, 35, 40]
    assert starts(out, 20) == []
    assert starts(out, 90) == list(range(-15, 15, 5))
    assert out.filter("start = timestamp'2024-03-01 02:30:00'").count() == 0


def test_restart_neither_loses_nor_repeats(spark, folder):
    parts = [[reading(id=i, minute=i * 4, humidity=i) for i in range(a, a + 20)] for a in (0, 20, 40)]
    for part in parts:
        out, _ = run(spark, folder, windows(feed(spark, folder, part)))
    whole = window_stats(readings(spark, sum(parts, [])))
    closed = whole.filter(F.col("time_window.end") <= DAY + timedelta(minutes=59 * 4 - 2))
    assert out.count() == out.select("start").distinct().count() == closed.count()
    expected = closed.select("city", "time_window.start", "min_humidity", "max_humidity_info.humidity")
    assert out.exceptAll(expected).count() == 0


def test_detectors_stream_equals_batch(spark, folder):
    small = "/root/testdata/sf0.001"
    started = start_detectors(given.reading_stream(spark, small), f"{folder}/checkpoints",
                              folder=f"{folder}/topic", kind="files", available_now=True)
    drain(*started.values())
    messages = [spark.read.parquet(f"{folder}/topic/{name}") for name in started]
    assert all(row.key is None for row in messages[0].select("key").distinct().collect())
    alerts = decode_alerts(messages[0].unionByName(messages[1]))
    r = given.readings(spark, small)
    end = r.agg(F.max(EVENT_TIME)).first()[0] - timedelta(minutes=WINDOW_MINUTES + 2)
    batch = unite(threshold_alerts(r), change_alerts(r).filter(F.col("window_start") <= end))

    def rounded(frame):
        return frame.select([F.round(n, 9).alias(n) if t == "double" else n for n, t in frame.dtypes])

    assert alerts.count() == batch.count()
    assert rounded(alerts).exceptAll(rounded(batch)).count() == 0


def threshold_layout(frame):
    """Threshold alerts in the layout of all alerts."""
    alerts = threshold_alerts(frame)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in ALERT if f.name not in alerts.columns}
    return alerts.withColumns(missing).select(ALERT.fieldNames())


def thresholds(frame):
    return explode_anomalies(threshold_layout(frame))


def test_suppression_state_lives_across_batches(spark, folder):
    def hot(minute, id=1):
        return reading(id=id, minute=minute, temperature=40.0)

    arrivals = [[hot(10), hot(0), hot(29.9)], [hot(30), hot(31)], [hot(59), hot(60, 8), hot(60, 7), hot(1)]]
    for rows in arrivals:
        out, _ = run(spark, folder, suppress_repeats_stream(thresholds(feed(spark, folder, rows))))
    kept = sorted((int((r.alert_time - DAY).total_seconds() // 60), r.id) for r in out.collect())
    assert kept == [(0, 1), (30, 1), (60, 7)]
    batch = suppress_repeats(thresholds(readings(spark, sum(arrivals, []))))
    assert sorted((int((r.alert_time - DAY).total_seconds() // 60), r.id) for r in batch.collect()) == kept


def test_rows_without_time_pass_the_state(spark, folder):
    untimed = reading(id=5, temperature=40.0)[:-1] + (None,)
    rows = [untimed, reading(id=6, temperature=40.0), reading(id=7, minute=1, temperature=40.0)]
    out, _ = run(spark, folder, suppress_repeats_stream(thresholds(feed(spark, folder, rows))))
    assert sorted(r.id for r in out.collect()) == [5, 6]


def user_rows(spark, rows):
    """Rows of (user, minute, id)."""
    made = [(f"u{u}", None if minute is None else DAY + timedelta(minutes=minute), i) for u, minute, i in rows]
    return spark.createDataFrame(made, "user STRING, at TIMESTAMP, id BIGINT")


def test_expiring_state_holds_the_live_keys_only(spark, folder):
    """Twenty users an hour, none of whom comes back later than that; each is seen twice within the retention time."""
    every = [(100 * hour + u, 60 * hour + u + more, 1000 * hour + 10 * u + more) for hour in range(6) for u in range(20) for more in (0, 5)]
    keys, order = ("user",), ("id",)
    for hour in range(6):
        rows = user_rows(spark, [r for r in every if r[1] // 60 == hour] + [(7, None, -1 - hour)])
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/feed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/feed")
        out, query = run(spark, folder, suppress_repeats_stream(stream, keys, "at", order, late="5 minutes"))
        held = held_emissions(spark, f"{folder}/checkpoint", "at").collect()
        # The watermark stands five minutes behind the last row; who was emitted 30 minutes before that is free.
        mark = 60 * hour + 24 - 5
        assert {r.user for r in held} == {f"u{u}" for u, minute, _ in every if minute + 30 > mark and minute // 60 <= hour}
    kept = sorted((r.user, r.id) for r in out.filter("at IS NOT NULL").collect())
    batch = suppress_repeats(user_rows(spark, every), keys, "at", order)
    assert kept == sorted((r.user, r.id) for r in batch.collect()) and len(kept) == 120
    assert sorted(r.id for r in out.filter("at IS NULL").collect()) == [-6, -5, -4, -3, -2, -1]


def test_rows_behind_the_watermark_are_dropped_where_state_expires(spark, folder):
    for rows in [[(1, 0, 1), (2, 300, 2)], [(1, 10, 3), (1, 290, 4), (1, 299, 5)]]:
        user_rows(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/feed")
        stream = spark.readStream.schema("user STRING, at TIMESTAMP, id BIGINT").parquet(f"{folder}/feed")
        out, _ = run(spark, folder, suppress_repeats_stream(stream, ("user",), "at", ("id",), late="15 minutes"))
    assert sorted(r.id for r in out.collect()) == [1, 2, 4]


def test_expiring_keys_share_groups(spark, folder):
    """Many keys, some null, some in numbers, are fewer groups than buckets; each has its own chain over two arrivals."""
    kind = F.when(F.col("id") % 5 > 0, F.concat(F.lit("k"), F.col("id") % 5))
    user = F.when(F.col("id") % 1900 > 0, F.col("id") % 1900 + F.lit(2**40))
    at = F.timestamp_seconds(F.lit(1_709_251_200) + F.floor(F.col("id") / 3) + F.when(F.col("id") % 2 == 0, 1000).otherwise(0))
    rows = spark.range(9500).select(kind.alias("kind"), user.alias("user"), at.alias("at"), "id")
    for part in (F.col("id") < 5000, F.col("id") >= 5000):
        rows.where(part).write.mode("append").parquet(f"{folder}/feed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/feed")
        out, query = run(spark, folder, suppress_repeats_stream(stream, ("kind", "user"), "at", ("id",), late="2 hours"))
        n_groups = max(p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress)
        assert 0 < n_groups <= BUCKETS
    n_keys = rows.select("kind", "user").distinct().count()
    assert n_keys > 1500 and held_emissions(spark, f"{folder}/checkpoint", "at").select("kind", "user").distinct().count() == n_keys
    batch = suppress_repeats(rows, ("kind", "user"), "at", ("id",))
    assert out.count() == batch.count() > n_keys and out.exceptAll(batch).count() == 0


@pytest.mark.parametrize("late", [None, "1 hour"])
def test_a_stream_goes_on_where_a_batch_ended(spark, folder, late):
    past, new = [(1, 0, 1), (1, 31, 2), (2, 40, 3), (3, None, 4)], [(1, 60, 5), (1, 61, 6), (2, 69, 7), (4, 50, 8), (2, 70, 9)]
    kept = suppress_repeats(user_rows(spark, past), ("user",), "at", ("id",))
    history = last_emissions(kept, ("user",), "at")
    assert sorted(r.user for r in history.collect()) == ["u1", "u2"]
    emitted = []
    for rows in (new[:2], new[2:]):
        user_rows(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/feed")
        stream = spark.readStream.schema("user STRING, at TIMESTAMP, id BIGINT").parquet(f"{folder}/feed")
        out, _ = run(spark, folder, suppress_repeats_stream(stream, ("user",), "at", ("id",), late=late, history=history))
        emitted.append(sorted(r.id for r in out.collect()))
    assert emitted == [[6], [6, 8, 9]]


def test_held_rows_are_one_per_time():
    rows = pd.DataFrame({AT: [1500, 900, 100, 900, None], "k": ["a", "a", "b", "a", "a"], "o": [1, 4, 3, 2, 5]})
    assert first_per_time(rows, ["k"], ["o"]).o.tolist() == [3, 2, 1]
    assert first_per_time(rows, [], ["o"]).o.tolist() == [3, 2, 1]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("change", ["2024-03-10 07:00:00", "2024-11-03 06:00:00"])
def test_streams_count_through_changes_of_the_clock(spark, folder, zone, change):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        at = F.lit(change).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 59.5)
        spark.range(-70, 70).select(
            F.lit("k").alias("city"), F.lit("t").alias("alert_type"), F.lit("a").alias("anomaly"), at.alias("alert_time"),
            F.lit("VN").alias("country"), "id", F.col("id").alias("alert_uid"),
        ).coalesce(1).write.parquet(f"{folder}/feed")
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = spark.read.parquet(f"{folder}/feed")
        out, _ = run(spark, folder, suppress_repeats_stream(spark.readStream.schema(rows.schema).parquet(f"{folder}/feed")))
        kept = sorted(r.id for r in out.select("id").collect())
        assert kept == sorted(r.id for r in suppress_repeats(rows).select("id").collect()) == list(range(-70, 70, 31))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_suppression_by_processing_clock(spark, folder):
    def hot(city, minute):
        return reading(city=city, minute=minute, temperature=40.0)

    # Such a query goes on with empty batches to watch the clock; here it must end.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        for rows in [[hot("a", 0), hot("a", 90), hot("b", 0)], [hot("a", 500), hot("c", 0)]]:
            stream = thresholds(feed(spark, folder, rows))
            out, _ = run(spark, folder, suppress_repeats_stream(stream, clock="processing"))
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert sorted(r.city for r in out.collect()) == ["a", "b", "c"]


def match_poll(*matches):
    return json.dumps({"matches": [{**MATCH_FIELDS, **m} for m in matches]})


MATCH_FIELDS = dict(utcDate="2024-03-01T15:00:00Z", homeTeam={}, awayTeam={}, score={"winner": None})


def test_match_feed_routes_and_checks(spark, folder):
    def start(lines):
        spark.createDataFrame([(line,) for line in lines], "v STRING").coalesce(1).write.mode("append").text(f"{folder}/polls")
        query = start_feed(spark.readStream.text(f"{folder}/polls"), publish_matches, f"{folder}/checkpoint",
                           available_now=True, kind="files", folder=f"{folder}/topics")
        drain(query)

    start([match_poll(dict(id=1, status="FINISHED"), dict(id=2, status="TIMED"), dict(id=3, status=None)), "{}"])
    sent = spark.read.parquet(f"{folder}/topics")
    assert sorted((r.topic, bytes(r.key)) for r in sent.collect()) == [
        ("football_history", b"1"), ("football_live", b"2"), ("football_live", b"3")]
    with pytest.raises(Exception, match="matches lack required keys in live_football"):
        start([json.dumps({"matches": [{"id": 4, "status": "TIMED"}]})])
    assert spark.read.parquet(f"{folder}/topics").count() == 3


def test_junk_matches_are_counted_and_set_aside(spark, folder):
    good, live = dict(id=1, status="FINISHED"), dict(id=2, status="TIMED")
    lines = [match_poll(good, live), match_poll(dict(id="x")), '{"matches":[{"id":9', "no json"]
    raw = spark.createDataFrame([(line,) for line in lines], "value STRING")
    for publisher in (publish_matches, lambda raw, **more: publish_history(raw, DAY.date(), **more)):
        with pytest.raises(ValidationError, match="3 of"):
            publisher(raw, kind="files", folder=f"{folder}/topics", most_rejects=2)
    counted = publish_matches(raw, kind="files", folder=f"{folder}/topics", rejects=f"{folder}/rejects", most_rejects=3)
    assert counted == {"n": 5, "n_rejected": 3}
    assert sorted(bytes(r.key) for r in spark.read.parquet(f"{folder}/topics").collect()) == [b"1", b"2"]
    reasons = spark.read.json(f"{folder}/rejects").groupBy("reason").count().collect()
    assert sorted(map(tuple, reasons)) == [("not an object", 2), ("wrong type", 1)]
    counted = publish_history(raw, DAY.date(), kind="files", folder=f"{folder}/history", rejects=f"{folder}/more-rejects")
    assert counted == {"n": 1, "n_rejected": 3} and spark.read.json(f"{folder}/more-rejects").count() == 3
    assert [bytes(r.key) for r in spark.read.parquet(f"{folder}/history").collect()] == [b"1"]


def test_notifications_are_gathered_by_alert(spark, folder):
    arrivals = [
        [reading(id=1, minute=0, temperature=40.0, wind_speed=12.0)],
        [reading(id=1, minute=5, temperature=40.0), reading(id=1, minute=31, temperature=41.0)],
    ]
    for rows in arrivals:
        stream = threshold_layout(feed(spark, folder, rows))
        drain(start_notifications(stream, f"{folder}/checkpoint", folder, "a@example.org", available_now=True))
    sent = spark.read.parquet(f"{folder}/notifications").orderBy("alert_time").collect()
    assert [(r.alert_time.minute, r.new_anomalies, r.n_anomalies) for r in sent] == [
        (0, "temp_anomaly,wind_anomaly", 2), (31, "temp_anomaly", 1)]
    assert "41.0°C" in sent[1].body


def test_junk_payloads_are_not_published(spark, folder):
    good = json.dumps({"id": 5, "name": "a", "sys": {"country": "VN"}, "dt": 1709251200, "main": {"temp": 1.5}})
    lines = [good, "not json", '{"id": "five"}', "[1]"]
    raw = spark.createDataFrame([(line,) for line in lines], "value STRING")
    with pytest.raises(ValidationError, match="3 of 4"):
        publish_readings(raw, kind="files", folder=f"{folder}/topics", most_rejects=0)
    counted = publish_readings(raw, kind="files", folder=f"{folder}/topics", rejects=f"{folder}/rejects")
    assert counted == {"n": 4, "n_rejected": 3}
    assert [bytes(r.key) for r in spark.read.parquet(f"{folder}/topics").collect()] == [b"5"]
    reasons = spark.read.json(f"{folder}/rejects").groupBy("reason").count().collect()
    assert sorted(map(tuple, reasons)) == [("not an object", 2), ("wrong type", 1)]


def test_topics_have_limits_and_folders_no_offsets(spark, folder):
    readings(spark, [reading()]).write.parquet(folder)
    assert TRIGGER_LIMITS["files"]["maxFilesPerTrigger"] and TRIGGER_LIMITS["kafka"]["maxOffsetsPerTrigger"]
    with pytest.raises(ValueError, match="starting"):
        read_topic(spark, "t", "files", folder=folder, starting="latest")


def test_progress_tells_what_was_delivered(spark, folder):
    out, query = run(spark, folder, feed(spark, folder, [reading(), reading(id=2)]).select("id"))
    assert sum(p["rows_in"] for p in delivered(query)) == out.count() == 2


def test_accounts_outlive_the_progress_buffer(spark, folder):
    kept = Accounts(spark, f"{folder}/accounts")
    spark.streams.addListener(kept)
    try:
        for part in range(3):
            rows = [reading(id=10 * part + k, minute=100 * part) for k in range(part + 1)]
            stream = feed(spark, folder, rows).select("id").filter("id % 10 > 0")
            _, query = run(spark, folder, counted(stream))
            kept.settle(query)
    finally:
        spark.streams.removeListener(kept)
    told = [tuple(r) for r in accounts(spark, f"{folder}/accounts").filter("rows_in > 0").orderBy("batch").select("rows_in", "rows_out", "rows_late").collect()]
    assert told == [(1, 0, 0), (2, 1, 0), (3, 2, 0)]


def test_messages_sent_again_are_taken_once(spark, folder):
    alerts = threshold_layout(readings(spark, [reading(id=i, temperature=40.0) for i in range(5)]))
    for _ in range(2):
        publish(alert_envelopes(alerts, "t"), kind="files", folder=f"{folder}/topic")
        messages = once(read_topic(spark, "t", "files", folder=f"{folder}/topic"))
        out, _ = run(spark, folder, decode_alerts(messages))
    assert spark.read.parquet(f"{folder}/topic").count() == 10
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 3, 4]


def test_clock_is_checked(spark):
    with pytest.raises(ValueError):
        suppress_repeats_stream(spark.range(1), clock="moon")


def test_console_sink(spark, folder):
    stream = feed(spark, folder, [reading(city="Chicago")]).select("city")
    query = write_console(stream, f"{folder}/checkpoint", available_now=True)
    drain(query)
    assert sum(p.numInputRows for p in query.recentProgress) == 1


def test_unknown_transport(spark, folder):
    stream = feed(spark, folder, [reading()])
    with pytest.raises(ValueError):
        write_alerts(stream, f"{folder}/checkpoint", kind="pigeon")


def test_settings_are_restored(spark):
    before = spark.conf.get(SHUFFLES)
    with state_settings(spark, 3):
        assert spark.conf.get(SHUFFLES) == "3"
    assert spark.conf.get(SHUFFLES) == before


def test_state_partitions_follow_the_session_not_the_cores(spark):
    before = spark.conf.get(SHUFFLES)
    spark.conf.set(SHUFFLES, "999")
    try:
        with state_settings(spark):
            assert spark.conf.get(SHUFFLES) == "999"
    finally:
        spark.conf.set(SHUFFLES, before)


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda name, default: None)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)
            master = "spark://host:7077"

    with pytest.raises(ValueError, match=CHECKPOINT_SETTING):
        shared_folder(Session)


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    else:
        assert shared_folder(spark) == spark.sparkContext.getCheckpointDir()


def test_read_polls_move_to_the_archive_when_the_next_trigger_begins(spark, folder):
    def names(frame):
        return sorted(row.value for row in frame.collect())

    def poll(*payloads):
        spark.createDataFrame([(p,) for p in payloads], "value STRING").coalesce(1).write.mode("append").text(f"{folder}/in/polls")
        stream = read_payloads(spark, f"{folder}/in/polls", archive=f"{folder}/read/archive")
        drain(write_rows(stream, f"{folder}/checkpoint", f"{folder}/rows", available_now=True))
        return names(spark.read.parquet(f"{folder}/rows")), names(spark.read.text(f"{folder}/in/polls"))

    assert poll("a", "b") == (["a", "b"], ["a", "b"])
    assert poll("c") == (["a", "b", "c"], ["c"])
    assert names(archived_payloads(spark, f"{folder}/read/archive")) == ["a", "b"]
    assert poll() == (["a", "b", "c"], [])
    assert names(archived_payloads(spark, f"{folder}/read/archive")) == ["a", "b", "c"]


def through_panes(stream):
    return pane_stats_stream(stream).select("city", "time_window.start", "min_humidity", "max_humidity_info.humidity")


def test_panes_drop_late_rows_per_window(spark, folder):
    arrivals = [
        [reading(minute=10, humidity=90), reading(minute=60, humidity=91)],
        [reading(minute=40, humidity=40), reading(minute=20, humidity=20)],
        [reading(minute=180, humidity=92)],
    ]
    found = {}
    for name, stats in (("plain", windows), ("panes", through_panes)):
        for rows in arrivals:
            out, query = run(spark, f"{folder}/{name}", stats(feed(spark, f"{folder}/{name}", rows)))
        found[name] = sorted(map(tuple, out.collect()))
    assert found["panes"] == found["plain"]
    assert any(row[2] == 40 for row in found["panes"])


def test_panes_equal_plain_windows_with_empty_readings_and_ties(spark, folder):
    rows = [
        reading(minute=m, humidity=h, temperature=t, visibility=v, wind_speed=w, country=c)
        for m, h, t, v, w, c in [
            (0, None, 1.5, 10, None, "VN"), (1, 50, 1.5, None, None, "VN"), (4, 50, None, 10, None, "VN"), (4, 50, None, 10, None, "VN"),
            (7, None, float("nan"), 10, 2.0, None), (8, 3, -1.0, 9, float("nan"), None), (200, 7, 0.0, 1, 1.0, "VN"), (200, 7, 0.0, 1, 1.0, None),
        ]
    ]
    found = {}
    for name, stats in (("plain", lambda s: window_stats(s.withWatermark(EVENT_TIME, WATERMARK))), ("panes", pane_stats_stream)):
        out, _ = run(spark, f"{folder}/{name}", stats(feed(spark, f"{folder}/{name}", rows)))
        found[name] = out
    assert found["panes"].schema.simpleString() == found["plain"].schema.simpleString()
    assert found["plain"].count() == 12
    text = lambda frame: sorted(r[0] for r in frame.select(F.to_json(F.struct(*found["plain"].columns))).collect())
    assert text(found["panes"]) == text(found["plain"])


def test_panes_hold_a_sixth_of_the_state(spark, folder):
    rows = [reading(minute=m) for m in range(0, 60 * 40, 40)]
    held = {}
    for name, stats in (("plain", windows), ("panes", through_panes)):
        stream = feed(spark, f"{folder}/{name}", rows)
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
        try:
            _, query = run(spark, f"{folder}/{name}", stats(stream))
        finally:
            spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
        progress = json.loads(query.lastProgress.json)
        held[name] = progress["stateOperators"][0]["numRowsTotal"]
    assert held["plain"] == 6 * len(rows)
    # Besides the panes: when the place was last seen, and its timer by key and by time.
    assert held["panes"] <= len(rows) + 3


def test_panes_go_when_their_windows_are_closed(spark, folder):
    for start in (0, 300, 600):
        rows = [reading(minute=start + m, city=f"c{start}-{m}") for m in range(40)] + [reading(minute=start + 200, city="clock")]
        _, query = run(spark, folder, through_panes(feed(spark, folder, rows)))
        progress = json.loads(query.lastProgress.json)
        assert progress["stateOperators"][0]["numRowsTotal"] <= 6
