"""The registered queries: each reads the given tables and returns a comparable frame."""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.functions.frames import frame_schema_id, strip_frame
from gustline.functions.times import ingested_at
from gustline.operators import matches as m
from gustline.operators import readings
from gustline.operators.alerts import explode_anomalies, identify, of_type, unite
from gustline.operators.changes import change_alerts, change_features
from gustline.operators.notifications import enrich
from gustline.operators.quality import MATCH_KEYS, READING_KEYS, check_groups
from gustline.operators.readings import flatten_payloads, in_places, with_event_time
from gustline.operators.suppression import suppress_repeats
from gustline.operators.thresholds import flag_thresholds, threshold_alerts
from gustline.operators.windows import EVENT_TIME, WATERMARK, window_stats
from gustline.plans import given
from gustline.plans.daily import run_batch
from gustline.plans.delivery import deliver
from gustline.plans.given import comparable
from gustline.schemas import ALERT, MATCH, READING
from gustline.sources import landing, tables
from gustline.sources.envelopes import (
    alert_envelopes,
    decode_alerts,
    keyed_envelopes,
    publish,
    read_readings,
    read_topic,
    unframed,
)
from gustline.sources.shared import fresh_path, write_stage
from gustline.sources.sinks import ALERT_TOPIC, write_rows
from gustline.streaming.delivery import start_notifications
from gustline.streaming.feeds import READING_TOPIC, publish_history, publish_matches, publish_readings, start_feed
from gustline.streaming.jobs import DETECTORS, drain, start_detectors, state_settings
from gustline.streaming.suppression import suppress_repeats_stream

STAMP = datetime(2024, 2, 1)
AS_OF = date(1998, 6, 15)
RECIPIENTS = "ops@example.org,desk@example.org"
SCHEMA_ID = 7
ALLOWED = [("click", "US"), ("error", "VN"), ("signup", "US")]
LATE_FROM_DAY = "2024-01-20"
LATE_VISIBILITY = 2000
ARRIVALS = ("2024-01-10", "2024-01-20")


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = given.readings(spark, sf_dir)
    # Rounded before they become text, where the order of summing would show.
    changes = change_alerts(r).withColumns(
        {name: F.round(name, given.PLACES) for name in ("temp_rise", "temp_fall")}
    )
    return unite(threshold_alerts(r), changes)


def threshold_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(flag_thresholds(given.readings(spark, sf_dir)))


def threshold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(threshold_alerts(given.readings(spark, sf_dir)))


def sliding_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = window_stats(given.readings(spark, sf_dir))
    return comparable(
        stats.select(
            "city", "country",
            F.col("time_window.start").alias("window_start"),
            F.col("time_window.end").alias("window_end"),
            "avg_temp", "avg_pressure", "avg_wind_speed", "avg_humidity", "avg_vis",
            "min_wind", "min_humidity",
        )
    )


def window_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = window_stats(given.readings(spark, sf_dir))
    timed = {
        "max_temp": ("max_temp_info", "temperature"),
        "min_temp": ("min_temp_info", "temperature"),
        "max_pressure": ("max_pressure_info", "pressure"),
        "min_pressure": ("min_pressure_info", "pressure"),
        "max_wind": ("max_wind_info", "wind_speed"),
        "max_humidity": ("max_humidity_info", "humidity"),
        "min_visibility": ("min_vis_info", "visibility"),
    }
    columns = [F.col("time_window.start").alias("window_start")]
    for name, (info, metric) in timed.items():
        columns.append(F.col(f"{info}.{metric}").alias(name))
        columns.append(F.col(f"{info}.{EVENT_TIME}").alias(f"{name}_time"))
    return comparable(stats.select("city", "country", *columns))


def change_feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = change_features(window_stats(given.readings(spark, sf_dir)))
    return comparable(
        rows.select(
            "city", "country", F.col("time_window.start").alias("window_start"),
            "temp_rise", "temp_fall", "pressure_drop", "wind_rise", "humidity_rise",
            "temp_change_anomaly", "pressure_change_anomaly", "wind_change_anomaly",
            "humidity_change_anomaly", "visibility_change_anomaly",
        )
    )


def change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(change_alerts(given.readings(spark, sf_dir)))


def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_alerts(spark, sf_dir))


def alert_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = _alerts(spark, sf_dir)
    taken = [
        of_type(alerts, kind).groupBy("alert_type", "city").agg(F.count("*").alias("n_alerts"))
        for kind in ("threshold", "change")
    ]
    return taken[0].unionByName(taken[1])


def alert_anomalies_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(explode_anomalies(_alerts(spark, sf_dir)).drop("alert_uid"))


def alert_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = write_stage(explode_anomalies(_alerts(spark, sf_dir)), "anomalies")
    return comparable(suppress_repeats(rows).drop("alert_uid"))


def event_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.table(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return comparable(suppress_repeats(rows, ("event_type",), "ts", ("event_id",)))


def alert_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich(_alerts(spark, sf_dir)).select(
        "alert_type", "city", "country", "event_timestamp", "window_start", "id",
        F.posexplode("anomalies").alias("position", "item"),
    )
    # The inner times are compared as text without their zone suffix.
    return comparable(
        enriched.select(
            "alert_type", "city", "country", "event_timestamp", "window_start", "id", "position",
            "item.metric", "item.value", "item.message",
            F.substring("item.timestamp", 1, 23).alias("detected"),
        )
    )


def alert_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(deliver(_alerts(spark, sf_dir), RECIPIENTS))


def alert_payload_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(decode_alerts(alert_envelopes(_alerts(spark, sf_dir), ALERT_TOPIC)))


def _drained_topic(spark: SparkSession, sf_dir: str, name: str, detectors=tuple(DETECTORS)) -> str:
    """Run the detectors over the whole table; returns the folder of the alert topic."""
    root = fresh_path(spark, name)
    started = start_detectors(
        given.reading_stream(spark, sf_dir), f"{root}/checkpoints", folder=f"{root}/topic",
        names=detectors, kind="files", available_now=True,
    )
    drain(*started.values())
    return f"{root}/topic"


def _arrivals(spark: SparkSession, topic: str):
    """Feed the topic's alerts, in order of time, to a stream in three arrivals; yields the stream
    anew after each, for a query that goes on from its checkpoint."""
    parts = [
        decode_alerts(spark.read.parquet(f"{topic}/{name}")) for name in DETECTORS
    ]
    alerts = identify(parts[0].unionByName(parts[1]))
    number = sum((F.col("alert_time") >= F.lit(day).cast("timestamp")).cast("int") for day in ARRIVALS)
    for arrival in range(len(ARRIVALS) + 1):
        alerts.filter(number == arrival).select(ALERT.fieldNames()).write.mode("append").parquet(f"{topic}-feed")
        yield spark.readStream.schema(ALERT).parquet(f"{topic}-feed")


def stream_threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = _drained_topic(spark, sf_dir, "stream-threshold", ["threshold_detect"])
    return comparable(
        decode_alerts(spark.read.parquet(f"{topic}/threshold_detect")).select(
            "event_timestamp", "id", "city", "country", "temperature", "pressure", "visibility",
            "wind_speed", "temp_anomaly", "pressure_anomaly", "visibility_anomaly", "wind_anomaly",
        )
    )


def stream_change_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = _drained_topic(spark, sf_dir, "stream-change", ["change_detect"])
    return comparable(
        decode_alerts(spark.read.parquet(f"{topic}/change_detect")).select(
            "city", "country", "window_start", "max_temp", "max_temp_time", "min_temp",
            "min_temp_time", "temp_rise", "temp_fall", "temp_change_anomaly", "max_wind",
            "wind_rise", "wind_change_anomaly", "min_pressure", "pressure_drop",
            "pressure_change_anomaly", "max_humidity", "humidity_rise",
            "humidity_change_anomaly", "min_visibility", "visibility_change_anomaly",
        )
    )


def stream_alert_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = _drained_topic(spark, sf_dir, "stream-suppression")
    out = f"{topic}-emitted"
    for alerts in _arrivals(spark, topic):
        with state_settings(spark):
            emitted = suppress_repeats_stream(explode_anomalies(alerts))
            drain(write_rows(emitted, f"{out}/checkpoint", f"{out}/rows", available_now=True))
    return comparable(spark.read.parquet(f"{out}/rows").drop("alert_uid"))


def stream_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = _drained_topic(spark, sf_dir, "stream-notifications")
    out = f"{topic}-sent"
    for alerts in _arrivals(spark, topic):
        drain(start_notifications(alerts, f"{out}/checkpoint", out, RECIPIENTS, available_now=True))
    # The texts show averages with all digits, which depend on the order of summing.
    return comparable(spark.read.parquet(f"{out}/notifications").drop("body", "batch"))


def stream_match_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "stream-matches")
    given.match_polls(spark, sf_dir).write.text(f"{root}/polls")
    polls = spark.readStream.text(f"{root}/polls")
    drain(start_feed(polls, publish_matches, f"{root}/checkpoint", available_now=True,
                     kind="files", folder=f"{root}/topics"))
    sent = spark.read.parquet(f"{root}/topics")
    fields = F.from_json(F.col("value").cast("string"), MATCH)
    return sent.select("topic", F.col("key").cast("string").alias("key"), fields.alias("m")).select(
        "topic", "key", F.col("m.status").alias("status"), F.col("m.utcDate").alias("utcDate"))


def stream_reading_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "stream-readings")
    given.reading_payloads(spark, sf_dir).write.text(f"{root}/payloads")
    payloads = spark.readStream.text(f"{root}/payloads")
    drain(start_feed(payloads, publish_readings, f"{root}/checkpoint", available_now=True,
                     schema_id=SCHEMA_ID, kind="files", folder=f"{root}/topics"))
    sent = read_topic(spark, READING_TOPIC, "files", folder=f"{root}/topics", streaming=False)
    decoded = read_readings(sent, READING)
    doubled = {name: F.col(name).cast("double") for name in ("temperature", "wind_speed")}
    return comparable(decoded.withColumns(doubled).drop("ingested_at"))


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals on one checkpoint: first the clear readings of the first days, then all
    others, among them hazy ones of days whose windows are closed by then."""
    root = fresh_path(spark, "stream-late")
    r = given.readings(spark, sf_dir)
    early = (F.col("visibility") > LATE_VISIBILITY) & (
        F.col(EVENT_TIME) < F.lit(LATE_FROM_DAY).cast("timestamp")
    )
    for arrival in (early, ~early):
        r.filter(arrival).write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(r.schema).parquet(f"{root}/feed")
        stats = window_stats(feed.withWatermark(EVENT_TIME, WATERMARK)).select(
            "city", "country", F.col("time_window.start").alias("window_start"),
            "avg_temp", "min_wind", F.col("max_temp_info.temperature").alias("max_temp"),
            F.col(f"max_temp_info.{EVENT_TIME}").alias("max_temp_time"),
        )
        with state_settings(spark):
            drain(write_rows(stats, f"{root}/checkpoint", f"{root}/rows", available_now=True))
    return comparable(spark.read.parquet(f"{root}/rows"))


def payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_payloads(given.reading_payloads(spark, sf_dir), F.lit(STAMP))
    widened = {name: F.col(name).cast("double") for name in ("temperature", "wind_speed")}
    return comparable(flat.withColumns(widened))


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.table(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt")
    )
    return comparable(with_event_time(events))


def city_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = in_places(given.readings(spark, sf_dir), ALLOWED)
    return comparable(kept.select("id", "city", "country", "temperature", "event_timestamp"))


def _matches(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    return m.unpack_matches(given.match_polls(spark, sf_dir), F.lit(STAMP), fields=fields or None)


def _flat(matches: DataFrame) -> DataFrame:
    return matches.select(
        "id", "utcDate", "status", "matchday",
        F.col("homeTeam.name").alias("home"), F.col("awayTeam.name").alias("away"),
        F.col("score.fullTime.home").alias("home_goals"),
        F.col("score.fullTime.away").alias("away_goals"),
        F.col("score.penalties.home").alias("penalty_goals"),
        "ingested_at",
    )


def match_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_matches(spark, sf_dir))


def match_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.route(_matches(spark, sf_dir, "id", "status")).select("id", "status", "topic")


def match_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _matches(spark, sf_dir, "id", "utcDate", "status")
    live = m.in_days(matches, AS_OF).withColumn("part", F.lit("live"))
    past = m.history(matches, AS_OF).withColumn("part", F.lit("history"))
    return live.unionByName(past).select("part", "id", "utcDate", "status")


def match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.count_matches(_matches(spark, sf_dir, "status"))


def required_fields_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = flatten_payloads(given.reading_payloads(spark, sf_dir), F.lit(STAMP))
    whole = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    dropped = F.to_json(F.struct("*"))
    texts = r.select(whole.alias("whole"), dropped.alias("dropped")).unpivot([], ["whole", "dropped"], "set", "value")
    matches = m.match_texts(given.match_polls(spark, sf_dir))
    matches = matches.withColumn("set", F.when(F.col("status") == "POSTPONED", "none").otherwise("all"))
    checks = [
        check_groups(texts, {"whole": "weather", "dropped": "weather_without_nulls"}, "set", READING_KEYS),
        check_groups(matches, {"all": "historical_football"}, "set", MATCH_KEYS[:-1]),
        check_groups(matches, {"none": "live_football"}, "set"),
        check_groups(matches, {"none": "historical_football_none"}, "set", MATCH_KEYS),
    ]
    rows = checks[0]
    for check in checks[1:]:
        rows = rows.unionByName(check)
    return rows


def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of which some are cut off and some have a text where a number belongs."""
    raw = given.spoiled_payloads(spark, sf_dir)
    made = flatten_payloads(raw, F.lit(STAMP)).select("id", F.lit("").alias("reason"))
    return readings.payload_rejects(raw).select("id", "reason").unionByName(made)


def match_history_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "match-history")
    publish_history(given.match_polls(spark, sf_dir), AS_OF, kind="files", folder=root)
    sent = read_topic(spark, m.HISTORY_TOPIC, "files", folder=root, streaming=False)
    fields = F.from_json(F.col("value").cast("string"), MATCH)
    return sent.select("topic", F.col("key").cast("string").alias("key"), fields.alias("m")).select(
        "topic", "key", F.col("m.status").alias("status"), F.col("m.utcDate").alias("utcDate"))


def daily_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days loaded, then the first again without the rows of one country; the second raw set with the second day."""
    root = fresh_path(spark, "daily")
    days, out = ("2024-01-05", "2024-01-06"), f"{root}/raw"
    database = f"bronze_{root.rsplit('-', 1)[-1]}"
    payloads = given.reading_payloads(spark, sf_dir)
    day = F.date_format(F.timestamp_seconds(F.get_json_object("value", "$.dt").cast("bigint")), "yyyy-MM-dd")
    dated = write_stage(payloads.withColumn("date", day), "payloads")
    stock = given.prices(spark, sf_dir).drop("date")

    def put(number: int, date: str, rows: DataFrame) -> str:
        place = f"{root}/polls-{number}"
        rows.filter(F.col("date") == date).select("value").write.text(f"{place}/weather/{date}-polls")
        stock.write.json(f"{place}/stock/{date}-prices")
        return place

    run_batch(spark, put(0, days[0], dated), days[0], out, database, STAMP)
    run_batch(spark, put(1, days[1], dated), days[1], out, database, STAMP, stock=True)
    again = dated.filter(F.coalesce(F.get_json_object("value", "$.sys.country"), F.lit("")) != "VN")
    run_batch(spark, put(2, days[0], again), days[0], out, database, STAMP)
    landed = spark.table(f"{database}.weather_data").groupBy("day", "city").agg(
        F.count("*").alias("n_rows"), F.round(F.max("temperature"), given.PLACES).alias("top")
    )
    prices = spark.table(f"{database}.financial_data").groupBy("day", F.col("symbol").alias("city")).agg(
        F.count("*").alias("n_rows"), F.round(F.max("close"), given.PLACES).alias("top")
    )
    return landed.unionByName(prices)


def _raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = given.readings(spark, sf_dir)
    day = F.date_format(EVENT_TIME, "yyyy-MM-dd")
    return r.select(
        "city", "country", "weather_main", "weather_description", "temperature",
        *[F.col(name).cast("int").alias(name) for name in ("pressure", "humidity", "visibility")],
        "wind_speed", ingested_at(F.col(EVENT_TIME)).alias("record_timestamp"), day.alias("date"),
    )


def _landed(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = fresh_path(spark, name)
    landing.land_days(_raw_rows(spark, sf_dir), root)
    return root


def landing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landed(spark, sf_dir, "landing")
    # A second load of one day replaces that day and leaves the others.
    again = _raw_rows(spark, sf_dir).filter(F.col("date") == "2024-01-05")
    landing.land_days(again.withColumn("city", F.upper("city")), root)
    landed = spark.read.schema(
        "city STRING, temperature DOUBLE, year STRING, month STRING, day STRING"
    ).json(root)
    return comparable(
        landed.groupBy("year", "month", "day", "city").agg(
            F.count("*").alias("n_rows"), F.max("temperature").alias("max_temp")
        )
    )


def _table_over(spark: SparkSession, root: str, kind: str) -> str:
    """A raw table of its own over landed day folders."""
    name = root.rsplit("-", 1)[-1]
    tables.create_raw_database(spark, f"{root}_db", f"bronze_{name}")
    table = tables.create_raw_table(spark, f"{kind}_{name}", root, f"bronze_{name}", like=kind)
    tables.discover_partitions(spark, table)
    return table


def raw_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table_over(spark, _landed(spark, sf_dir, "rawtable"), "weather_data")
    return comparable(spark.table(table))


def raw_table_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the table: the other days' folders are not read."""
    table = _table_over(spark, _landed(spark, sf_dir, "rawday"), "weather_data")
    return comparable(spark.table(table).filter("year = '2024' AND month = '01' AND day = '17'"))


def financial_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "prices")
    landing.land_days(given.prices(spark, sf_dir), root)
    return comparable(spark.table(_table_over(spark, root, "financial_data")).drop("day"))


def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing held against what a scan of all files says of itself."""
    root = _landed(spark, sf_dir, "inventory")
    listed = landing.inventory(spark, root)
    rows = spark.read.schema("city STRING, year STRING, month STRING, day STRING").json(root)
    files = rows.select(*landing.PARTITIONS, "_metadata.file_path", "_metadata.file_size")
    files = files.groupBy(*landing.PARTITIONS, "file_path").agg(F.first("file_size").alias("size"), F.count("*").alias("n"))
    scanned = files.groupBy(*landing.PARTITIONS).agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("n").alias("n_rows")
    )
    return listed.join(scanned, landing.PARTITIONS, "full").select(
        *landing.PARTITIONS, "n_rows",
        (F.col("n_files") == F.col("files")).alias("files_agree"), (F.col("n_bytes") == F.col("bytes")).alias("bytes_agree"),
    )


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = flatten_payloads(given.reading_payloads(spark, sf_dir), F.lit(STAMP))
    sent = keyed_envelopes(r, "weather", schema_id=SCHEMA_ID)
    return sent.withColumns(
        {
            "timestamp": F.lit(STAMP),
            "offset": F.lit(None).cast("bigint"),
            "partition": F.lit(0),
        }
    )


def envelope_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected = unframed(_published(spark, sf_dir))
    body = F.from_json(F.col("body").cast("string"), READING)
    return comparable(projected.select("kafka_timestamp", "offset", "partition", body["id"].alias("id"), body["dt"].alias("dt")))


def frame_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _published(spark, sf_dir)
    decoded = read_readings(sent, READING)
    doubled = {name: F.col(name).cast("double") for name in ("temperature", "wind_speed")}
    return comparable(decoded.withColumns(doubled))


def keyed_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published to a folder and read back: each message with its key, and its body by fields."""
    root = fresh_path(spark, "keyed")
    publish(_published(spark, sf_dir), kind="files", folder=root)
    sent = read_topic(spark, READING_TOPIC, "files", folder=root, streaming=False)
    body = F.from_json(strip_frame("value").cast("string"), READING)
    return comparable(sent.select(
        "topic", frame_schema_id("value").alias("schema_id"), F.col("key").cast("string").alias("key"),
        body["city"].alias("city"), body["visibility"].alias("visibility"), body["dt"].alias("dt"),
    ))


QUERIES = {
    "change_alerts": change_rows,
    "threshold_alerts": threshold_rows,
    "threshold_flags": threshold_flags,
    "sliding_window_stats": sliding_window_stats,
    "window_extremes": window_extremes,
    "change_features": change_feature_rows,
    "all_alerts": all_alerts,
    "alert_dispatch": alert_dispatch,
    "alert_anomalies_exploded": alert_anomalies_exploded,
    "alert_suppression": alert_suppression,
    "event_suppression": event_suppression,
    "alert_enrichment": alert_enrichment,
    "alert_notifications": alert_notifications,
    "alert_payload_json": alert_payload_json,
    "stream_threshold_alerts": stream_threshold_alerts,
    "stream_change_alerts": stream_change_alerts,
    "stream_alert_suppression": stream_alert_suppression,
    "stream_notifications": stream_notifications,
    "stream_match_feed": stream_match_feed,
    "stream_reading_feed": stream_reading_feed,
    "stream_late_data": stream_late_data,
    "payload_flatten": payload_flatten,
    "event_times": event_times,
    "city_allow_list": city_allow_list,
    "match_flatten": match_flatten,
    "match_router": match_router,
    "match_date_window": match_date_window,
    "match_counts": match_counts,
    "required_fields_check": required_fields_check,
    "payload_rejects": payload_rejects,
    "match_history_feed": match_history_feed,
    "daily_batch": daily_batch,
    "envelope_projection": envelope_projection,
    "financial_table_scan": financial_table_scan,
    "landing_partitions": landing_partitions,
    "raw_table_scan": raw_table_scan,
    "raw_table_day": raw_table_day,
    "partition_inventory": partition_inventory,
    "frame_strip": frame_strip,
    "keyed_publish": keyed_publish,
}
