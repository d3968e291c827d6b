"""Registered queries of what goes wrong: rejects, broken loads, restarts, repeats, and what is counted of them."""

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustline.operators import matches as m
from gustline.operators.alerts import explode_anomalies
from gustline.operators.changes import labelled_alerts
from gustline.operators.readings import flatten_payloads, parse_payloads
from gustline.operators.suppression import KEYS, last_emissions, suppress_repeats
from gustline.operators.thresholds import threshold_alerts
from gustline.operators.windows import EVENT_TIME
from gustline.plans import given
from gustline.plans.daily import land_history, land_sets, raw_readings
from gustline.plans.given import comparable
from gustline.plans.queries import ARRIVALS, LATE_FROM_DAY, LATE_VISIBILITY, SCHEMA_ID, STAMP, _alerts, _arrivals, _drained_topic
from gustline.schemas import READING, READING_V2
from gustline.sources.envelopes import alert_envelopes, decode_alerts, decode_versions, once, publish, read_readings, read_topic
from gustline.sources.polls import archived_payloads, read_payloads
from gustline.sources.shared import fresh_path, write_stage
from gustline.sources.sinks import ALERT_TOPIC, write_rows
from gustline.streaming.accounts import Accounts, accounts, counted
from gustline.streaming.audit import held_emissions
from gustline.streaming.feeds import READING_TOPIC, publish_readings, start_feed
from gustline.streaming.jobs import drain, state_settings
from gustline.streaming.panes import pane_stats_stream
from gustline.streaming.suppression import suppress_repeats_stream

RELOADED = "2024-01-05"
HANDOVER = "2024-01-15"
RELOADED_FROM = "2024-01-20"


def match_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of which some are cut off, some have a word for an id, and some hold a number among their matches."""
    parsed = m.parse_polls(given.spoiled_polls(spark, sf_dir))
    return parsed.select("poll", "position", F.coalesce("reason", F.lit("")).alias("reason"), F.col("match.id").alias("id"))


def daily_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of both tables; then a reload that breaks while the second table is written; then a reload that does not.

    Shows what a reader of the day finds after each.
    """
    root = fresh_path(spark, "reload")
    database = f"bronze_{root.rsplit('-', 1)[-1]}"
    readings = flatten_payloads(given.reading_payloads(spark, sf_dir), F.lit(STAMP))
    of_day = F.date_format(F.timestamp_seconds("dt"), "yyyy-MM-dd") == RELOADED
    weather = write_stage(raw_readings(readings.filter(of_day)), "readings")
    stock = given.prices(spark, sf_dir).drop("date")
    newer = weather.withColumn("city", F.upper("city"))
    broken = stock.withColumn("volume", F.when(F.col("symbol") == "5-LOW", F.raise_error(F.lit("the disk is full")).cast("int")).otherwise(F.col("volume")))

    def found(phase: str) -> DataFrame:
        landed = spark.table(f"{database}.weather_data").groupBy("day", F.col("city").alias("name")).agg(
            F.count("*").alias("n_rows"), F.round(F.max("temperature"), given.PLACES).alias("top"))
        prices = spark.table(f"{database}.financial_data").groupBy("day", F.col("symbol").alias("name")).agg(
            F.count("*").alias("n_rows"), F.round(F.max("close"), given.PLACES).alias("top"))
        return write_stage(landed.unionByName(prices).withColumn("phase", F.lit(phase)), "found")

    def load(sets: dict[str, DataFrame]) -> None:
        land_sets(spark, sets, RELOADED, f"{root}/raw", database)

    load({"weather": weather, "stock": stock})
    phases = [found("loaded")]
    try:
        load({"weather": newer, "stock": broken})
    except Exception as error:
        phases.append(found("broken" if "the disk is full" in str(error) else "broken otherwise"))
    load({"weather": newer, "stock": stock.filter("symbol <> '5-LOW'")})
    phases.append(found("reloaded"))
    rows = phases[0]
    for phase in phases[1:]:
        rows = rows.unionByName(phase)
    return rows


def history_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days of both tables in one load; a reload of all that breaks in the second table; a reload of the last days of one.

    Shows what a reader finds after each.
    """
    root = fresh_path(spark, "history")
    database = f"bronze_{root.rsplit('-', 1)[-1]}"
    readings = flatten_payloads(given.reading_payloads(spark, sf_dir), F.lit(STAMP))
    day = F.date_format(F.timestamp_seconds("dt"), "yyyy-MM-dd").alias("date")
    weather = write_stage(raw_readings(readings, day), "readings")
    stock = given.prices(spark, sf_dir)
    newer = weather.withColumn("city", F.upper("city"))
    broken = stock.withColumn("volume", F.when(F.col("symbol") == "5-LOW", F.raise_error(F.lit("the disk is full")).cast("int")).otherwise(F.col("volume")))

    def found(phase: str) -> DataFrame:
        both = [
            spark.table(f"{database}.{table}").groupBy("year", "month", "day", F.col(name).alias("name")).agg(
                F.count("*").alias("n_rows"), F.round(F.max(top), given.PLACES).alias("top"))
            for table, name, top in (("weather_data", "city", "temperature"), ("financial_data", "symbol", "close"))
        ]
        return write_stage(both[0].unionByName(both[1]).withColumn("phase", F.lit(phase)), "found")

    def load(sets: dict[str, DataFrame]) -> None:
        land_history(spark, sets, f"{root}/raw", database)

    load({"weather": weather, "stock": stock})
    phases = [found("loaded")]
    try:
        load({"weather": newer, "stock": broken})
    except Exception as error:
        phases.append(found("broken" if "the disk is full" in str(error) else "broken otherwise"))
    load({"weather": newer.filter(F.col("date") >= RELOADED_FROM)})
    phases.append(found("reloaded"))
    rows = phases[0]
    for phase in phases[1:]:
        rows = rows.unionByName(phase)
    return rows


def archived_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings polled in three arrivals, whose files go to an archive; the second is read, lost before it is sent, and read again.

    Shows each reading that was sent, how often, and where its poll lies: those of the last trigger still in the folder.
    """
    root, lost = fresh_path(spark, "polls"), []
    payloads = given.reading_payloads(spark, sf_dir)
    at = F.timestamp_seconds(F.get_json_object("value", "$.dt").cast("bigint"))
    number = sum((at >= F.lit(day).cast("timestamp")).cast("int") for day in ARRIVALS)

    def send(batch: DataFrame, **target) -> None:
        if arrival == 1 and not lost:
            lost.append(arrival)
            raise RuntimeError("lost before sending")
        publish_readings(batch, **target)

    for arrival in range(len(ARRIVALS) + 1):
        payloads.filter(number == arrival).write.mode("append").text(f"{root}/in/polls")
        for _ in range(2):
            stream = read_payloads(spark, f"{root}/in/polls", archive=f"{root}/read/archive")
            query = start_feed(stream, send, f"{root}/checkpoint", available_now=True, schema_id=SCHEMA_ID, kind="files", folder=f"{root}/topics")
            try:
                drain(query)
                break
            except StreamingQueryException as error:
                if "lost before sending" not in str(error):
                    raise
    sent = read_readings(read_topic(spark, READING_TOPIC, "files", folder=f"{root}/topics", streaming=False), READING)
    sent = sent.groupBy("id").agg(F.count("*").alias("n_sent"), F.max("dt").alias("dt"))

    def lying(polls: DataFrame, name: str) -> DataFrame:
        return parse_payloads(polls).select("reading.id", F.lit(name).alias("lies"))

    polls = lying(archived_payloads(spark, f"{root}/read/archive"), "archive").unionByName(lying(spark.read.text(f"{root}/in/polls"), "folder"))
    return sent.join(polls, "id", "full").select("id", "n_sent", "dt", "lies")


def suppression_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first days' alerts suppressed as a batch, the others by a stream that begins with what the batch emitted last."""
    rows = write_stage(explode_anomalies(_alerts(spark, sf_dir)), "anomalies")
    past = F.col("alert_time") < F.lit(HANDOVER).cast("timestamp")
    kept = write_stage(suppress_repeats(rows.filter(past)), "past-emissions")
    root = fresh_path(spark, "handover")
    rows.filter(~past).write.parquet(f"{root}/feed")
    history = write_stage(last_emissions(kept), "history")
    with state_settings(spark):
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/feed")
        emitted = suppress_repeats_stream(stream, history=history)
        drain(write_rows(emitted, f"{root}/checkpoint", f"{root}/rows", available_now=True))
    return comparable(kept.unionByName(spark.read.parquet(f"{root}/rows")).drop("alert_uid"))


def suppression_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats of each user's events, which are many short-lived keys, in arrivals by time; state ends with the watermark."""
    events = given.table(spark, sf_dir, "events").select("event_type", "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    root, keys = fresh_path(spark, "expiring"), ("event_type", "user_id")
    number = sum((F.col("ts") >= F.lit(day).cast("timestamp")).cast("int") for day in ARRIVALS)
    for arrival in range(len(ARRIVALS) + 1):
        events.filter(number == arrival).write.mode("append").parquet(f"{root}/feed")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/feed")
        with state_settings(spark):
            emitted = suppress_repeats_stream(stream, keys, "ts", ("event_id",), late="10 minutes")
            drain(write_rows(emitted, f"{root}/checkpoint", f"{root}/rows", available_now=True))
    return comparable(spark.read.parquet(f"{root}/rows"))


def state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key's last emission as the checkpoint of a drained stream holds it, beside the one among the rows it wrote."""
    topic = _drained_topic(spark, sf_dir, "state-audit")
    out = f"{topic}-emitted"
    for alerts in _arrivals(spark, topic):
        with state_settings(spark):
            emitted = suppress_repeats_stream(explode_anomalies(alerts))
            drain(write_rows(emitted, f"{out}/checkpoint", f"{out}/rows", available_now=True))
    held = held_emissions(spark, f"{out}/checkpoint")
    written = spark.read.parquet(f"{out}/rows").groupBy(*KEYS).agg(F.max("alert_time").alias("written"))
    return comparable(held.join(written, list(KEYS), "full").select(*KEYS, "alert_time", "written"))


def frame_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings framed by two schemas in one topic, of which the second lacks some fields, has one more and wider numbers;
    some frames name a schema that is not known, some values have no frame, some are cut off."""
    r = flatten_payloads(given.reading_payloads(spark, sf_dir), F.lit(STAMP))
    by = F.col("id")
    older = F.to_json(F.struct(*READING.fieldNames()))
    newer = F.to_json(F.struct("id", "city", "country", F.col("temperature").cast("double").alias("temperature"), "humidity", "dt", "ingested_at", F.concat(F.lit("s"), by).alias("station")))
    body = F.when(by % 2 == 0, older).otherwise(newer)
    framed = r.withColumn("body", body).withColumn("body", F.when(by % 29 == 0, F.substring("body", 1, 20)).otherwise(F.col("body")).cast("binary"))
    number = F.when(by % 19 == 0, 99).when(by % 2 == 0, 7).otherwise(8)
    head = F.concat(F.when(by % 23 == 0, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))), F.unhex(F.lpad(F.hex(number.cast("bigint")), 8, "0")))
    topic = framed.select(by.cast("string").cast("binary").alias("key"), F.concat(head, F.col("body")).alias("value"))
    decoded = decode_versions(topic, {7: READING, 8: READING_V2}, READING)
    return comparable(decoded.select(
        F.col("key").cast("string").cast("bigint").alias("id"), "schema_id", F.coalesce("reason", F.lit("")).alias("reason"), "record.city",
        F.col("record.temperature").cast("double").alias("temperature"), "record.pressure", "record.humidity", "record.dt",
    ))


def alerts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts sent in batches, of which one breaks off after it was sent and is sent again; a reader that takes each once."""
    root, broken = fresh_path(spark, "once"), []
    r = given.readings(spark, sf_dir)
    for part in range(3):
        threshold_alerts(r.filter(F.col("id") % 3 == part)).write.mode("append").parquet(f"{root}/alerts")
    layout = spark.read.parquet(f"{root}/alerts").schema

    def send(batch: DataFrame, number: int) -> None:
        publish(alert_envelopes(batch, ALERT_TOPIC), kind="files", folder=f"{root}/topic")
        if number == 1 and not broken:
            broken.append(number)
            raise RuntimeError("lost after sending")

    for attempt in range(2):
        stream = spark.readStream.schema(layout).option("maxFilesPerTrigger", 1).parquet(f"{root}/alerts")
        query = stream.writeStream.option("checkpointLocation", f"{root}/sent").foreachBatch(send).trigger(availableNow=True).start()
        try:
            drain(query)
        except StreamingQueryException:
            if attempt:
                raise
    twice = write_stage(spark.read.parquet(f"{root}/topic"), "twice")
    with state_settings(spark):
        messages = once(read_topic(spark, ALERT_TOPIC, "files", folder=f"{root}/topic"))
        drain(write_rows(decode_alerts(messages), f"{root}/read", f"{root}/rows", available_now=True))
    # More messages were sent than there are alerts, or nothing was shown.
    again = twice.agg((F.count("*") > F.countDistinct("value")).alias("sent_again"))
    rows = spark.read.parquet(f"{root}/rows").select(
        "event_timestamp", "id", "city", "country", "temperature", "pressure", "visibility", "wind_speed",
        "temp_anomaly", "pressure_anomaly", "visibility_anomaly", "wind_anomaly")
    return comparable(rows.crossJoin(again))


def delivery_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of six triggers, which drops late rows, took in, sent and dropped, though its progress is held for one trigger only."""
    root, r = fresh_path(spark, "accounts"), given.readings(spark, sf_dir).select("id", EVENT_TIME)
    for part in range(6):
        r.filter(F.col("id") % 6 == part).coalesce(1).write.mode("append").parquet(f"{root}/feed")
        time.sleep(0.05)  # files are read in the order of their times
    held = "spark.sql.streaming.numRecentProgressUpdates"
    before, kept = spark.conf.get(held), Accounts(spark, f"{root}/accounts")
    spark.streams.addListener(kept)
    try:
        spark.conf.set(held, 1)
        stream = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed")
        unique = counted(stream.withWatermark(EVENT_TIME, "10 days").dropDuplicates(["id", EVENT_TIME]))
        with state_settings(spark):
            query = write_rows(unique, f"{root}/checkpoint", f"{root}/rows", available_now=True)
        drain(query)
        kept.settle(query)
    finally:
        spark.streams.removeListener(kept)
        spark.conf.set(held, before)
    told = accounts(spark, f"{root}/accounts").filter("rows_in > 0")
    return told.select(F.row_number().over(Window.orderBy("batch")).alias("part"), "rows_in", "rows_out", "rows_late")


def stream_pane_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrivals of `stream_late_data`, with panes as state: late readings miss the windows that are closed and no others."""
    root, r = fresh_path(spark, "stream-panes"), given.readings(spark, sf_dir)
    early = (F.col("visibility") > LATE_VISIBILITY) & (F.col(EVENT_TIME) < F.lit(LATE_FROM_DAY).cast("timestamp"))
    for arrival in (early, ~early):
        r.filter(arrival).write.mode("append").parquet(f"{root}/feed")
        stats = pane_stats_stream(spark.readStream.schema(r.schema).parquet(f"{root}/feed"))
        with state_settings(spark):
            drain(write_rows(stats, f"{root}/checkpoint", f"{root}/rows", available_now=True))
    return comparable(spark.read.parquet(f"{root}/rows").select(
        "city", "country", F.col("time_window.start").alias("window_start"), "avg_temp", "min_wind",
        F.col("max_temp_info.temperature").alias("max_temp"), F.col(f"max_temp_info.{EVENT_TIME}").alias("max_temp_time"),
    ))


def stream_pane_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change alerts of a stream whose windows are made of panes."""
    root = fresh_path(spark, "stream-pane-alerts")
    alerts = labelled_alerts(pane_stats_stream(given.reading_stream(spark, sf_dir)))
    with state_settings(spark):
        drain(write_rows(alerts, f"{root}/checkpoint", f"{root}/rows", available_now=True))
    return comparable(spark.read.parquet(f"{root}/rows").select(
        "city", "country", "window_start", "max_temp", "max_temp_time", "min_temp", "min_temp_time", "temp_rise", "temp_fall",
        "temp_change_anomaly", "max_wind", "wind_rise", "wind_change_anomaly", "min_pressure", "pressure_drop", "pressure_change_anomaly",
        "max_humidity", "humidity_rise", "humidity_change_anomaly", "min_visibility", "visibility_change_anomaly",
    ))


QUERIES = {
    "stream_pane_stats": stream_pane_stats,
    "stream_pane_alerts": stream_pane_alerts,
    "archived_polls": archived_polls,
    "history_reload": history_reload,
    "frame_versions": frame_versions,
    "alerts_once": alerts_once,
    "delivery_accounts": delivery_accounts,
    "match_rejects": match_rejects,
    "daily_reload": daily_reload,
    "suppression_handover": suppression_handover,
    "suppression_expiring": suppression_expiring,
    "state_audit": state_audit,
}
