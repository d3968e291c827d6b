"""Raw payload texts to topics: unpack, check, route, publish."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gustline.functions.times import ingested_at
from gustline.operators import matches as m
from gustline.operators.quality import MATCH_KEYS, ValidationError, check_records, failures, lacks_keys
from gustline.operators.readings import count_outcomes, parse_payloads
from gustline.schemas import MATCH
from gustline.sources.envelopes import keyed_envelopes, publish
from gustline.sources.shared import write_stage

# The topic of the readings and the names of the checked match sets.
READING_TOPIC = "weather"
MATCH_SETS = {m.LIVE_TOPIC: "live_football", m.HISTORY_TOPIC: "recent_finish_football"}


def _admit(parsed: DataFrame, name: str, made: str, rejects: str | None, most_rejects: int | None) -> tuple[DataFrame, dict]:
    """The parsed rows as a written table, and their counts, once these allow it; the rejected ones go to their folder."""
    staged = write_stage(parsed, name)
    counted = count_outcomes(staged)
    if most_rejects is not None and counted["n_rejected"] > most_rejects:
        raise ValidationError(f"{counted['n_rejected']} of {counted['n']} {made}")
    if counted["n_rejected"] and rejects:
        bad = staged.filter("reason IS NOT NULL")
        bad.drop("reading", "match").write.mode("append").json(rejects)
    return staged.filter("reason IS NULL"), counted


def publish_readings(raw: DataFrame, avro_schema: str | None = None, schema_id: int | None = None,
                     rejects: str | None = None, most_rejects: int | None = None, **target) -> dict:
    """Publish one poll's or batch's readings, keyed by id; returns what was counted.

    The batch is read and parsed once. Payloads that make no reading are, with `rejects`, appended
    to that folder. More of them than `most_rejects` fail the batch before anything is published; 0 fails it
    at the first.
    """
    good, counted = _admit(parse_payloads(raw), "readings", "payloads make no reading", rejects, most_rejects)
    if counted["n"] > counted["n_rejected"]:
        publish(keyed_envelopes(good.select("reading.*"), READING_TOPIC, avro_schema, schema_id), **target)
    return counted


def publish_matches(raw: DataFrame, avro_schema: str | None = None, schema_id: int | None = None,
                    rejects: str | None = None, most_rejects: int | None = None, **target) -> dict:
    """Publish matches to the live or the history topic in one write, keyed by id; returns what was counted.

    One aggregation checks both sets before that; a failed check publishes none. The time of ingestion is
    added here, all other keys must have come. Elements and polls that make no match are treated as payloads that
    make no reading are.
    """
    sent_keys = tuple(key for key in MATCH_KEYS if key != "ingested_at")
    good, counted = _admit(m.parse_polls(raw, with_texts=True), "matches", "elements make no match", rejects, most_rejects)
    routed = m.route(good.select("text", "match.*"))
    failed = routed.groupBy("topic").agg(F.count_if(lacks_keys(sent_keys, "text")).alias("lacking")).filter("lacking > 0").collect()
    if failed:
        raise ValidationError(f"matches lack required keys in {', '.join(sorted(MATCH_SETS[r.topic] for r in failed))}")
    if counted["n"] > counted["n_rejected"]:
        sent = routed.withColumn("ingested_at", ingested_at())
        publish(keyed_envelopes(sent, F.col("topic"), avro_schema, schema_id, fields=MATCH.fieldNames()), **target)
    return counted


def publish_history(raw: DataFrame, as_of: date, avro_schema: str | None = None, schema_id: int | None = None,
                    rejects: str | None = None, most_rejects: int | None = None, **target) -> dict:
    """The batch feed: the finished matches of the days before `as_of`, checked and published to the history topic.

    Polls are parsed once, and rejects treated as in `publish_matches`; only the rejects and the matches of those days are written between.
    """
    parsed = m.parse_polls(raw, with_texts=True)
    of_days = m.history(parsed.select("*", "match.utcDate", "match.status"), as_of, otherwise=F.col("reason").isNotNull())
    good, counted = _admit(of_days.drop("utcDate", "status"), "history", "elements make no match", rejects, most_rejects)
    counted["n"] -= counted["n_rejected"]
    keys = tuple(key for key in MATCH_KEYS if key != "ingested_at")
    failed = failures(check_records(good, MATCH_SETS[m.HISTORY_TOPIC], keys, "text")) if counted["n"] else []
    if failed:
        raise ValidationError("; ".join(failed))
    if counted["n"]:
        found = good.select("match.*", ingested_at().alias("ingested_at"))
        publish(keyed_envelopes(found, m.HISTORY_TOPIC, avro_schema, schema_id), **target)
    return counted


def start_feed(
    raw: DataFrame,
    publisher: Callable[..., None],
    checkpoint: str,
    available_now: bool = False,
    **target,
) -> StreamingQuery:
    """Run one of the publishers on every batch of a stream of payload texts.

    Publishing is at least once: a batch that is run again is published again.
    """

    def send(batch: DataFrame, number: int) -> None:
        publisher(batch, **target)

    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(send)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
