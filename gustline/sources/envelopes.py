"""Message envelopes: topic scan, decoding, keyed publishing.

The Kafka and Avro forms need the spark-sql-kafka and spark-avro packages on the session.
The file form carries the same envelope rows in parquet folders.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro, to_avro
from pyspark.sql.types import StringType, StructField, StructType

from gustline.functions.frames import add_frame, frame_schema_id, strip_frame
from gustline.functions.times import event_time
from gustline.schemas import ALERT, ENVELOPE

# Producer settings.
KAFKA_WRITE = {"kafka.acks": "all", "kafka.compression.type": "zstd"}
# What one trigger reads at most: it bounds what keyed state holds while it runs.
TRIGGER_LIMITS = {"kafka": {"maxOffsetsPerTrigger": "5000000"}, "files": {"maxFilesPerTrigger": "1000"}}


def read_topic(
    spark: SparkSession,
    topic: str,
    kind: str = "kafka",
    servers: str | None = None,
    folder: str | None = None,
    starting: str | None = None,
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """Envelope rows of one topic, from Kafka or from a parquet folder of such rows.

    On Kafka a new query begins at the earliest offset unless told; a folder is always read
    whole, so it takes no `starting`. One trigger of a stream reads no more than `TRIGGER_LIMITS`
    say, unless the options give other limits.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming:
        options = {**TRIGGER_LIMITS.get(kind, {}), **options}
    if kind == "files":
        if starting is not None:
            raise ValueError("a folder of envelopes is read whole; it has no starting offsets")
        rows = reader.schema(ENVELOPE).options(**options).parquet(folder)
        return rows.filter(F.col("topic") == topic)
    if kind != "kafka":
        raise ValueError(f"unknown transport {kind!r}")
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting or "earliest",
        "failOnDataLoss": "false",
    }
    return reader.format("kafka").options(**settings).options(**options).load()


def read_new_alerts(spark: SparkSession, topic: str, **source) -> DataFrame:
    """Alert messages from now on: on Kafka a new consumer begins at the latest offset."""
    if source.get("kind", "kafka") == "kafka":
        source = {"starting": "latest", **source}
    return decode_alerts(read_topic(spark, topic, **source))


def load_value_schema(spark: SparkSession, path: str) -> str:
    """Text of one schema file; missing or empty stops the start."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None or not text[0].strip():
        raise ValueError(f"no value schema at {path}")
    return text[0]


def unframed(envelopes: DataFrame) -> DataFrame:
    """Envelope columns as the decoder uses them, with the body behind the frame."""
    return envelopes.select(
        F.col("timestamp").alias("kafka_timestamp"),
        "offset",
        "partition",
        strip_frame("value").alias("body"),
    )


def decode(envelopes: DataFrame, schema: StructType | str, framed: bool = True) -> DataFrame:
    """The fields of each value: Avro for a schema text, JSON for a StructType."""
    body = strip_frame("value") if framed else F.col("value")
    if isinstance(schema, str):
        data = from_avro(body, schema)
    else:
        data = F.from_json(body.cast("string"), schema, {"mode": "FAILFAST"})
    return envelopes.select(data.alias("data")).select("data.*")


def read_readings(envelopes: DataFrame, schema: StructType | str, framed: bool = True) -> DataFrame:
    """Readings with their event time."""
    return decode(envelopes, schema, framed).withColumn("event_timestamp", event_time("dt"))


# Why a framed value makes no record.
NO_FRAME, UNKNOWN_SCHEMA, NOT_DECODED = "no frame", "unknown schema", "not decoded"


def decode_versions(envelopes: DataFrame, schemas: Mapping[int, StructType | str], target: StructType) -> DataFrame:
    """Envelopes of a topic whose values follow several schemas: all their columns, `schema_id`, the `record` each makes in the
    layout of `target`, and the `reason` why it makes none.

    Each value is decoded with the schema its frame names, and by no other: Avro for a schema text, JSON for a
    StructType. A field that a schema does not have is null, one that `target` does not have is left out. A value without a
    frame, of a schema that is not in `schemas`, or that does not fit its schema is rejected and keeps its envelope.
    """
    corrupt, body = "_corrupt", strip_frame("value")
    rows, made, fits = envelopes.withColumn("schema_id", frame_schema_id("value")), [], []
    for number, schema in schemas.items():
        name = f"_v{number}"
        if isinstance(schema, str):
            parsed = from_avro(body, schema, {"mode": "PERMISSIVE"})
        else:
            layout = StructType([*schema, StructField(corrupt, StringType())])
            parsed = F.from_json(body.cast("string"), layout, {"columnNameOfCorruptRecord": corrupt})
        # What a generator makes is decoded once.
        rows = rows.withColumn(name, F.explode(F.array(F.when(F.col("schema_id") == number, parsed))))
        has = set(rows.schema[name].dataType.fieldNames())
        fields = [(F.col(f"{name}.{f.name}") if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
        good = F.col(name).isNotNull()
        good = good & F.col(f"{name}.{corrupt}").isNull() if corrupt in has else good
        made.append(F.when(good, F.struct(*fields)))
        fits.append(good)
    known = F.col("schema_id").isin(*schemas)
    decoded = F.coalesce(*made)
    reason = F.when(F.col("schema_id").isNull(), NO_FRAME).when(~known, UNKNOWN_SCHEMA).when(decoded.isNull(), NOT_DECODED)
    return rows.select(*envelopes.columns, "schema_id", decoded.alias("record"), reason.alias("reason"))


def once(envelopes: DataFrame, within: str = "1 hour") -> DataFrame:
    """Messages of a stream without those that are sent again: a producer that runs a batch again sends it whole again.

    A message is known by its topic, key and value, so equal messages count as one. An id is remembered while the
    watermark, `within` behind the latest envelope's time, has not passed it; what is sent again later than that comes through.
    """
    told = envelopes.withWatermark("timestamp", within)
    same = F.sha2(F.concat_ws("/", F.hex(F.encode("topic", "UTF-8")), F.hex("key"), F.hex("value")), 256)
    return told.withColumn("message_id", same).dropDuplicatesWithinWatermark(["message_id"]).drop("message_id")


def alert_rejects(envelopes: DataFrame) -> DataFrame:
    """Messages of the alert topic that are no alert: not a JSON object, or a field of a wrong type."""
    return _parsed_alerts(envelopes).filter(~_is_alert()).drop(PARSED)


def _parsed_alerts(envelopes: DataFrame) -> DataFrame:
    layout = StructType([*ALERT, StructField("_corrupt", StringType())])
    parsed = F.from_json(F.col("value").cast("string"), layout, {"columnNameOfCorruptRecord": "_corrupt"})
    return envelopes.withColumn(PARSED, F.explode(F.array(parsed)))


def _is_alert() -> Column:
    return F.col(PARSED).isNotNull() & F.col(f"{PARSED}._corrupt").isNull()


PARSED = "_parsed"


def decode_alerts(envelopes: DataFrame) -> DataFrame:
    """Alert messages; an omitted field is null. What is no alert is left out: `alert_rejects` returns it."""
    return _parsed_alerts(envelopes).filter(_is_alert()).select([F.col(f"{PARSED}.{f.name}") for f in ALERT])


def keyed_envelopes(
    records: DataFrame,
    topic: str | Column,
    avro_schema: str | None = None,
    schema_id: int | None = None,
    key: str = "id",
    fields: list[str] | None = None,
) -> DataFrame:
    """Key, value and topic of each record: text key, JSON or (framed) Avro value."""
    fields = F.struct(*[F.col(name) for name in fields or records.columns])
    value = to_avro(fields, avro_schema) if avro_schema else F.to_json(fields).cast("binary")
    if schema_id is not None:
        value = add_frame(value, schema_id)
    return records.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        value.alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
    )


def alert_envelopes(alerts: DataFrame, topic: str) -> DataFrame:
    """Alerts as JSON without a key."""
    fields = F.struct(*[F.col(name) for name in alerts.columns])
    return alerts.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(fields).alias("value"),
        F.lit(topic).alias("topic"),
    )


def publish(envelopes: DataFrame, kind: str = "kafka", servers: str | None = None,
            folder: str | None = None) -> None:
    """Append envelopes of a bounded frame to Kafka or to a folder."""
    if kind == "kafka":
        settings = {"kafka.bootstrap.servers": servers, **KAFKA_WRITE}
        envelopes.write.format("kafka").options(**settings).save()
    elif kind == "files":
        _file_envelopes(envelopes).write.mode("append").parquet(folder)
    else:
        raise ValueError(f"unknown transport {kind!r}")


def _file_envelopes(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.lit(0).alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
