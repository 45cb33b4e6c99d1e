"""Event messages: JSON values keyed by aircraft, in Kafka or any text stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlake import schema
from flightlake.functions import measure

TOPIC = "flight_events"


def to_messages(events: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Events as ``key`` (aircraft id) and ``value`` (JSON). One key's messages keep their order in its partition."""
    value = lambda f: measure.iso_text(time) if f.name == "event_timestamp" else F.col(f.name).cast(f.dataType)
    body = [value(f).alias(f.name) for f in schema.MESSAGE]
    return events.select(F.col("icao24").cast("string").alias("key"), F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("value"))


def from_messages(messages: DataFrame, body: str = "value") -> DataFrame:
    """Event columns out of JSON values; messages without an aircraft id are ignored."""
    # As a generator the parse stays below the filter and runs once per message.
    parsed = messages.select(F.inline(F.array(F.from_json(F.col(body).cast("string"), schema.MESSAGE))))
    return parsed.filter(F.coalesce(F.col("icao24"), F.lit("")) != "").withColumn(
        "event_timestamp", F.to_timestamp("event_timestamp")
    )


def kafka_stream(spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "latest", rows_per_trigger: int = 1_000_000) -> DataFrame:
    """Messages of a topic. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", starting).option("maxOffsetsPerTrigger", rows_per_trigger).load()
    )


def stream_to_kafka(messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC) -> StreamingQuery:
    """Stream of messages appended to a topic, acknowledged by all replicas."""
    return (
        messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
        .option("topic", topic).option("checkpointLocation", checkpoint).start()
    )


def write_kafka(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Batch append to a topic, acknowledged by all replicas."""
    (
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
        .option("topic", topic).save()
    )
