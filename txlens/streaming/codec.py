"""Event messages: JSON keyed by payment id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.sources.schema import STREAM_MESSAGE

TOPIC = "raw_transactions"
REQUIRED = (
    "transaction_id", "timestamp", "customer_id", "card_id", "amount", "location_lat", "location_long",
)
NUMBERS = ("amount", "location_lat", "location_long")
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def encode_events(tx: DataFrame, key: str = "transaction_id") -> DataFrame:
    """(key, value) messages; timestamps are written as RFC 3339 text."""
    text = {
        f.name: F.date_format(f.name, RFC3339)
        for f in tx.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    body = tx.withColumns(text) if text else tx
    return body.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*tx.columns)).alias("value")
    )


def decode_events(messages: DataFrame, schema: T.StructType = STREAM_MESSAGE) -> DataFrame:
    """Message fields as columns next to the message's own; ``_bad`` marks what does not parse."""
    event = F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"})
    parsed = messages.withColumn("_event", event)
    fields = [F.col(f"_event.{f.name}").alias(f.name) for f in schema.fields if f.name != "timestamp"]
    carried = [c for c in messages.columns if c != "value"]
    ts = F.col("_event.timestamp").try_cast("timestamp").alias("timestamp")
    # Without id, time, owner, card, amount or place a message cannot enter the running state.
    out = parsed.select(*carried, "value", *fields, ts)
    lacking = [F.col(c).isNull() for c in REQUIRED if c in out.columns]
    lacking += [F.isnan(c) for c in NUMBERS if c in out.columns]
    return out.withColumn("_bad", F.coalesce(reduce(Column.__or__, lacking), F.lit(True)))


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good events, and the bad ones as they came, with key and arrival time if there are any."""
    good = decoded.filter(~F.col("_bad")).drop("value", "_bad")
    bad = decoded.filter("_bad").select("value", *[c for c in ("key", "received_at") if c in decoded.columns])
    return good, bad


def read_kafka(spark: SparkSession, servers: str, topic: str = TOPIC, per_trigger: int = 100_000) -> DataFrame:
    """Live messages from the first offset on; needs the Spark Kafka package on the cluster."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
        .select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("received_at"),
        )
    )


def read_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The same messages from a folder of JSON-lines files, one folder per published run."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("value", F.current_timestamp().alias("received_at"))
    )


def publish_kafka(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Append to the topic. A run that is repeated sends its messages again; the files' form does not."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_files(messages: DataFrame, path: str, run: str = "all") -> None:
    """One JSON line a message. Publishing a run again replaces its files; nothing is doubled."""
    messages.select("value").write.mode("overwrite").text(f"{path}/{run}")
