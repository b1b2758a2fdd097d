"""Kafka topics of event envelopes. Needs the public spark-sql-kafka package at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright import schemas as S


def read_topic(spark: SparkSession, servers: str, topic: str = "industrial.raw", stream: bool = True) -> DataFrame:
    """Envelopes of a topic from its earliest offset."""
    reader = spark.readStream if stream else spark.read
    raw = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return decode(raw)


def decode(raw: DataFrame) -> DataFrame:
    """Topic records to JSON lines with their key and envelope fields."""
    line = F.col("value").cast("string")
    return raw.select(
        F.col("key").cast("string").alias("key"), line.alias("line"), F.from_json(line, S.ENVELOPE).alias("event")
    ).select("key", "line", "event.*")


def encode(events: DataFrame) -> DataFrame:
    """Envelopes as topic records keyed by source system."""
    return events.select(
        F.col("source_system").alias("key"), F.to_json(F.struct(*events.columns)).alias("value")
    )


def write_topic(events: DataFrame, servers: str, topic: str = "industrial.raw") -> None:
    encode(events).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
