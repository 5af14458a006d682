"""Kafka topics as sources and sinks.

Needs the public ``spark-sql-kafka-0-10`` connector on the session's classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from .wire import decode, encode


def read_options(brokers: str, topic: str, replay: bool = False, max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a topic read: from now on, or a replay of everything retained."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest" if replay else "latest",
        "failOnDataLoss": "false",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def write_options(brokers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def topic_stream(spark: SparkSession, brokers: str, topic: str, replay: bool = False,
                 max_per_trigger: int | None = None) -> DataFrame:
    options = read_options(brokers, topic, replay, max_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def topic_batch(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """Everything the topic retains, as a batch."""
    options = read_options(brokers, topic, replay=True)
    return spark.read.format("kafka").options(**options).load()


def tail(raw: DataFrame) -> DataFrame:
    """Partition, offset and decoded fields of each record, for inspection."""
    return decode(raw, None, "partition", "offset")


def publish(df: DataFrame, brokers: str, topic: str, key: str = "station") -> None:
    """Write readings to a topic, keyed so that one station keeps its order."""
    records = encode(df, key).withColumnRenamed(key, "key")
    records.write.format("kafka").options(**write_options(brokers, topic)).save()


def publish_stream(df: DataFrame, brokers: str, topic: str, checkpoint: str, key: str = "station") -> DataStreamWriter:
    records = encode(df, key).select(F.col(key).alias("key"), "value")
    return (
        records.writeStream.format("kafka")
        .options(**write_options(brokers, topic))
        .option("checkpointLocation", checkpoint)
    )
