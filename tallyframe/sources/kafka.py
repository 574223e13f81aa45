"""Kafka topics of JSON records.

The connector is a separate Spark package (``spark-sql-kafka-0-10``) that the
session has to be started with.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from tallyframe.sources.records import to_records

# Delivery settings of the publisher.
PUBLISH_OPTIONS = {"kafka.retries": "5", "kafka.linger.ms": "10"}


def topic_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **more,
    }


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Everything in the topic now, as a batch frame with a ``value`` column."""
    bounded = {"endingOffsets": "latest", "failOnDataLoss": "false", **options}
    return spark.read.format("kafka").options(**topic_options(servers, topic, **bounded)).load()


def stream_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The topic from its start on, as a streaming frame with a ``value`` column."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()


def topic_writer(df: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrameWriter:
    """Writer of one keyless JSON message per row; executors publish in parallel."""
    return (
        to_records(df)
        .write.format("kafka")
        .options(**PUBLISH_OPTIONS, **(options or {}))
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )


def publish(df: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None) -> None:
    topic_writer(df, servers, topic, options).save()
