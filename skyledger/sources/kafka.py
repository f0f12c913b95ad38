"""Kafka source and sink. They need the Kafka connector of the cluster's Spark version."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

# How the flight topic is read unless the caller says otherwise.
SOURCE_DEFAULTS = {
    "startingOffsets": "latest",
    "kafka.security.protocol": "PLAINTEXT",
    "failOnDataLoss": "false",
}


def source_options(
    servers: str, topic: str, options: dict[str, str] | None = None,
) -> dict[str, str]:
    return {
        **SOURCE_DEFAULTS, "kafka.bootstrap.servers": servers, "subscribe": topic,
        **(options or {}),
    }


def kafka_source(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None,
) -> DataFrame:
    """Unbounded topic. Pass `maxOffsetsPerTrigger` to bound a micro-batch."""
    reader = spark.readStream.format("kafka")
    return reader.options(**source_options(servers, topic, options)).load()


def kafka_batch(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None,
) -> DataFrame:
    """The topic's present content, from the earliest record."""
    wanted = {"startingOffsets": "earliest", **(options or {})}
    return spark.read.format("kafka").options(**source_options(servers, topic, wanted)).load()


def sink_options(
    servers: str, topic: str, acks: str | None = None, options: dict[str, str] | None = None,
) -> dict[str, str]:
    settings = {"kafka.bootstrap.servers": servers, "topic": topic}
    if acks:
        settings["kafka.acks"] = acks
    return {**settings, **(options or {})}


def kafka_sink(
    df: DataFrame, servers: str, topic: str, acks: str | None = "all",
    options: dict[str, str] | None = None,
) -> DataFrameWriter:
    """Writer for a table with a `value` column; the caller runs `.save()`."""
    return df.write.format("kafka").options(**sink_options(servers, topic, acks, options))


def to_kafka_json(df: DataFrame) -> DataFrame:
    """One JSON text per row in the column `value`; a null field is written as null."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def kafka_record_view(df: DataFrame) -> DataFrame:
    """Records of a Kafka source with key and value as text."""
    return df.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp")
