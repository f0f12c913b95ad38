"""Streaming scorer: JSON flights in, described predictions out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from skyledger.operators.ml import preprocess, score
from skyledger.sources.schemas import STREAM_SCHEMA

# Fixed value: pause between micro-batches of a continuously running scorer.
TRIGGER = "5 seconds"


def json_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files of a folder as a stream with the column `value`."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def message_stream(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """`Message i` at a steady rate."""
    return (
        spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
        .select(F.concat(F.lit("Message "), F.col("value").cast("string")).alias("value")))


def parse_flights(value_df: DataFrame, schema: StructType = STREAM_SCHEMA) -> DataFrame:
    """Typed columns out of a binary or text `value`; an unreadable one gives nulls."""
    return value_df.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def preprocess_stream(value_df: DataFrame, schema: StructType = STREAM_SCHEMA) -> DataFrame:
    return preprocess(parse_flights(value_df, schema))


def score_stream(
    value_df: DataFrame, model: PipelineModel, schema: StructType = STREAM_SCHEMA,
) -> DataFrame:
    return score(parse_flights(value_df, schema), model)


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def console_sink(df: DataFrame, checkpoint: str, trigger: str | None = TRIGGER) -> DataStreamWriter:
    return _triggered(
        df.writeStream.format("console").outputMode("append").option("truncate", False)
        .option("checkpointLocation", checkpoint), trigger)


def file_sink(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
) -> DataStreamWriter:
    """Replayable sink: with its checkpoint a restarted query writes every row once."""
    return _triggered(
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint), trigger)


def run_query(writer: DataStreamWriter, timeout: float | None = None) -> StreamingQuery:
    """Start, wait for the end, and always stop the query.

    A query that has not ended within `timeout` seconds is an error, since its output is not
    whole.
    """
    query = writer.start()
    try:
        ended = query.awaitTermination(timeout)
    finally:
        query.stop()
    if timeout is not None and not ended:
        raise TimeoutError(f"the query did not end within {timeout} seconds")
    return query


def run_for(writer: DataStreamWriter, seconds: float) -> StreamingQuery:
    """Run a query that has no end of its own for a while."""
    query = writer.start()
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()
    return query
