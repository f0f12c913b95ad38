"""Bounded flight sources. Paths are any Hadoop path text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.sources.schemas import RAW_COLUMNS, TRAIN_SCHEMA


def read_flights_csv(
    spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS,
    partitions: int | None = None,
) -> DataFrame:
    """The named columns of headed CSV, all as text.

    Columns are found by the header, whatever their order and whatever else the files hold;
    only the first line is read for them. A name the header lacks is an error, and so is a
    file of the folder whose header differs from the others'. `partitions` forces a shuffle to
    that many partitions; leave it out to keep the partitions of the scan.
    """
    df = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    known = {name.lower() for name in df.columns}
    missing = [name for name in columns if name.lower() not in known]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    df = df.select(*(F.col(f"`{name}`").alias(name) for name in columns))
    return df.repartition(partitions) if partitions else df


def read_flights_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV with types inferred from all rows, which costs one more pass over the files."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_training_csv(
    spark: SparkSession, path: str, schema: StructType = TRAIN_SCHEMA, header: bool = False,
) -> DataFrame:
    """CSV under a fixed schema, matched by position; a bad number becomes null.

    Without a header every line is a row. With one, the first line of each file has to name
    the columns of the schema in order; any other first line is an error.
    """
    return (
        spark.read.schema(schema).option("header", header).option("enforceSchema", not header)
        .option("mode", "PERMISSIVE").csv(path))


def read_flight_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed payloads, one JSON text per line, in the column `value`."""
    return spark.read.text(path)


def literal_flights(
    spark: SparkSession, rows: Sequence[tuple], schema: StructType = TRAIN_SCHEMA,
) -> DataFrame:
    """A handful of rows given in the program, such as a scoring sample."""
    return spark.createDataFrame(list(rows), schema)


def numbered_messages(spark: SparkSession, rows: int = 100) -> DataFrame:
    """`Message 0` to `Message n-1`, the messages of the topic test."""
    return messages(spark.range(rows), "id")


def messages(df: DataFrame, number: str) -> DataFrame:
    return df.select(F.concat(F.lit("Message "), F.col(number).cast("string")).alias("value"))
