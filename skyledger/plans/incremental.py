"""Named queries of what arrives in batches: record logs, streams of payloads, report states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import delay_class
from skyledger.operators import cleaning, landing, ml, report_state, reports
from skyledger.session import fresh_folder, materialize
from skyledger.sources import records, sinks, star
from skyledger.streaming import normalizer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Partitions of the logs below, and batches in which a stream reads its largest one.
PARTITIONS, BATCHES = 4, 3


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _event() -> Column:
    return F.col("key").cast("string").cast("bigint")


def _log(spark: SparkSession, sf: str) -> tuple[str, int]:
    """A log of all payloads, and how many records of a partition make a third of the largest."""
    path = fresh_folder(spark, "records")
    rows = star.kafka_records(spark, sf).withColumn("event_id", _event())
    offsets = records.publish(
        rows, path, F.col("event_id") % PARTITIONS, ["event_id"])
    return path, max(map(len, offsets.values()), default=0) // BATCHES + 1


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(
        "partition", "offset", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS").alias("timestamp"))


@query
def published_records(spark: SparkSession, sf: str) -> DataFrame:
    """Two writes to one log, each acknowledged with the offsets its records got."""
    path = fresh_folder(spark, "records")
    rows = star.kafka_records(spark, sf).withColumn("event_id", _event())
    for odd in (0, 1):
        records.publish(rows.where(F.col("event_id") % 2 == odd), path,
                        F.floor(F.col("event_id") / 2) % PARTITIONS, ["event_id"])
    return _as_text(records.read_records(spark, path))


@query
def record_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A stream over a log that is stopped after two batches and resumed."""
    path, most = _log(spark, sf)
    target, checkpoint = fresh_folder(spark, "streamed"), fresh_folder(spark, "checkpoint")
    writer = records.record_stream(spark, path, "earliest", most).writeStream.format(
        "parquet").option("path", target).option("checkpointLocation", checkpoint)
    normalizer.run_batches(writer, 2)
    normalizer.drain(writer)
    return _as_text(spark.read.schema(records.SCHEMA).parquet(target))


def _normalized(spark: SparkSession, sf: str, log: normalizer.ProgressLog | None = None) -> str:
    """The folder of both tables that a stream stored, stopped after its first batch and resumed."""
    path, most = _log(spark, sf)
    folder, checkpoint = fresh_folder(spark, "normalized"), fresh_folder(spark, "checkpoint")

    def sink():
        return normalizer.normalized_sink(
            records.record_stream(spark, path, "earliest", most), folder, checkpoint)

    log_ended = normalizer.run_batches(sink(), 1)
    if log is not None:
        log.wait_for_end(log_ended)
    normalizer.drain(sink(), log)
    return folder


def _stored(spark: SparkSession, sf: str, folder: str, name: str) -> DataFrame:
    usable, rejected = normalizer.normalize_flights(
        spark.createDataFrame([], records.SCHEMA))
    schema = (usable if name == normalizer.FLIGHTS else rejected).schema
    return normalizer.stored(spark, folder, name, schema)


@query
def stream_normalized(spark: SparkSession, sf: str) -> DataFrame:
    folder = _normalized(spark, sf)
    return _stored(spark, sf, folder, normalizer.FLIGHTS).drop("batch")


@query
def stream_rejected(spark: SparkSession, sf: str) -> DataFrame:
    folder = _normalized(spark, sf)
    return _stored(spark, sf, folder, normalizer.REJECTED).select(
        _event().alias("event_id"), F.col("value").cast("string").alias("value"), "problem")


@query
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the engine reported of each batch, and rows that the batch stored."""
    log = normalizer.ProgressLog()
    spark.streams.addListener(log)
    try:
        folder = _normalized(spark, sf, log)
    finally:
        spark.streams.removeListener(log)
    told = spark.createDataFrame(
        [(b.batch, b.rows_in) for b in log.batches], "batch bigint, rows_in bigint")
    out = None
    for name in (normalizer.FLIGHTS, normalizer.REJECTED):
        rows = _stored(spark, sf, folder, name).groupBy("batch").agg(F.count("*").alias("rows"))
        out = rows if out is None else out.unionAll(rows)
    out = out.groupBy(F.col("batch").cast("bigint").alias("batch")).agg(
        F.sum("rows").alias("rows_out"))
    return told.join(out, "batch", "full")


def _refreshed(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        folder = fresh_folder(spark, "states")
        columns = [*reports.REPORT_COLUMNS[name], "OP_CARRIER_FL_NUM"]
        flights = materialize(cleaning.clean_flights(star.raw_flights(spark, sf, columns)), "flights")
        for half in (0, 1):
            report_state.store_batch(
                flights.where(F.col("OP_CARRIER_FL_NUM").cast("bigint") % 2 == half),
                folder, str(half), [name])
        return report_state.refreshed_report(spark, folder, name)
    return run


@query
def landed_flights_in_window(spark: SparkSession, sf: str) -> DataFrame:
    """The window of `flights_in_window` over payloads that were landed by day."""
    path = fresh_folder(spark, "landed")
    landing.land_by_day(star.flight_payloads(spark, sf).select("event_id", "value"), path)
    return landing.landed_in_window(
        spark.read.parquet(path), begin=1704067200, end=1705999999, now=1704800000)


@query
def replaced_report(spark: SparkSession, sf: str) -> DataFrame:
    """The current version of a report that was written twice, over half and over all flights."""
    folder = fresh_folder(spark, "report")
    columns = [*reports.REPORT_COLUMNS["delay_severity_analysis"], "OP_CARRIER_FL_NUM"]
    flights = cleaning.clean_flights(star.raw_flights(spark, sf, columns))
    half = flights.where(F.col("OP_CARRIER_FL_NUM").cast("bigint") % 2 == 0)
    for part in (half, flights):
        sinks.replace_report(reports.delay_severity_analysis(part), folder)
    return sinks.read_report(spark, folder)


@query
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    """What the rows of each class weigh together when a fit balances them by weight."""
    flights = star.train_flights(spark, sf, ["DepDelay"]).select(
        delay_class("DepDelay").alias(ml.LABEL))
    return ml.class_weights(flights).groupBy(ml.LABEL).agg(
        F.count("*").alias("count"), F.round(F.sum(ml.WEIGHT), 3).alias("weight"))


for _name in report_state.STATES:
    QUERIES[f"refreshed_{_name}"] = _refreshed(_name)


def oracle_sql(payloads: str, landed: list[str], catalog_sql: dict[str, str]) -> dict[str, str]:
    """SQL of these queries out of the common table expressions of the catalog's."""
    def placed(partition: str, order: str) -> str:
        return f"""placed AS (
  SELECT *, CAST({partition} AS INTEGER) AS part,
    row_number() OVER (PARTITION BY {partition} ORDER BY {order}) - 1 AS place
  FROM payloads)"""

    one_write = placed(f"event_id % {PARTITIONS}", "event_id")
    two_writes = placed(f"event_id // 2 % {PARTITIONS}", "event_id % 2, event_id")
    shown = """SELECT part AS "partition", place AS "offset", CAST(event_id AS VARCHAR) AS "key",
  value, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS "timestamp" FROM placed"""

    def sql(ctes: list[str], body: str) -> str:
        return "WITH " + ",".join(ctes) + "\n" + body

    return {
        "published_records": sql([payloads, two_writes], shown),
        "record_stream": sql([payloads, one_write], shown),
        "stream_normalized": sql(landed, "SELECT * FROM normalized"),
        "stream_rejected": sql(
            landed, "SELECT event_id, value, problem FROM problems WHERE problem IS NOT NULL"),
        "stream_progress": sql([payloads, one_write, f"""most AS (
  SELECT (MAX(place) + 1) // {BATCHES} + 1 AS most FROM placed)"""], """SELECT
  place // most AS batch, COUNT(*) AS rows_in, COUNT(*) AS rows_out
FROM placed, most GROUP BY 1"""),
        "landed_flights_in_window": catalog_sql["flights_in_window"],
        "replaced_report": catalog_sql["delay_severity_analysis"],
        "class_weights": f"""SELECT DelayCategory, "count",
  CAST(MAX("count") OVER () AS DOUBLE) AS weight FROM ({catalog_sql["class_distribution"]})""",
        **{f"refreshed_{name}": catalog_sql[name] for name in report_state.STATES},
    }
