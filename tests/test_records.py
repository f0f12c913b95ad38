import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyledger.session import fresh_folder
from skyledger.sources import records
from skyledger.streaming import normalizer
from skyledger.streaming.scorer import file_sink, run_query


def messages(spark, first, last, bad=()):
    rows = spark.range(first, last).select(
        F.col("id"), F.col("id").cast("string").alias("key"),
        F.concat(F.lit("Message "), F.col("id").cast("string")).alias("value"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"))
    return rows.withColumn("value", F.when(F.col("id").isin(*bad), F.lit("bad")).otherwise(
        F.col("value"))) if bad else rows


def publish(df, path, partitions=3):
    return records.publish(df, path, F.col("id") % partitions, ["id"])


def told(df):
    return sorted((r.partition, r.offset, r.key.decode(), r.value.decode())
                  for r in df.select("partition", "offset", "key", "value").collect())


def expected(last, partitions=3):
    return sorted((i % partitions, i // partitions, str(i), f"Message {i}") for i in range(last))


def test_offsets_follow_the_order_over_writes(spark):
    path = fresh_folder(spark, "log")
    assert publish(messages(spark, 0, 100).repartition(7), path) == {
        0: range(0, 34), 1: range(0, 33), 2: range(0, 33)}
    assert publish(messages(spark, 100, 101), path) == {1: range(33, 34)}
    assert publish(messages(spark, 101, 101), path) == {}
    publish(messages(spark, 101, 200), path)
    log = records.read_records(spark, path)
    assert told(log) == expected(200)
    times = {r.key.decode(): r.at for r in log.select("key", F.unix_seconds("timestamp").alias("at"))
             .collect()}
    assert all(int(key) == at for key, at in times.items())


def test_a_failed_write_publishes_nothing_and_can_be_repeated(spark):
    path = fresh_folder(spark, "log")
    publish(messages(spark, 0, 30), path)
    failing = messages(spark, 30, 60).withColumn("key", F.when(F.col("id") == 59, F.raise_error(
        F.lit("broken"))).otherwise(F.col("key")))
    with pytest.raises(PySparkException):
        publish(failing, path)
    assert told(records.read_records(spark, path)) == expected(30)
    publish(messages(spark, 30, 60), path)
    assert told(records.read_records(spark, path)) == expected(60)


def test_a_task_that_ran_twice_counts_once(spark):
    """Only staged files that a commit names are part of the log."""
    path = fresh_folder(spark, "log")
    publish(messages(spark, 0, 9), path)
    files, root = records._filesystem(path)
    commit = json.loads(files.open_input_file(f"{root}/commits/{0:012d}.json").read())
    name = commit["files"][0][0]
    files.copy_file(f"{root}/data/{name}", f"{root}/data/again-{name}")
    assert told(records.read_records(spark, path)) == expected(9)


def test_an_empty_log(spark):
    path = fresh_folder(spark, "log")
    assert records.read_records(spark, path).count() == 0


def test_a_stream_stops_and_resumes_where_it_was(spark):
    path, target = fresh_folder(spark, "log"), fresh_folder(spark, "out")
    checkpoint = fresh_folder(spark, "checkpoint")
    publish(messages(spark, 0, 90), path)
    publish(messages(spark, 90, 120), path)

    def writer():
        stream = records.record_stream(spark, path, "earliest", most=7)
        return stream.writeStream.format("parquet").option("path", target).option(
            "checkpointLocation", checkpoint)

    def stored():
        return told(spark.read.schema(records.SCHEMA).parquet(target))

    normalizer.run_batches(writer(), 2)
    assert stored() == [row for row in expected(120) if row[1] < 14]
    normalizer.run_batches(writer(), 1)
    assert stored() == [row for row in expected(120) if row[1] < 21]
    normalizer.drain(writer())
    assert stored() == expected(120)
    publish(messages(spark, 120, 150), path)
    normalizer.drain(writer())
    assert stored() == expected(150)


@pytest.mark.parametrize(("starting", "first"), [
    ("latest", 30), ("earliest", 0), ('{"0": 5, "1": 5, "2": 5}', 15)])
def test_where_a_stream_starts(spark, starting, first):
    path, target = fresh_folder(spark, "log"), fresh_folder(spark, "out")
    checkpoint = fresh_folder(spark, "checkpoint")
    publish(messages(spark, 0, 30), path)
    stream = records.record_stream(spark, path, starting)
    run_query(file_sink(stream, target, checkpoint), timeout=120)
    publish(messages(spark, 30, 60), path)
    run_query(file_sink(stream, target, checkpoint), timeout=120)
    found = told(spark.read.schema(records.SCHEMA).parquet(target))
    assert found == [row for row in expected(60) if int(row[2]) >= first]


def payloads(spark):
    good = {"callsign": "ABC1", "estDepartureAirport": "EGLL", "estArrivalAirport": "LFPG",
            "firstSeen": 1704067200, "lastSeen": 1704070860}
    rows = [(i, str(i), json.dumps({**good, "callsign": f"ABC{i}"}) if i % 3 else "broken")
            for i in range(40)]
    return spark.createDataFrame(rows, "id bigint, key string, value string").withColumn(
        "timestamp", F.timestamp_seconds(F.col("id")))


def test_both_outputs_survive_a_batch_that_broke_halfway(spark, monkeypatch):
    path, folder = fresh_folder(spark, "log"), fresh_folder(spark, "normalized")
    checkpoint = fresh_folder(spark, "checkpoint")
    publish(payloads(spark), path)
    stream = records.record_stream(spark, path, "earliest", most=5)
    whole = normalizer.normalize_flights
    calls = []

    def breaks_once(batch, with_delay):
        calls.append(batch)
        usable, rejected = whole(batch, with_delay)
        if len(calls) == 2:  # flights are written, rejects are not
            rejected = rejected.withColumn("problem", F.raise_error(F.lit("broken")))
        return usable, rejected

    monkeypatch.setattr(normalizer, "normalize_flights", breaks_once)
    with pytest.raises(PySparkException):
        normalizer.drain(normalizer.normalized_sink(stream, folder, checkpoint))
    normalizer.drain(normalizer.normalized_sink(stream, folder, checkpoint))
    monkeypatch.undo()
    usable, rejected = whole(records.read_records(spark, path))
    for name, batch in ((normalizer.FLIGHTS, usable), (normalizer.REJECTED, rejected)):
        found = normalizer.stored(spark, folder, name, batch.schema)
        assert sorted(map(repr, found.drop("batch").collect())) == sorted(
            map(repr, batch.collect()))
        assert found.select("batch").distinct().count() == 3


def test_progress_tells_of_every_row(spark):
    path, folder = fresh_folder(spark, "log"), fresh_folder(spark, "normalized")
    publish(payloads(spark), path)
    log = normalizer.ProgressLog()
    spark.streams.addListener(log)
    try:
        stream = records.record_stream(spark, path, "earliest", most=4)
        normalizer.drain(normalizer.normalized_sink(
            stream, folder, fresh_folder(spark, "checkpoint")), log)
    finally:
        spark.streams.removeListener(log)
    assert [b.rows_in for b in log.batches] == [12, 12, 12, 4]


def test_both_outputs_share_one_parse(spark, monkeypatch):
    path, folder = fresh_folder(spark, "log"), fresh_folder(spark, "normalized")
    publish(payloads(spark), path)
    whole, plans = normalizer.normalize_flights, []

    def watched(batch, with_delay):
        tables = whole(batch, with_delay)
        plans.extend(rows._jdf.queryExecution().withCachedData().toString() for rows in tables)
        return tables

    monkeypatch.setattr(normalizer, "normalize_flights", watched)
    normalizer.drain(normalizer.normalized_sink(
        records.record_stream(spark, path, "earliest"), folder, fresh_folder(spark, "checkpoint")))
    assert len(plans) == 2
    for plan in plans:
        above, cached = plan.split("InMemoryRelation", 1)
        assert "Generate" not in above
