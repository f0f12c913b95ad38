import pytest

from skyledger.operators import ml
from skyledger.session import fresh_folder
from skyledger.sources import kafka
from skyledger.sources.schemas import STREAM_SCHEMA
from skyledger.sources.star import train_flights
from skyledger.streaming import scorer


@pytest.fixture(scope="module")
def flights(spark, sf_dir):
    return train_flights(spark, sf_dir, STREAM_SCHEMA.fieldNames())


@pytest.fixture(scope="module")
def landed(spark, flights):
    path = fresh_folder(spark, "stream-in")
    kafka.to_kafka_json(flights).repartition(6).write.text(path)
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(spark, df, target, checkpoint):
    query = scorer.run_query(scorer.file_sink(df, target, checkpoint), timeout=120)
    assert query.exception() is None and not query.isActive
    return spark.read.schema(df.schema).parquet(target)


def test_stream_features_equal_batch_features(spark, flights, landed):
    stream = scorer.preprocess_stream(scorer.json_stream(spark, landed, files_per_batch=2))
    out = run(spark, stream, fresh_folder(spark, "out"), fresh_folder(spark, "checkpoint"))
    assert rows(out) == rows(ml.preprocess(flights))


def test_stream_scores_equal_batch_scores(spark, sf_dir, flights, landed):
    model = ml.train(
        train_flights(spark, sf_dir), "forest", {"numTrees": 3, "maxDepth": 3}).model
    stream = scorer.score_stream(scorer.json_stream(spark, landed), model)
    assert stream.isStreaming
    out = run(spark, stream, fresh_folder(spark, "out"), fresh_folder(spark, "checkpoint"))
    assert rows(out) == rows(ml.score(flights, model))


def test_restart_writes_new_rows_only(spark, flights):
    source, target = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    checkpoint = fresh_folder(spark, "checkpoint")
    values = kafka.to_kafka_json(flights)
    values.limit(50).write.text(source)
    stream = scorer.parse_flights(scorer.json_stream(spark, source))
    assert run(spark, stream, target, checkpoint).count() == 50
    assert run(spark, stream, target, checkpoint).count() == 50
    values.limit(7).write.mode("append").text(source)
    assert run(spark, stream, target, checkpoint).count() == 57


def test_binary_values_and_bad_records(spark):
    df = spark.createDataFrame(
        [('{"UniqueCarrier":"AA","Distance":12.5,"Month":3}',), ("broken",)], "value string"
    ).selectExpr("cast(value as binary) as value")
    found = scorer.parse_flights(df).collect()
    assert [(r.UniqueCarrier, r.Distance, r.Month) for r in found] == [
        ("AA", 12.5, 3), (None, None, None)]
    assert scorer.parse_flights(df).schema == STREAM_SCHEMA


def test_console_sink(spark, landed, capfd):
    stream = scorer.parse_flights(scorer.json_stream(spark, landed)).select("UniqueCarrier")
    writer = scorer.console_sink(stream, fresh_folder(spark, "checkpoint"), trigger=None)
    query = scorer.run_query(writer, timeout=60)
    assert query.exception() is None


def test_an_unfinished_run_is_an_error(spark):
    writer = scorer.file_sink(
        scorer.message_stream(spark), fresh_folder(spark, "unfinished"),
        fresh_folder(spark, "checkpoint"), trigger="1 second")
    with pytest.raises(TimeoutError, match="did not end"):
        scorer.run_query(writer, timeout=2)


def test_message_stream(spark):
    target = fresh_folder(spark, "messages")
    writer = scorer.file_sink(
        scorer.message_stream(spark, per_second=50), target,
        fresh_folder(spark, "checkpoint"), trigger="1 second")
    scorer.run_for(writer, 6)
    texts = [r.value for r in spark.read.schema("value string").parquet(target).collect()]
    assert set(texts) == {f"Message {i}" for i in range(len(texts))} and texts
