import logging

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from skyledger.session import fresh_folder
from skyledger.sources import files, kafka, sinks
from skyledger.sources.schemas import RAW_COLUMNS, TRAIN_SCHEMA


@pytest.fixture
def report(spark):
    return spark.createDataFrame([("AA", 1), ("UA", 2)], "OP_CARRIER string, flight_count int")


def released(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_report_is_overwritten(spark, report):
    path = fresh_folder(spark, "report")
    assert sinks.write_report(report, "r", options={"path": path}) == 2
    assert sinks.write_report(report.limit(1), "r", options={"path": path}) == 1
    assert spark.read.parquet(path).count() == 1


def test_empty_report_leaves_the_target_alone(spark, report, caplog):
    path = fresh_folder(spark, "report")
    sinks.write_report(report, "r", options={"path": path})
    with caplog.at_level(logging.WARNING):
        assert sinks.write_report(report.filter("1 = 0"), "r", options={"path": path}) == 0
    assert "nothing written" in caplog.text
    assert spark.read.parquet(path).count() == 2


def test_failed_attempt_is_repeated(spark, report, monkeypatch):
    path, real, calls = fresh_folder(spark, "report"), DataFrameWriter.save, []

    def flaky(self, *args, **options):
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("target is away")
        return real(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "save", flaky)
    assert sinks.write_report(report, "r", options={"path": path}) == 2
    assert len(calls) == 3 and spark.read.parquet(path).count() == 2


def test_last_failure_is_raised_and_the_cache_released(spark, report, monkeypatch):
    calls = []

    def broken(self, *args, **options):
        calls.append(1)
        raise ConnectionError("target is away")

    spark.catalog.clearCache()
    monkeypatch.setattr(DataFrameWriter, "save", broken)
    with pytest.raises(ConnectionError):
        sinks.write_report(report, "r", max_retries=2)
    assert len(calls) == 2 and released(spark)


def test_batch_size_and_target_reach_the_writer(report, monkeypatch):
    seen = {}
    monkeypatch.setattr(
        DataFrameWriter, "options",
        lambda self, **options: seen.update(options) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: None)
    sinks.write_report(report, "carrier_performance", "noop", {"database": "stats"}, max_batch=7)
    assert seen == {"collection": "carrier_performance", "maxBatchSize": "7", "database": "stats"}


def test_export_csv(spark, report):
    path = fresh_folder(spark, "export")
    assert sinks.export_csv(report, path)
    assert spark.read.option("header", True).csv(path).count() == 2
    assert not sinks.export_csv(report.limit(0), fresh_folder(spark, "export"))


def test_land_raw(spark, report):
    source, target = fresh_folder(spark, "source"), fresh_folder(spark, "target")
    assert not sinks.land_raw(spark, source, target)
    report.write.option("header", True).csv(source)
    assert sinks.land_raw(spark, source, target)
    assert sinks.land_raw(spark, source, target)
    assert spark.read.parquet(target).dtypes == [
        ("OP_CARRIER", "string"), ("flight_count", "string")]
    assert spark.read.parquet(target).count() == 2


def test_show_top(report, capsys):
    sinks.show_top(report, 1)
    assert "only showing top 1 row" in capsys.readouterr().out


def csv_file(tmp_path, text):
    path = tmp_path / "flights.csv"
    path.write_text(text)
    return str(path)


def test_raw_csv_is_all_text(spark, tmp_path):
    line = ",".join(["x"] * len(RAW_COLUMNS))
    path = csv_file(tmp_path, ",".join(RAW_COLUMNS) + "\n" + line + "\n" + line.replace("x", "") + "\n")
    df = files.read_flights_csv(spark, path, partitions=3)
    assert df.rdd.getNumPartitions() == 3
    assert {kind for _, kind in df.dtypes} == {"string"}
    assert [r.ORIGIN for r in df.orderBy("ORIGIN").collect()] == [None, "x"]


def test_inferred_csv(spark, tmp_path):
    df = files.read_flights_csv_inferred(spark, csv_file(tmp_path, "a,b,c\n1,1.5,x\n2,,y\n"))
    assert df.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]


def test_training_csv_is_permissive_and_by_position(spark, tmp_path):
    header = ",".join(TRAIN_SCHEMA.fieldNames())
    text = header + "\nBrand#31,EU07,AM02,one,19,5150,0621,-2.5,1044,0833,0,0,International\n"
    path = csv_file(tmp_path, text)
    rows = files.read_training_csv(spark, path, header=True).collect()
    assert [(r.UniqueCarrier, r.Month, r.DepDelay) for r in rows] == [("Brand#31", None, -2.5)]
    as_data = files.read_training_csv(spark, path).collect()
    assert [(r.UniqueCarrier, r.Month) for r in as_data] == [
        ("UniqueCarrier", None), ("Brand#31", None)]


def test_files_without_a_header_keep_their_first_rows(spark, tmp_path):
    line = "Brand#31,EU07,AM02,4,19,5150,0621,-2.5,1044,0833,0,0,International\n"
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text(line)
    assert files.read_training_csv(spark, str(tmp_path)).count() == 2
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_training_csv(spark, str(tmp_path), header=True).collect()


def test_raw_csv_is_read_by_name(spark, tmp_path):
    names = ["EXTRA", *reversed(RAW_COLUMNS), "Unnamed: 27"]
    values = ["e", *(name.lower() for name in reversed(RAW_COLUMNS)), ""]
    path = csv_file(tmp_path, ",".join(names) + "\n" + ",".join(values) + "\n")
    row = files.read_flights_csv(spark, path).first()
    assert row.asDict() == {name: name.lower() for name in RAW_COLUMNS}
    short = tmp_path / "short"
    short.mkdir()
    (short / "x.csv").write_text("ORIGIN,DEST\nEU07,AM02\n")
    with pytest.raises(ValueError, match="no column FL_DATE, OP_CARRIER"):
        files.read_flights_csv(spark, str(short))
    other = tmp_path / "other"
    other.mkdir()
    (other / "a.csv").write_text("ORIGIN,DEST\nEU07,AM02\n")
    (other / "b.csv").write_text("DEST,ORIGIN\nAM02,EU07\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_flights_csv(spark, str(other), ["ORIGIN", "DEST"]).collect()


def test_literal_rows_and_messages(spark):
    rows = [("Brand#44", "ME10", "ME04", 8, 30, "612", "1347", 9.0, 488.0, "1502", 0, 1, "Domestic")]
    df = files.literal_flights(spark, rows)
    assert df.schema == TRAIN_SCHEMA and [tuple(r) for r in df.collect()] == rows
    texts = [r.value for r in files.numbered_messages(spark).orderBy("value").collect()]
    assert sorted(texts) == sorted(f"Message {i}" for i in range(100))


def test_kafka_options():
    assert kafka.source_options("b1:9092,b2:9092", "flights", {"failOnDataLoss": "true"}) == {
        "startingOffsets": "latest", "kafka.security.protocol": "PLAINTEXT",
        "failOnDataLoss": "true", "kafka.bootstrap.servers": "b1:9092,b2:9092",
        "subscribe": "flights"}
    assert kafka.sink_options("b1:9092", "abcd", "all") == {
        "kafka.bootstrap.servers": "b1:9092", "topic": "abcd", "kafka.acks": "all"}


def test_json_keeps_null_fields(spark):
    df = spark.createDataFrame([("a", None)], "x string, y double")
    assert kafka.to_kafka_json(df).first().value == '{"x":"a","y":null}'


def test_a_failed_replacement_leaves_the_old_report(spark):
    folder = fresh_folder(spark, "report")
    with pytest.raises(FileNotFoundError):
        sinks.read_report(spark, folder)
    rows = spark.range(100).repartition(4)
    sinks.replace_report(rows.where("id < 10"), folder)
    bad = rows.withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(
        F.col("id")))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_report(bad, folder)
    assert sinks.read_report(spark, folder).count() == 10
    reader = sinks.read_report(spark, folder)
    sinks.replace_report(rows.where("id < 20"), folder)
    assert reader.count() == 10  # the version before stays for readers that have begun
    assert sinks.read_report(spark, folder).count() == 20
    for size in (30, 40):
        sinks.replace_report(rows.where(f"id < {size}"), folder)
    assert sinks.read_report(spark, folder).count() == 40
    assert sorted(sinks._versions(spark, folder).values()) == [True, True]
