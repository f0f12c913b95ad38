import json

import pytest

from skyledger import jobs
from skyledger.operators import ml
from skyledger.session import fresh_folder
from skyledger.sources import kafka
from skyledger.sources.schemas import STREAM_SCHEMA
from skyledger.sources.star import flight_payloads, raw_flights, train_flights


@pytest.fixture(scope="module")
def raw_csv(spark, sf_dir):
    path = fresh_folder(spark, "raw")
    raw_flights(spark, sf_dir).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def training_csv(spark, sf_dir):
    path = fresh_folder(spark, "training")
    train_flights(spark, sf_dir).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def run_folder(spark, training_csv):
    path, patch = fresh_folder(spark, "run"), pytest.MonkeyPatch()
    patch.setitem(ml.FOREST_PARAMS, "numTrees", 3)
    patch.setitem(ml.FOREST_PARAMS, "maxDepth", 3)
    jobs.main(["train", training_csv, path, "--header"], spark)
    patch.undo()
    return path


def test_land(spark, raw_csv):
    target = fresh_folder(spark, "lake")
    jobs.main(["land", raw_csv, target], spark)
    assert spark.read.parquet(target).count() == 6000
    with pytest.raises(SystemExit, match="no such file"):
        jobs.main(["land", target + "-missing", target], spark)


def test_reports(spark, raw_csv, capsys):
    folder = fresh_folder(spark, "reports")
    jobs.main(["reports", raw_csv, "--output", folder], spark)
    assert "carrier_performance: 25" in capsys.readouterr().out
    assert spark.read.parquet(f"{folder}/overall_performance_metrics").count() == 1


def test_failed_reports_are_named(spark, raw_csv):
    with pytest.raises(SystemExit, match="carrier_performance"):
        jobs.main(["reports", raw_csv, "--format", "nowhere"], spark)


def test_time(spark, raw_csv, capsys):
    jobs.main(["time", raw_csv, "--config", "defaults"], spark)
    assert capsys.readouterr().out.count("defaults") == 8


def test_rank(spark, raw_csv, capsys):
    jobs.main(["rank", raw_csv, "--top", "3"], spark)
    out = capsys.readouterr().out
    assert "vertices" in out and "pagerank" in out


def test_train_and_score(spark, run_folder, training_csv, capsys):
    record = spark.read.json(f"{run_folder}/metadata").first()
    assert 0 < record.metrics.accuracy < 1 and record.model_params.numTrees == 3
    target = fresh_folder(spark, "scores")
    jobs.main(["score", training_csv, run_folder, "--header", "--output", target], spark)
    assert spark.read.parquet(target).filter("DelayDescription IS NULL").count() == 0
    jobs.main(["score", training_csv, run_folder, "--header"], spark)
    assert "probability" in capsys.readouterr().out
    with pytest.raises(SystemExit, match="no trained run"):
        jobs.main(["score", training_csv, run_folder + "-missing"], spark)


def test_export_and_rejects(spark, sf_dir, capsys):
    source, target, bad = (fresh_folder(spark, n) for n in ("json", "csv", "rejects"))
    flight_payloads(spark, sf_dir).select("value").write.text(source)
    jobs.main(["export", source, target, "--rejects", bad], spark)
    assert "exported" in capsys.readouterr().out
    kept, rejected = spark.read.option("header", True).csv(target).count(), spark.read.json(bad)
    assert kept + rejected.count() == spark.read.text(source).count()
    assert all("callsign" in json.loads(r.value) or "est" in r.value for r in rejected.collect())


def test_stream(spark, sf_dir, run_folder):
    source, target, checkpoint = (fresh_folder(spark, n) for n in ("in", "out", "checkpoint"))
    flights = train_flights(spark, sf_dir, STREAM_SCHEMA.fieldNames())
    kafka.to_kafka_json(flights).write.text(source)
    jobs.main(
        ["stream", run_folder, checkpoint, "--folder", source, "--output", target, "--once"], spark)
    assert spark.read.parquet(target).count() == 6000


def test_options(monkeypatch):
    monkeypatch.setenv("STORE_URI", "store://user:word@host/db")
    assert jobs.parse_options(["uri=@STORE_URI", "a=b=c", "empty="]) == {
        "uri": "store://user:word@host/db", "a": "b=c", "empty": ""}
