from pathlib import Path

import pytest

from skyledger import session
from skyledger.operators import reports
from skyledger.plans import timing
from skyledger.sources.star import raw_flights


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return raw_flights(spark, sf_dir)


def test_all_reports_are_written(spark, raw):
    folder = session.fresh_folder(spark, "reports")
    done = timing.run_reports(raw, lambda name: {"path": f"{folder}/{name}"})
    assert set(done) == set(reports.REPORTS)
    for name, rows in done.items():
        assert spark.read.parquet(f"{folder}/{name}").count() == rows > 0


def test_one_failed_report_does_not_stop_the_others(spark, raw, monkeypatch):
    def broken(df):
        raise ValueError("no such column")

    monkeypatch.setitem(reports.REPORTS, "route_analysis", broken)
    folder = session.fresh_folder(spark, "reports")
    done = timing.run_reports(raw, lambda name: {"path": f"{folder}/{name}"}, max_retries=1)
    assert isinstance(done["route_analysis"], ValueError)
    assert all(rows > 0 for name, rows in done.items() if name != "route_analysis")


def test_timing_restores_the_shuffle_width(spark, raw):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = [timing.Configuration("defaults"), timing.Configuration("one", 1, 1)]
    found = timing.time_reports(spark, lambda: raw, settings).collect()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert len(found) == 16 and all(r.seconds > 0 for r in found)
    rows = {c: {r.report: r.rows for r in found if r.config == c} for c in ("defaults", "one")}
    assert rows["defaults"] == rows["one"] and rows["one"]["overall_performance_metrics"] == 1


def test_shared_folder_follows_the_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_folder(spark) == named.rstrip("/")
    assert session.shared_folder(spark) == session.shared_folder(spark)
    assert spark.sparkContext.applicationId in session.application_folder(spark, "x")
    assert session.fresh_folder(spark, "x") != session.fresh_folder(spark, "x")


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_materialized_table_is_read_back_unchanged(spark):
    df = spark.range(10).selectExpr("id", "id % 2 as part", "string(id) as text")
    back = session.materialize(df, "numbers", ["part"])
    assert sorted(map(tuple, back.select(df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_discarding_leaves_other_folders_alone(spark, monkeypatch):
    kept = session.materialize(spark.range(3), "kept")
    here = session.application_folder(spark, "")
    monkeypatch.setattr(session, "application_folder", lambda s, name: f"{here}inner/{name}")
    gone = session.materialize(spark.range(3), "gone")
    assert gone.count() == 3
    session.discard_application_folder(spark)
    session.discard_application_folder(spark)
    assert kept.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        gone.collect()


def test_no_row_wise_python_and_no_local_checkpoint():
    """The library stays on built-in expressions and reliable storage."""
    folder = Path(session.__file__).parent
    text = "".join(p.read_text() for p in folder.rglob("*.py") if "llm" not in p.parts)
    for word in ("localCheckpoint", "crossJoin", "F.udf", "pandas_udf", ".toPandas(", "F.broadcast"):
        assert word not in text


def test_scratch_is_empty_after_success_and_failure(spark):
    paths = []

    def write():
        paths.append(session.fresh_folder(spark, "scratch"))
        spark.range(3).write.parquet(paths[-1])
        session.materialize(spark.range(3), "scratch-table")

    def exists(path):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    with session.scratch(spark):
        write()
        assert exists(paths[-1])
    with pytest.raises(KeyError), session.scratch(spark):
        write()
        raise KeyError
    assert not any(map(exists, paths))
    kept = session.fresh_folder(spark, "kept")
    spark.range(1).write.parquet(kept)
    assert exists(kept)


def test_reports_leave_no_copy_of_the_flights(spark, raw):
    target = session.fresh_folder(spark, "reports")
    root = Path(session.application_folder(spark, "").removeprefix("file:"))
    before = set(root.glob("*"))
    timing.run_reports(raw, lambda name: {"path": f"{target}/{name}"})
    assert set(root.glob("*")) - before == {Path(target.removeprefix("file:"))}
