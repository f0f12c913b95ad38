"""Bounded sinks."""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from skyledger.session import delete

log = logging.getLogger(__name__)


def write_report(
    df: DataFrame, name: str, fmt: str = "parquet", options: dict[str, str] | None = None,
    max_retries: int = 3, max_batch: int = 1024,
) -> int:
    """Overwrite the target with a report and return its row count; skip an empty one.

    `options` address the target (a `path`, or the URI of a document store). The report is
    persisted so that the count and every attempt share one computation, and released
    however the write ends. Overwriting makes a repeated attempt safe.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = kept.count()
        if rows == 0:
            log.warning("no rows for %s, nothing written", name)
            return 0
        settings = {"collection": name, "maxBatchSize": str(max_batch), **(options or {})}
        for attempt in range(1, max_retries + 1):
            try:
                kept.write.format(fmt).mode("overwrite").options(**settings).save()
                return rows
            except Exception:
                if attempt == max_retries:
                    raise
                log.warning("attempt %d to write %s failed", attempt, name, exc_info=True)
        return rows
    finally:
        kept.unpersist()


def _versions(spark: SparkSession, folder: str) -> dict[str, bool]:
    """The versions in a report's folder, oldest first, and whether each was written whole."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return {}
    names = sorted(status.getPath().getName() for status in files.listStatus(root))
    return {name: files.exists(hadoop.Path(f"{folder}/{name}/_SUCCESS"))
            for name in names if name.startswith("version-")}


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The folder of the newest version that was written whole."""
    whole = [name for name, done in _versions(spark, folder).items() if done]
    return f"{folder}/{whole[-1]}" if whole else None


def replace_report(df: DataFrame, folder: str, keep: int = 2) -> str:
    """Write a report as a new version beside the old ones, and return its folder.

    A version counts once its job has committed, which Spark marks by one file at the very end. A
    write that fails midway leaves the version before it current, and readers that have begun
    keep their files. Afterwards the newest `keep` whole versions stay. One writer at a time.
    """
    spark = df.sparkSession
    known = _versions(spark, folder)
    number = 1 + max((int(name.removeprefix("version-")) for name in known), default=0)
    path = f"{folder}/version-{number:09d}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    whole = [name for name, done in known.items() if done]
    for name in known:
        if name not in whole[len(whole) + 1 - keep:]:
            delete(spark, f"{folder}/{name}")
    return path


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """The current version of a report."""
    path = current_version(spark, folder)
    if path is None:
        raise FileNotFoundError(f"no whole version of a report in {folder}")
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str) -> bool:
    """Headed CSV export; an empty table writes nothing and gives False."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def land_raw(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a headed CSV file into the lake as Parquet, replacing what was there.

    Columns keep the names of the header and stay text. A missing source gives False.
    """
    try:
        df = spark.read.option("header", True).csv(source)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    df.write.mode("overwrite").parquet(target)
    return True


def show_top(df: DataFrame, rows: int = 20, full_text: bool = True) -> None:
    """Print the first rows; only those reach the driver."""
    df.show(rows, truncate=not full_text)
