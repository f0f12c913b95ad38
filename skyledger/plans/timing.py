"""The eight reports as one run, and the same run timed under several settings."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.cleaning import clean_flights
from skyledger.operators.reports import REPORT_COLUMNS, REPORTS
from skyledger.session import materialize, scratch
from skyledger.sources.sinks import write_report

log = logging.getLogger(__name__)

REPORT_INPUT = set().union(*REPORT_COLUMNS.values())


@dataclass(frozen=True)
class Configuration:
    """`shuffle` sets the shuffle width; the others force that many partitions.

    `partitions` of the input, `cleaned` of the cleaned flights, `result` of each report.
    """

    name: str
    shuffle: int | None = None
    partitions: int | None = None
    cleaned: int | None = None
    result: int | None = None


def _dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


# The settings to compare. The shape of the executors belongs to the deployment.
CONFIGURATIONS = [
    Configuration("defaults"),
    Configuration("one partition", shuffle=1, partitions=1),
    Configuration("100000 partitions", shuffle=100_000, partitions=100_000),
]


def landed_flights(raw: DataFrame) -> DataFrame:
    """Cleaned flights, written once as Parquet in the shared folder.

    Text is parsed once instead of once per report, and every report then reads no more
    than the columns it needs.
    """
    wanted = [c for c in raw.columns if c in REPORT_INPUT]
    return materialize(clean_flights(raw.select(*wanted)), "flights")


def run_reports(
    raw: DataFrame, options_for: Callable[[str], dict[str, str]], fmt: str = "parquet",
    max_retries: int = 3,
) -> dict[str, int | Exception]:
    """Write all eight reports; one that fails does not stop the others.

    `options_for` gives the target of a report, such as its path. The result holds the
    rows written or the error of each report.
    """
    done: dict[str, int | Exception] = {}
    with scratch(raw.sparkSession):
        flights = landed_flights(raw)
        for name, report in REPORTS.items():
            try:
                done[name] = write_report(
                    report(flights), name, fmt, options_for(name), max_retries)
            except Exception as error:
                log.exception("report %s failed", name)
                done[name] = error
    return done


def report_row_counts(raw: DataFrame) -> DataFrame:
    """Rows of each report."""
    flights = landed_flights(raw)
    out = None
    for name, report in REPORTS.items():
        counted = report(flights).agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("report"), "rows")
        out = counted if out is None else out.unionAll(counted)
    return out


def time_reports(
    spark: SparkSession, read: Callable[[], DataFrame],
    configurations: list[Configuration] = CONFIGURATIONS,
) -> DataFrame:
    """Seconds and rows of every report under every configuration.

    Each report is computed in full and its rows are counted and dropped. `read` is called
    for every run, so the scan is part of the time.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = []
    try:
        for setting in configurations:
            spark.conf.set("spark.sql.shuffle.partitions", str(setting.shuffle or before))
            for name, report in REPORTS.items():
                seen = Observation()
                start = time.monotonic()
                with scratch(spark):
                    flights = clean_flights(_dealt(read(), setting.partitions))
                    found = _dealt(report(_dealt(flights, setting.cleaned)), setting.result)
                    counted = found.observe(seen, F.count(F.lit(1)).alias("rows"))
                    counted.write.format("noop").mode("overwrite").save()
                rows.append((name, setting.name, time.monotonic() - start, seen.get["rows"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return spark.createDataFrame(rows, "report string, config string, seconds double, rows long")
