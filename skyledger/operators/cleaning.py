"""Typing and null handling of the flight table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import dep_hour, double_or_zero, to_double

MEASURES = [
    "DEP_DELAY", "ARR_DELAY", "DISTANCE", "AIR_TIME", "TAXI_IN", "TAXI_OUT", "CANCELLED",
    "DIVERTED", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME",
]
CAUSES = [
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
]
# Columns whose missing values count as 0 in the carrier and the overall report.
REPORT_FILLED = [
    "ARR_DELAY", "DEP_DELAY", "CARRIER_DELAY", "WEATHER_DELAY", "CANCELLED", "DIVERTED",
    "ACTUAL_ELAPSED_TIME", "CRS_ELAPSED_TIME",
]


def typed_column(name: str) -> Column:
    if name == "FL_DATE":
        return F.try_to_timestamp(F.col(name)).alias(name)
    if name in MEASURES:
        return to_double(name).alias(name)
    if name in CAUSES:
        return double_or_zero(name).alias(name)
    return F.col(name)


def clean_flights(df: DataFrame) -> DataFrame:
    """Typed flights plus `DEP_HOUR`, in one projection over whatever columns `df` has.

    Bad numbers and dates become null; a missing delay cause becomes 0.0.
    """
    hour = [dep_hour("DEP_TIME").alias("DEP_HOUR")] if "DEP_TIME" in df.columns else []
    return df.select(*[typed_column(c) for c in df.columns if c != "DEP_HOUR"], *hour)


def fill_report_numbers(df: DataFrame) -> DataFrame:
    return df.na.fill(0, [c for c in REPORT_FILLED if c in df.columns])


def fill_all_numbers(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def fill_text(df: DataFrame, columns: list[str], text: str = "UNKNOWN") -> DataFrame:
    return df.na.fill(text, columns)


def prune(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def of_class(df: DataFrame, label: str, value: int) -> DataFrame:
    return df.filter(F.col(label) == value)
