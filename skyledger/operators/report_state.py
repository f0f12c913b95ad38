"""Reports kept up to date by landing batch.

A batch of cleaned flights is reduced to the state of a report: counts, sums, squared distances
from a mean and maxima for each group of a grain that is fine enough for the report's distinct
counts (routes) and its percentile (one row for each delay). States of batches are stored side
by side and merged into the state of all flights, from which the report is computed. So a new
batch costs a scan of that batch, and no flight is read again. A batch that is stored again
replaces its former state.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions.columns import (
    delay_severity, distance_band, route_key, sample_stddev, share,
)
from skyledger.operators import reports


@dataclass(frozen=True)
class State:
    """How a report's state is taken and merged, and how the report follows from it.

    Columns of a state are the keys, `largest` (maxima), `squares` (squared distances: column ->
    columns of its sum and count) and sums, which all others are.
    """

    keys: list[str]
    take: Callable[[DataFrame], DataFrame]
    report: Callable[[DataFrame], DataFrame]
    largest: list[str] = field(default_factory=list)
    squares: dict[str, tuple[str, str]] = field(default_factory=dict)

    def merge(self, states: DataFrame) -> DataFrame:
        """The state of all batches whose states are in `states`, one row for each key."""
        group = Window.partitionBy(*self.keys)
        for name, (total, count) in self.squares.items():
            mean = F.sum(total).over(group) / F.nullif(F.sum(count).over(group), F.lit(0))
            apart = F.col(total) / F.nullif(F.col(count), F.lit(0)) - mean
            moved = F.coalesce(F.col(count) * apart * apart, F.lit(0.0))
            states = states.withColumn(name, F.col(name) + moved)
        parts = [F.max(c).alias(c) if c in self.largest else F.sum(c).alias(c)
                 for c in states.columns if c not in self.keys]
        return states.groupBy(*self.keys).agg(*parts)


def _sums(*columns: str) -> list[Column]:
    """Sum and number of the known values of each column."""
    return [part for c in columns for part in (
        F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"count_{c}"))]


def _squares(column: str) -> Column:
    apart = F.var_pop(column) * F.count(column)
    return F.coalesce(apart, F.lit(0.0)).alias(f"squares_{column}")


def _mean(column: str, places: int = 2) -> Column:
    return share(F.col(f"sum_{column}"), F.nullif(F.col(f"count_{column}"), F.lit(0)), places)


def _routes(df: DataFrame) -> DataFrame:
    return df.groupBy("ORIGIN", "DEST").agg(
        F.count("*").alias("n"),
        *_sums("DISTANCE", "AIR_TIME", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME", "ARR_DELAY",
               "CANCELLED"),
        _squares("ARR_DELAY"))


def _route_report(state: DataFrame) -> DataFrame:
    spread = F.when(F.col("count_ARR_DELAY") > 0, sample_stddev(
        F.col("squares_ARR_DELAY"), F.col("count_ARR_DELAY"), 2))
    return state.select(
        route_key("ORIGIN", "DEST").alias("ROUTE"), "ORIGIN", "DEST",
        F.col("n").alias("flight_count"),
        _mean("DISTANCE").alias("distance"),
        _mean("AIR_TIME").alias("avg_air_time"),
        _mean("CRS_ELAPSED_TIME").alias("scheduled_time"),
        _mean("ACTUAL_ELAPSED_TIME").alias("actual_time"),
        _mean("ARR_DELAY").alias("avg_arrival_delay"),
        spread.alias("delay_variability"),
        _mean("CANCELLED", 4).alias("cancellation_rate"))


_CAUSES = {
    "CARRIER_DELAY": "avg_carrier_delay", "WEATHER_DELAY": "avg_weather_delay",
    "NAS_DELAY": "avg_nas_delay", "SECURITY_DELAY": "avg_security_delay",
    "LATE_AIRCRAFT_DELAY": "avg_late_aircraft_delay",
}


def _causes(df: DataFrame) -> DataFrame:
    return df.groupBy("OP_CARRIER").agg(*_sums(*_CAUSES))


def _cause_report(state: DataFrame) -> DataFrame:
    return state.select("OP_CARRIER", *(_mean(c).alias(name) for c, name in _CAUSES.items()))


def _times(df: DataFrame) -> DataFrame:
    return df.groupBy(
        F.month("FL_DATE").alias("MONTH"), F.dayofweek("FL_DATE").alias("DAY_OF_WEEK"), "DEP_HOUR",
    ).agg(F.count("*").alias("n"), *_sums("ARR_DELAY", "DEP_DELAY", "CANCELLED"))


def _time_report(state: DataFrame) -> DataFrame:
    return state.select(
        "MONTH", "DAY_OF_WEEK", "DEP_HOUR", F.col("n").alias("flight_count"),
        _mean("ARR_DELAY").alias("avg_arrival_delay"),
        _mean("DEP_DELAY").alias("avg_departure_delay"),
        _mean("CANCELLED", 4).alias("cancellation_rate")).na.fill(0)


def _distances(df: DataFrame) -> DataFrame:
    return df.groupBy(distance_band("DISTANCE").alias("DISTANCE_CATEGORY")).agg(
        F.count("*").alias("n"),
        *_sums("ARR_DELAY", "AIR_TIME", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME",
               "CARRIER_DELAY", "WEATHER_DELAY", "CANCELLED"))


def _distance_report(state: DataFrame) -> DataFrame:
    return state.select(
        "DISTANCE_CATEGORY", F.col("n").alias("flight_count"),
        _mean("ARR_DELAY").alias("avg_arrival_delay"),
        _mean("AIR_TIME").alias("avg_air_time"),
        _mean("CRS_ELAPSED_TIME").alias("avg_scheduled_time"),
        _mean("ACTUAL_ELAPSED_TIME").alias("avg_actual_time"),
        _mean("CARRIER_DELAY").alias("avg_carrier_delay"),
        _mean("WEATHER_DELAY").alias("avg_weather_delay"),
        _mean("CANCELLED", 4).alias("cancellation_rate"))


def _severities(df: DataFrame) -> DataFrame:
    label = delay_severity("CANCELLED", "DIVERTED", "ARR_DELAY").alias("DELAY_CATEGORY")
    return df.groupBy("OP_CARRIER", label).agg(F.count("*").alias("flight_count"))


STATES: dict[str, State] = {
    "carrier_performance": State(
        ["OP_CARRIER", "ORIGIN", "DEST"], reports.carrier_grain, reports.carrier_report),
    "route_analysis": State(
        ["ORIGIN", "DEST"], _routes, _route_report,
        squares={"squares_ARR_DELAY": ("sum_ARR_DELAY", "count_ARR_DELAY")}),
    "delay_type_analysis": State(["OP_CARRIER"], _causes, _cause_report),
    "airport_performance": State(
        ["ORIGIN", "OP_CARRIER", "DEST"], reports.airport_grain, reports.airport_report,
        largest=["worst"], squares={"squares": ("departure", "n")}),
    "time_based_analysis": State(["MONTH", "DAY_OF_WEEK", "DEP_HOUR"], _times, _time_report),
    "distance_based_analysis": State(["DISTANCE_CATEGORY"], _distances, _distance_report),
    "delay_severity_analysis": State(
        ["OP_CARRIER", "DELAY_CATEGORY"], _severities, lambda state: state),
    "overall_performance_metrics": State(
        ["ARR_DELAY"], reports.delay_histogram, reports.overall_report),
}


def store_batch(
    flights: DataFrame, folder: str, batch: str, names: list[str] | None = None,
) -> None:
    """Store the states of a batch of cleaned flights, in place of what it stored before.

    Batches must not share flights. Several reports read the flights once each.
    """
    for name in names or STATES:
        STATES[name].take(flights).write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch}")


def merged_state(spark: SparkSession, folder: str, name: str) -> DataFrame:
    states = spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/{name}")
    return STATES[name].merge(states)


def refreshed_report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A report over the flights of all stored batches."""
    return STATES[name].report(merged_state(spark, folder, name))


def compact(spark: SparkSession, folder: str, name: str, target: str, batch: str) -> None:
    """Store the merged state as one batch of another folder; the old one can go afterwards."""
    merged_state(spark, folder, name).write.mode("overwrite").parquet(
        f"{target}/{name}/batch={batch}")
