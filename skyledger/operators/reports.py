"""The eight flight reports.

Each takes cleaned flights and returns one row per group. Every aggregate is built from
mergeable parts, so a group that holds a third of all flights is reduced inside the
scanning tasks before anything is shuffled. The two reports that count distinct values
first reduce to one row per (carrier, origin, destination): that grain is bounded by the
network, not by the number of flights, and the distinct counts then run over it
instead of over a multiplied copy of the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.columns import (
    delay_severity, distance_band, route_key, sample_stddev, share,
)
from skyledger.operators.cleaning import fill_report_numbers, prune
from skyledger.operators.quantiles import with_running_total

AIRPORT_COLUMNS = [
    "ORIGIN", "DEP_DELAY", "TAXI_OUT", "TAXI_IN", "CANCELLED", "OP_CARRIER", "DEST",
]

# Names of raw columns, and in the reports below names of result columns, which
# stored reports and their readers share. A columnar source is scanned for these only.
REPORT_COLUMNS = {
    "carrier_performance": [
        "OP_CARRIER", "ORIGIN", "DEST", "ARR_DELAY", "DEP_DELAY", "AIR_TIME", "DISTANCE",
        "CARRIER_DELAY", "WEATHER_DELAY", "CANCELLED", "DIVERTED", "ACTUAL_ELAPSED_TIME",
        "CRS_ELAPSED_TIME"],
    "route_analysis": [
        "ORIGIN", "DEST", "DISTANCE", "AIR_TIME", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME",
        "ARR_DELAY", "CANCELLED"],
    "delay_type_analysis": [
        "OP_CARRIER", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY",
        "LATE_AIRCRAFT_DELAY"],
    "airport_performance": AIRPORT_COLUMNS,
    "time_based_analysis": ["FL_DATE", "DEP_TIME", "ARR_DELAY", "DEP_DELAY", "CANCELLED"],
    "distance_based_analysis": [
        "DISTANCE", "ARR_DELAY", "AIR_TIME", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME",
        "CARRIER_DELAY", "WEATHER_DELAY", "CANCELLED"],
    "delay_severity_analysis": ["OP_CARRIER", "CANCELLED", "DIVERTED", "ARR_DELAY"],
    "overall_performance_metrics": ["ARR_DELAY", "DEP_DELAY", "CANCELLED", "DIVERTED"],
}


def mean(column: str, places: int = 2) -> Column:
    return F.round(F.avg(column), places)


def indicator(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _summed(grain: DataFrame, *keys: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in grain.columns if c not in keys]


def carrier_grain(df: DataFrame) -> DataFrame:
    """Sums for each carrier and route."""
    flights = fill_report_numbers(df)
    late = F.col("ARR_DELAY")
    return flights.groupBy("OP_CARRIER", "ORIGIN", "DEST").agg(
        F.count("*").alias("n"),
        F.sum("ARR_DELAY").alias("arrival"),
        F.sum("DEP_DELAY").alias("departure"),
        F.sum("AIR_TIME").alias("air"), F.count("AIR_TIME").alias("n_air"),
        F.sum("DISTANCE").alias("miles"), F.count("DISTANCE").alias("n_miles"),
        F.sum("CARRIER_DELAY").alias("carrier"),
        F.sum("WEATHER_DELAY").alias("weather"),
        F.sum("CANCELLED").alias("cancelled"),
        F.sum("DIVERTED").alias("diverted"),
        F.sum(indicator(late <= 0)).alias("on_time"),
        F.sum(indicator(late > 15)).alias("significant"),
        F.sum(F.col("ACTUAL_ELAPSED_TIME") - F.col("CRS_ELAPSED_TIME")).alias("deviation"),
    )


def carrier_performance(df: DataFrame) -> DataFrame:
    return carrier_report(carrier_grain(df))


def carrier_report(grain: DataFrame) -> DataFrame:
    sums = grain.groupBy("OP_CARRIER").agg(
        *_summed(grain, "OP_CARRIER", "ORIGIN", "DEST"),
        F.countDistinct("ORIGIN").alias("unique_origins"),
        F.countDistinct("DEST").alias("unique_destinations"))
    n = F.col("n")
    return sums.select(
        "OP_CARRIER",
        n.alias("total_flights"),
        share(F.col("arrival"), n, 2).alias("avg_arrival_delay"),
        share(F.col("departure"), n, 2).alias("avg_departure_delay"),
        share(F.col("air"), F.col("n_air"), 2).alias("avg_air_time"),
        share(F.col("miles"), F.col("n_miles"), 2).alias("avg_distance"),
        share(F.col("carrier"), n, 2).alias("avg_carrier_delay"),
        share(F.col("weather"), n, 2).alias("avg_weather_delay"),
        share(F.col("cancelled"), n, 4).alias("cancellation_rate"),
        share(F.col("diverted"), n, 4).alias("diversion_rate"),
        "unique_origins",
        "unique_destinations",
        F.round(F.col("on_time") / n * 100, 2).alias("on_time_performance"),
        F.round(F.col("significant") / n * 100, 2).alias("significant_delay_percentage"),
        share(F.col("deviation"), n, 2).alias("avg_time_deviation"),
    )


def route_analysis(df: DataFrame) -> DataFrame:
    """Grouped by the two airports; the route key is a function of them."""
    return df.groupBy("ORIGIN", "DEST").agg(
        F.count("*").alias("flight_count"),
        mean("DISTANCE").alias("distance"),
        mean("AIR_TIME").alias("avg_air_time"),
        mean("CRS_ELAPSED_TIME").alias("scheduled_time"),
        mean("ACTUAL_ELAPSED_TIME").alias("actual_time"),
        mean("ARR_DELAY").alias("avg_arrival_delay"),
        F.round(F.stddev("ARR_DELAY"), 2).alias("delay_variability"),
        mean("CANCELLED", 4).alias("cancellation_rate"),
    ).select(route_key("ORIGIN", "DEST").alias("ROUTE"), "*")


def delay_type_analysis(df: DataFrame) -> DataFrame:
    return df.groupBy("OP_CARRIER").agg(
        mean("CARRIER_DELAY").alias("avg_carrier_delay"),
        mean("WEATHER_DELAY").alias("avg_weather_delay"),
        mean("NAS_DELAY").alias("avg_nas_delay"),
        mean("SECURITY_DELAY").alias("avg_security_delay"),
        mean("LATE_AIRCRAFT_DELAY").alias("avg_late_aircraft_delay"),
    )


def _airport_input(df: DataFrame) -> DataFrame:
    return prune(df, AIRPORT_COLUMNS).na.fill(0, ["DEP_DELAY", "TAXI_OUT", "TAXI_IN", "CANCELLED"])


def airport_grain(df: DataFrame) -> DataFrame:
    """Sums for each airport, carrier and destination; squares are about the mean of the row."""
    return _airport_input(df).filter(F.col("ORIGIN").isNotNull()).groupBy(
        "ORIGIN", "OP_CARRIER", "DEST").agg(
        F.count("*").alias("n"),
        F.sum("DEP_DELAY").alias("departure"),
        (F.var_pop("DEP_DELAY") * F.count("DEP_DELAY")).alias("squares"),
        F.sum("TAXI_OUT").alias("taxi_out"),
        F.sum("TAXI_IN").alias("taxi_in"),
        F.sum("CANCELLED").alias("cancelled"),
        F.max("DEP_DELAY").alias("worst"),
    )


def airport_performance(df: DataFrame) -> DataFrame:
    """All departure measures of an airport in one pass, busiest airport first.

    An unknown origin is left out, as an equi-join of separate measures would do.
    """
    return airport_report(airport_grain(df))


def airport_report(grain: DataFrame) -> DataFrame:
    # squared distances from a route's own mean, moved to the mean of the airport
    airport = Window.partitionBy("ORIGIN")
    mean_delay = F.sum("departure").over(airport) / F.sum("n").over(airport)
    apart = F.col("departure") / F.col("n") - mean_delay
    grain = grain.withColumn("squares", F.col("squares") + F.col("n") * apart * apart)
    sums = grain.groupBy("ORIGIN").agg(
        *_summed(grain, "ORIGIN", "OP_CARRIER", "DEST", "worst"),
        F.max("worst").alias("worst"),
        F.countDistinct("OP_CARRIER").alias("num_carriers"),
        F.countDistinct("DEST").alias("num_destinations"))
    n = F.col("n")
    return sums.select(
        "ORIGIN",
        n.alias("total_departures"),
        share(F.col("departure"), n, 2).alias("avg_departure_delay"),
        share(F.col("taxi_out"), n, 2).alias("avg_taxi_out_time"),
        share(F.col("taxi_in"), n, 2).alias("avg_taxi_in_time"),
        "num_carriers",
        "num_destinations",
        share(F.col("cancelled"), n, 4).alias("cancellation_rate"),
        F.round("worst", 2).alias("max_departure_delay"),
        sample_stddev(F.col("squares"), n, 2).alias("departure_delay_std"),
    ).orderBy(F.col("total_departures").desc(), "ORIGIN")


def airport_metrics_join(df: DataFrame) -> DataFrame:
    """The airport report as three separate aggregates joined on the origin.

    Same rows as `airport_performance` at several times the shuffles; it is here for callers
    who compute the three parts at different times.
    """
    rows = _airport_input(df)
    flights = rows.groupBy("ORIGIN")
    base = flights.agg(
        F.count("*").alias("total_departures"),
        mean("DEP_DELAY").alias("avg_departure_delay"),
        mean("TAXI_OUT").alias("avg_taxi_out_time"),
        mean("TAXI_IN").alias("avg_taxi_in_time"))
    # one row for each route and carrier, so that no flight is multiplied
    network = rows.groupBy("ORIGIN", "OP_CARRIER", "DEST").count().groupBy("ORIGIN").agg(
        F.countDistinct("OP_CARRIER").alias("num_carriers"),
        F.countDistinct("DEST").alias("num_destinations"))
    delays = flights.agg(
        mean("CANCELLED", 4).alias("cancellation_rate"),
        F.round(F.max("DEP_DELAY"), 2).alias("max_departure_delay"),
        F.round(F.stddev("DEP_DELAY"), 2).alias("departure_delay_std"))
    return base.join(network, "ORIGIN").join(delays, "ORIGIN")


def top_airports(df: DataFrame, k: int = 5) -> DataFrame:
    """The `k` busiest airports; equal counts are ordered by airport code."""
    return airport_performance(df).orderBy(F.col("total_departures").desc(), "ORIGIN").limit(k)


def time_based_analysis(df: DataFrame) -> DataFrame:
    """By month, day of week (1 is Sunday) and departure hour; nulls become 0 afterwards."""
    return df.groupBy(
        F.month("FL_DATE").alias("MONTH"),
        F.dayofweek("FL_DATE").alias("DAY_OF_WEEK"),
        "DEP_HOUR",
    ).agg(
        F.count("*").alias("flight_count"),
        mean("ARR_DELAY").alias("avg_arrival_delay"),
        mean("DEP_DELAY").alias("avg_departure_delay"),
        mean("CANCELLED", 4).alias("cancellation_rate"),
    ).na.fill(0)


def distance_based_analysis(df: DataFrame) -> DataFrame:
    return df.groupBy(distance_band("DISTANCE").alias("DISTANCE_CATEGORY")).agg(
        F.count("*").alias("flight_count"),
        mean("ARR_DELAY").alias("avg_arrival_delay"),
        mean("AIR_TIME").alias("avg_air_time"),
        mean("CRS_ELAPSED_TIME").alias("avg_scheduled_time"),
        mean("ACTUAL_ELAPSED_TIME").alias("avg_actual_time"),
        mean("CARRIER_DELAY").alias("avg_carrier_delay"),
        mean("WEATHER_DELAY").alias("avg_weather_delay"),
        mean("CANCELLED", 4).alias("cancellation_rate"),
    )


def delay_severity_analysis(df: DataFrame) -> DataFrame:
    label = delay_severity("CANCELLED", "DIVERTED", "ARR_DELAY")
    return df.select("OP_CARRIER", label.alias("DELAY_CATEGORY")).groupBy(
        "OP_CARRIER", "DELAY_CATEGORY").agg(F.count("*").alias("flight_count"))


def delay_histogram(df: DataFrame) -> DataFrame:
    """Sums for each arrival delay."""
    return fill_report_numbers(df).groupBy("ARR_DELAY").agg(
        F.count("*").alias("n"),
        F.sum("DEP_DELAY").alias("departure"),
        F.sum("CANCELLED").alias("cancelled"),
        F.sum("DIVERTED").alias("diverted"),
    )


def overall_performance_metrics(df: DataFrame) -> DataFrame:
    """One row over all flights.

    Flights are first reduced to one row per arrival delay. The 95th percentile is then
    the first delay whose running count reaches 95 % of the flights: exact, and free of the
    one task that would otherwise merge a quantile sketch from every scanned partition.
    """
    return overall_report(delay_histogram(df))


def overall_report(by_delay: DataFrame) -> DataFrame:
    late, rows = F.col("ARR_DELAY"), F.col("n")
    running = with_running_total(
        by_delay, "ARR_DELAY", "n", "upto", {"flights": rows, "minutes": late * rows})
    apart = late - F.col("minutes") / F.col("flights")
    sums = running.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum(late * rows).alias("arrival"),
        F.sum(apart * apart * rows).alias("squares"),
        F.sum("departure").alias("departure"),
        F.sum("cancelled").alias("cancelled"),
        F.sum("diverted").alias("diverted"),
        F.sum(F.when(late <= 0, rows).otherwise(0)).alias("on_time"),
        F.min(F.when(F.col("upto") >= 0.95 * F.col("flights"), late)).alias("high"))
    n = F.col("n")
    return sums.select(
        n.alias("total_flights"),
        share(F.col("arrival"), n, 2).alias("overall_avg_arrival_delay"),
        sample_stddev(F.col("squares"), n, 2).alias("arrival_delay_std"),
        share(F.col("departure"), n, 2).alias("overall_avg_departure_delay"),
        F.round("high", 2).alias("95th_percentile_delay"),
        share(F.col("cancelled"), n, 4).alias("overall_cancellation_rate"),
        share(F.col("diverted"), n, 4).alias("overall_diversion_rate"),
        F.round(F.when(n > 0, F.col("on_time") / n * 100), 2).alias("on_time_percentage"),
    )


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "carrier_performance": carrier_performance,
    "route_analysis": route_analysis,
    "delay_type_analysis": delay_type_analysis,
    "airport_performance": airport_performance,
    "time_based_analysis": time_based_analysis,
    "distance_based_analysis": distance_based_analysis,
    "delay_severity_analysis": delay_severity_analysis,
    "overall_performance_metrics": overall_performance_metrics,
}
