import math
import statistics

import pytest

from skyledger.operators import reports
from skyledger.operators.cleaning import clean_flights
from skyledger.operators.quantiles import with_running_total
from skyledger.sources.schemas import RAW_SCHEMA
from skyledger.sources.star import raw_flights


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    df = raw_flights(spark, sf_dir).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_same_result_for_any_partitioning(raw, name):
    report = reports.REPORTS[name]
    assert rows(report(clean_flights(raw.repartition(1)))) == rows(
        report(clean_flights(raw.repartition(64))))


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_needs_no_more_than_its_columns(raw, name):
    report = reports.REPORTS[name]
    few = raw.select(*reports.REPORT_COLUMNS[name])
    assert rows(report(clean_flights(few))) == rows(report(clean_flights(raw)))


def test_deviation_of_large_close_delays(spark):
    delays = [1e8 + x for x in (0.1, 0.2, 0.4)]
    rows = [("A", "X", f"D{i}", d, d, 1.0, 1.0, 0.0, 0.0) for i, d in enumerate(delays)]
    df = spark.createDataFrame(rows, (
        "ORIGIN string, OP_CARRIER string, DEST string, ARR_DELAY double, DEP_DELAY double, "
        "TAXI_OUT double, TAXI_IN double, CANCELLED double, DIVERTED double"))
    assert reports.airport_performance(df).first().departure_delay_std == 0.15
    assert reports.overall_performance_metrics(df).first().arrival_delay_std == 0.15


def test_airport_report_equals_the_join_of_its_parts(raw):
    flights = clean_flights(raw)
    assert rows(reports.airport_performance(flights)) == rows(
        reports.airport_metrics_join(flights))


def test_airport_report_is_sorted(raw):
    found = reports.airport_performance(clean_flights(raw)).collect()
    assert [-r.total_departures for r in found] == sorted(-r.total_departures for r in found)
    top = reports.top_airports(clean_flights(raw)).collect()
    assert top == found[:5]


def test_empty_input(spark):
    empty = clean_flights(spark.createDataFrame([], RAW_SCHEMA))
    for name, report in reports.REPORTS.items():
        found = report(empty).collect()
        if name == "overall_performance_metrics":
            assert found[0].total_flights == 0
            assert all(v is None for v in found[0][1:])
        else:
            assert found == []


@pytest.mark.parametrize("size", [1, 2, 19, 20, 21, 100, 997])
def test_overall_against_plain_python(spark, size):
    delays = [float((i * 7919) % 311 - 60) for i in range(size)]
    df = spark.createDataFrame(
        [(None if d == 0 else d, d / 2, float(i % 2), 0.0) for i, d in enumerate(delays)],
        "ARR_DELAY double, DEP_DELAY double, CANCELLED double, DIVERTED double")
    row = reports.overall_performance_metrics(df).first()
    assert row.total_flights == size
    assert row["95th_percentile_delay"] == sorted(delays)[math.ceil(0.95 * size) - 1]
    assert row.overall_avg_arrival_delay == pytest.approx(statistics.mean(delays), abs=0.0051)
    if size == 1:
        assert row.arrival_delay_std is None
    else:
        assert row.arrival_delay_std == pytest.approx(statistics.stdev(delays), abs=0.0051)
    assert row.on_time_percentage == pytest.approx(
        100 * sum(d <= 0 for d in delays) / size, abs=0.0051)


def test_unknown_origin_is_a_group_of_a_route_but_no_airport(raw):
    flights = clean_flights(raw)
    assert reports.route_analysis(flights).filter("ORIGIN IS NULL").count() > 0
    assert reports.airport_performance(flights).filter("ORIGIN IS NULL").count() == 0


def test_bad_dates_come_out_as_month_zero(raw):
    found = reports.time_based_analysis(clean_flights(raw))
    zero = found.filter("MONTH = 0 AND DAY_OF_WEEK = 0").groupBy().sum("flight_count").first()[0]
    assert zero == raw.filter("FL_DATE = 'n/a'").count() > 0


@pytest.mark.parametrize("size", [0, 1, 3, 5000])
def test_running_total_over_many_ranges(spark, size):
    """Distinct fractional values and one very heavy row, spread over several ranges."""
    pairs = [((i * 7919 % 5003) / 7 - 50, 1 + i % 5 + (size if i == 11 else 0))
             for i in range(size)]
    df = spark.createDataFrame(pairs, "v double, n long")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        found = with_running_total(df, "v", "n", "upto").collect()
    finally:
        spark.conf.set(key, before)
    total, wanted = 0, {}
    for value, amount in sorted(pairs):
        total += amount
        wanted[value] = total
    assert {r.v: r.upto for r in found} == wanted
