"""Reports from merged states against reports over all flights."""

import math

import pytest
from pyspark.sql import functions as F

from skyledger.operators import report_state, reports
from skyledger.operators.cleaning import clean_flights
from skyledger.session import fresh_folder, materialize
from skyledger.sources import star


@pytest.fixture(scope="module")
def flights(spark, sf_dir):
    raw = star.raw_flights(spark, sf_dir)
    return materialize(clean_flights(raw), "state-flights")


def rows(df):
    def plain(value):
        return round(value, 6) if isinstance(value, float) and not math.isnan(value) else value

    return sorted(repr([(c, plain(r[c])) for c in sorted(df.columns)]) for r in df.collect())


def of_batch(flights, number):
    return flights.where(F.pmod(F.xxhash64("OP_CARRIER_FL_NUM"), F.lit(3)) == number)


@pytest.mark.parametrize("name", list(reports.REPORTS))
def test_merged_batches_equal_all_flights(spark, flights, name):
    folder = fresh_folder(spark, "states")
    for number in (0, 1, 1, 2):  # a batch that comes again replaces itself
        report_state.store_batch(of_batch(flights, number), folder, str(number), [name])
    expected = rows(reports.REPORTS[name](flights))
    assert rows(report_state.refreshed_report(spark, folder, name)) == expected
    compacted = fresh_folder(spark, "compacted")
    report_state.compact(spark, folder, name, compacted, "all")
    assert rows(report_state.refreshed_report(spark, compacted, name)) == expected


def test_an_empty_batch_changes_nothing(spark, flights):
    folder = fresh_folder(spark, "states")
    report_state.store_batch(flights, folder, "1")
    report_state.store_batch(flights.limit(0), folder, "2")
    for name, report in reports.REPORTS.items():
        assert rows(report_state.refreshed_report(spark, folder, name)) == rows(report(flights))


def test_squares_of_far_apart_batches(spark):
    """Delays far from zero lose no digits when the states are merged."""
    schema = ("ORIGIN string, DEST string, DISTANCE double, AIR_TIME double, CRS_ELAPSED_TIME double, "
              "ACTUAL_ELAPSED_TIME double, ARR_DELAY double, CANCELLED double")
    batches = [[("A", "B", 1.0, 1.0, 1.0, 1.0, 1e9 + i, 0.0) for i in part]
               for part in ((0, 1), (2, 3, 4), (7,))]
    folder = fresh_folder(spark, "states")
    for number, batch in enumerate(batches):
        report_state.store_batch(
            spark.createDataFrame(batch, schema), folder, str(number), ["route_analysis"])
    found = report_state.refreshed_report(spark, folder, "route_analysis").first()
    values = [0, 1, 2, 3, 4, 7]
    mean = sum(values) / 6
    assert found.delay_variability == round(
        math.sqrt(sum((v - mean) ** 2 for v in values) / 5), 2)
