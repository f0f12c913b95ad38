import pytest
from pyspark.sql import functions as F

from skyledger.functions import columns as rules
from skyledger.operators.cleaning import clean_flights


def values(spark, kind, inputs, column):
    rows = [(i, value) for i, value in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column("v")).collect()]


def test_dep_hour(spark):
    texts = ["", "45", "930", "0800", "2400", "1100.0", "9x30", "x30", None]
    assert values(spark, "string", texts, rules.dep_hour) == [0, 0, 9, 8, 24, 0, None, None, 0]


def test_hhmm_parts(spark):
    texts = ["0000", "0805", "930", "2359", "", "x", None]
    assert values(spark, "string", texts, rules.hhmm_hour) == [0, 8, 9, 23, None, None, None]
    assert values(spark, "string", texts, rules.hhmm_minute) == [0, 5, 30, 59, None, None, None]


def test_distance_band(spark):
    miles = [499.9, 500.0, 1499.9, 1500.0, None]
    assert values(spark, "double", miles, rules.distance_band) == [
        "Short Haul", "Medium Haul", "Medium Haul", "Long Haul", "Long Haul"]


def test_delay_class(spark):
    minutes = [-1.0, 0.0, 14.9, 15.0, 44.9, 45.0, 60.0, 89.9, 90.0, None]
    assert values(spark, "double", minutes, rules.delay_class) == [0, 0, 0, 1, 1, 2, 2, 2, 3, 0]


def test_delay_severity_by_minutes(spark):
    def on_its_way(c):
        return rules.delay_severity(F.lit(0.0), F.lit(0.0), c)

    minutes = [-1.0, 0.0, 0.1, 15.0, 15.1, 60.0, 60.1, None]
    assert values(spark, "double", minutes, on_its_way) == [
        "On Time", "On Time", "Slight Delay", "Slight Delay", "Moderate Delay", "Moderate Delay",
        "Severe Delay", "Severe Delay"]


@pytest.mark.parametrize(("cancelled", "diverted", "label"), [
    (1.0, 0.0, "Cancelled"), (1.0, 1.0, "Cancelled"), (0.0, 1.0, "Diverted"),
    (None, None, "On Time")])
def test_delay_severity_by_flag(spark, cancelled, diverted, label):
    df = spark.createDataFrame([(cancelled, diverted, -5.0)], "c double, d double, a double")
    assert df.select(rules.delay_severity("c", "d", "a")).first()[0] == label


def test_describe_prediction(spark):
    found = values(spark, "double", [0.0, 1.0, 2.0, 3.0, 4.0, None], rules.describe_prediction)
    assert found == [*rules.CLASS_TEXT.values(), None, None]


def test_route_rules(spark):
    df = spark.createDataFrame(
        [("EG01", "EG02"), ("EG01", "LF02"), (None, "LF02"), ("", "")], "o string, d string")
    assert [tuple(r) for r in df.select(
        rules.route_key("o", "d"), rules.route_type("o", "d")).collect()] == [
        ("EG01-EG02", "Domestic"), ("EG01-LF02", "International"), (None, "International"),
        ("-", "Domestic")]


def test_sample_stddev_needs_two_values(spark):
    df = spark.createDataFrame([(25.0, 1), (2.0, 2), (None, 0)], "q double, n int")
    found = df.select(rules.sample_stddev(F.col("q"), F.col("n"), 2)).collect()
    assert [r[0] for r in found] == [None, 1.41, None]


def test_clean_flights_keeps_bad_values_as_null(spark):
    df = spark.createDataFrame(
        [("2009-01-02", "12.5", "7", "0930"), ("n/a", "late", "", None), (None, None, None, "5")],
        "FL_DATE string, DEP_DELAY string, NAS_DELAY string, DEP_TIME string")
    rows = clean_flights(df).select(
        F.col("FL_DATE").cast("string"), "DEP_DELAY", "NAS_DELAY", "DEP_HOUR").collect()
    assert [tuple(r) for r in rows] == [
        ("2009-01-02 00:00:00", 12.5, 7.0, 9), (None, None, 0.0, 0), (None, None, 0.0, 0)]
