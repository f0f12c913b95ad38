import json
import pathlib

import pytest

from skyledger.operators.landing import (
    HOUR, WEEK, flights_in_window, land_by_day, landed_in_window, normalize_flights,
    window_bounds,
)
from skyledger.session import fresh_folder

BASE = {
    "callsign": " ABC123 ", "estDepartureAirport": "EGLL", "estArrivalAirport": "EGKK",
    "firstSeen": 1704067200, "lastSeen": 1704070860, "scheduledDepartureTime": 1704066000,
    "estDepartureAirportHorizDistance": 12.5, "diverted": True,
}


def normalized(spark, records, **options):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    usable, rejected = normalize_flights(df, **options)
    return [r.asDict() for r in usable.collect()], [r.problem for r in rejected.collect()]


def without(key):
    return {k: v for k, v in BASE.items() if k != key}


def test_full_record(spark):
    found, rejected = normalized(spark, [BASE])
    assert rejected == []
    assert found == [{
        "UniqueCarrier": "ABC", "Origin": "EGLL", "Dest": "EGKK", "Month": 1, "DayofMonth": 1,
        "FlightNum": "123", "CRSDepTime": "0000", "DepDelay": 20.0, "Distance": 12.5,
        "CRSArrTime": "0101", "Diverted": 1, "Cancelled": 0, "RouteType": "Domestic"}]


@pytest.mark.parametrize("key", [
    "callsign", "estDepartureAirport", "estArrivalAirport", "firstSeen", "lastSeen"])
def test_null_key_rejects(spark, key):
    assert normalized(spark, [{**BASE, key: None}]) == ([], [f"unusable {key}"])


@pytest.mark.parametrize(("key", "column", "value"), [
    ("callsign", "UniqueCarrier", ""), ("estDepartureAirport", "Origin", ""),
    ("estArrivalAirport", "Dest", ""), ("lastSeen", "CRSArrTime", "0000"),
    ("estDepartureAirportHorizDistance", "Distance", 0.0),
    ("scheduledDepartureTime", "DepDelay", 0.0), ("diverted", "Diverted", 0)])
def test_absent_key_takes_its_default(spark, key, column, value):
    found, rejected = normalized(spark, [without(key)])
    assert rejected == []
    assert found[0][column] == value


def test_null_distance_stays_null(spark):
    found, _ = normalized(spark, [{**BASE, "estDepartureAirportHorizDistance": None}])
    assert found[0]["Distance"] is None


@pytest.mark.parametrize("value", [None, 0, "", False, [], {}])
def test_no_schedule_means_no_delay(spark, value):
    found, _ = normalized(spark, [{**BASE, "scheduledDepartureTime": value}])
    assert found[0]["DepDelay"] == 0.0


@pytest.mark.parametrize("value", [12, True, ["ABC"], {"a": 1}])
@pytest.mark.parametrize("key", ["callsign", "estDepartureAirport", "estArrivalAirport"])
def test_only_texts_are_texts(spark, key, value):
    assert normalized(spark, [{**BASE, key: value}]) == ([], [f"unusable {key}"])


@pytest.mark.parametrize("key", ["firstSeen", "lastSeen", "scheduledDepartureTime"])
@pytest.mark.parametrize("value", ["1704066000", "0", [1], {"a": 1}])
def test_only_numbers_and_flags_are_times(spark, key, value):
    assert normalized(spark, [{**BASE, key: value}]) == ([], [f"unusable {key}"])


def test_a_flag_is_a_time_of_one_second(spark):
    found, _ = normalized(spark, [{**BASE, "scheduledDepartureTime": True}])
    assert found[0]["DepDelay"] == (BASE["firstSeen"] - 1) / 60


@pytest.mark.parametrize(("value", "flag"), [
    (True, 1), (1, 1), (0.5, 1), ("yes", 1), ("false", 1), ("0", 1), ([0], 1), ({"a": 0}, 1),
    (False, 0), (None, 0), (0, 0), (0.0, 0), ("", 0), ([], 0), ({}, 0)])
def test_diverted_flag(spark, value, flag):
    assert normalized(spark, [{**BASE, "diverted": value}])[0][0]["Diverted"] == flag


def test_bad_records_do_not_stop_good_ones(spark):
    found, rejected = normalized(spark, [
        "not json", "[1, 2]", "null", "", {**BASE, "firstSeen": "soon"},
        {**BASE, "firstSeen": 1e300}, {**BASE, "scheduledDepartureTime": "soon"}, BASE, {}])
    assert len(found) == 2
    assert sorted(rejected) == sorted([
        *["not a JSON object"] * 4, "unusable firstSeen", "unusable firstSeen",
        "unusable scheduledDepartureTime"])


def test_stream_variant_has_no_delay_and_ignores_the_schedule(spark):
    found, rejected = normalized(
        spark, [{**BASE, "scheduledDepartureTime": "soon"}], with_delay=False)
    assert rejected == [] and "DepDelay" not in found[0] and len(found[0]) == 12


def test_window_bounds():
    now = 10_000_000
    assert window_bounds(now - 100, now + 50, now) == (now - 100, now)
    assert window_bounds(now, now - 50, now) == (now - 50 - HOUR, now - 50)
    assert window_bounds(now - 50, now - 50, now) == (now - 50 - HOUR, now - 50)
    assert window_bounds(0, now, now) == (now - WEEK, now)
    assert window_bounds(99.9, 200.9, now) == (99, 200)


def test_window_includes_both_ends(spark):
    df = spark.createDataFrame(
        [(json.dumps({"firstSeen": t}),) for t in (99, 100, 150, 200, 201)] + [("{}",), ("x",)],
        "value string")
    found = flights_in_window(df, 100, 200, 1000).collect()
    assert [json.loads(r.value)["firstSeen"] for r in found] == [100, 150, 200]


def test_only_days_of_the_window_are_read(spark):
    days = [1704067200 + i * 86400 for i in range(6)]
    df = spark.createDataFrame(
        [(json.dumps({"firstSeen": t + s}),) for t in days for s in (0, 3600, 86399)]
        + [("{}",), ("x",), (json.dumps({"firstSeen": "soon"}),)], "value string")
    path = fresh_folder(spark, "landed")
    land_by_day(df, path)
    begin, end = days[2] + 100, days[3] + 3600
    expected = sorted(r.value for r in flights_in_window(df, begin, end, end).collect())
    landed = spark.read.parquet(path)
    for file in landed.inputFiles():  # files of other days cannot be read any more
        name = file.removeprefix("file://")
        day = name.split("day=")[1].split("/")[0]
        if day not in (str(days[2] // 86400), str(days[3] // 86400)):
            with open(name, "wb") as out:
                out.write(b"broken")
            crc = pathlib.Path(name).with_name(f".{pathlib.Path(name).name}.crc")
            crc.unlink(missing_ok=True)
    schema = "value string, seen double, day int"
    found = landed_in_window(spark.read.schema(schema).parquet(path), begin, end, end)
    assert found.columns == ["value"]
    assert sorted(r.value for r in found.collect()) == expected and len(expected) == 4
