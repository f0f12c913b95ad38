"""Flight tables derived from a star schema of orders and line items.

One flight per line item. Only the dimensions a requested column needs are joined, so
a report on carriers never shuffles orders. No join is hinted: sizes decide.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.functions.columns import delay_class, route_type
from skyledger.sources.schemas import RAW_COLUMNS, TRAIN_SCHEMA

_CANCELLED = "(ok + ln) % 50 = 0"
_DIVERTED = "(ok * 3 + pk) % 97 = 0"


def _unless(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN NULL ELSE {value} END"


def _only(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


# column -> (dimension tables it reads, rule over ok, pk, sk, ln, ck and the dimensions)
_RULES: dict[str, tuple[set[str], str]] = {
    "FL_DATE": ({"orders"}, "CASE WHEN (ok + pk) % 503 = 0 THEN 'n/a' ELSE string(flown) END"),
    "OP_CARRIER": ({"part"}, "p_brand"),
    "OP_CARRIER_FL_NUM": (set(), "ok"),
    "ORIGIN": ({"supplier"}, _unless("(ok + pk) % 1009 = 0", "supplier_port")),
    "DEST": ({"orders", "customer"}, "customer_port"),
    "DEP_TIME": (set(), _unless(
        _CANCELLED, "((ok * 37 + ln * 101) % 25) * 100 + (ok * 13 + pk) % 60")),
    "DEP_DELAY": (set(), _unless(_CANCELLED, "(ok * 31 + pk * 17 + ln * 7) % 200 - 50")),
    "ARR_DELAY": (set(), _unless(
        f"{_CANCELLED} OR {_DIVERTED} OR (ok + sk) % 301 = 0",
        "(ok * 29 + pk * 11 + ln * 5) % 200 - 60")),
    "TAXI_OUT": (set(), _unless(_CANCELLED, "5 + (pk * 7 + ln) % 30")),
    "TAXI_IN": (set(), _unless(_CANCELLED, "2 + (sk * 5 + ln) % 15")),
    "DISTANCE": ({"orders"}, "CASE WHEN (ok * 7 + sk) % 211 = 0 THEN '' "
                             "ELSE string(100 + (sk * 53 + ck * 29) % 2500) END"),
    "AIR_TIME": ({"orders"}, _unless(_CANCELLED, "30 + (sk * 53 + ck * 29) % 400")),
    "CRS_ELAPSED_TIME": ({"orders"}, "50 + (sk * 53 + ck * 29) % 400"),
    "ACTUAL_ELAPSED_TIME": ({"orders"}, _unless(_CANCELLED, "45 + (sk * 53 + ck * 31) % 420")),
    "CARRIER_DELAY": (set(), _only("pk % 3 = 0", "pk % 41")),
    "WEATHER_DELAY": (set(), _only("pk % 5 = 0", "ok % 23")),
    "NAS_DELAY": (set(), _only("pk % 7 = 0", "ok % 31")),
    "SECURITY_DELAY": (set(), _only("pk % 11 = 0", "sk % 13")),
    "LATE_AIRCRAFT_DELAY": (set(), _only("pk % 2 = 0", "ok % 61")),
    "CANCELLED": (set(), f"CASE WHEN {_CANCELLED} THEN '1.0' ELSE '0.0' END"),
    "DIVERTED": (set(), f"CASE WHEN {_DIVERTED} THEN '1.0' ELSE '0.0' END"),
}


@lru_cache(maxsize=None)
def _schema(path: str) -> StructType:
    """Columns of a table; its footer is read once, not once for every query."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def _ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Port code of every nation, such as `EU07`."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nation.select("n_nationkey", F.concat(
        F.upper(F.substring("r_name", 1, 2)),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("port"))


def _star(spark: SparkSession, sf_dir: str, tables: set[str]) -> DataFrame:
    """Line items with the dimensions asked for.

    Shuffles carry the number of a nation; its port code is looked up at the end, from the
    two dimensions that never grow.
    """
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ok"), F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"), F.col("l_linenumber").alias("ln"))
    if "part" in tables:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        rows = rows.join(part, F.col("pk") == F.col("p_partkey"))
    if "supplier" in tables:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        rows = rows.join(supplier, F.col("sk") == F.col("s_suppkey"))
    if "orders" in tables:
        orders = table(spark, sf_dir, "orders").select(
            "o_orderkey", F.col("o_custkey").alias("ck"),
            F.col("o_orderdate").cast("date").alias("flown"))
        if "customer" in tables:
            customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(customer, F.col("ck") == F.col("c_custkey"))
        rows = rows.join(orders, F.col("ok") == F.col("o_orderkey"))
    sides = [side for side in ("supplier", "customer") if side in tables]
    if sides:
        ports = _ports(spark, sf_dir)
        for side in sides:
            nation = "s_nationkey" if side == "supplier" else "c_nationkey"
            rows = rows.join(ports.select(
                F.col("n_nationkey").alias(nation), F.col("port").alias(f"{side}_port")), nation)
    return rows


def raw_flights(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """The raw flight table, all text; `keep` passes the star keys ok, pk, sk, ln on."""
    wanted = list(columns) if columns is not None else RAW_COLUMNS
    tables: set[str] = set().union(*(_RULES[c][0] for c in wanted)) if wanted else set()
    return _star(spark, sf_dir, tables).select(
        *keep, *[F.expr(_RULES[c][1]).cast("string").alias(c) for c in wanted])


def _hhmm(minutes: Column) -> Column:
    return F.lpad((F.floor(minutes / 60) * 100 + minutes % 60).cast("string"), 4, "0")


def _minutes(hhmm: Column) -> Column:
    number = hhmm.cast("int")
    return F.floor(number / 100) * 60 + number % 100


# training column -> raw columns it is made of
_TRAIN_NEEDS = {
    "UniqueCarrier": ["OP_CARRIER"], "Origin": ["ORIGIN"], "Dest": ["DEST"],
    "Month": ["FL_DATE"], "DayofMonth": ["FL_DATE"], "FlightNum": ["OP_CARRIER_FL_NUM"],
    "CRSDepTime": ["DEP_TIME"], "DepDelay": ["DEP_DELAY"], "Distance": ["DISTANCE"],
    "CRSArrTime": ["DEP_TIME", "ACTUAL_ELAPSED_TIME"], "Diverted": ["DIVERTED"],
    "Cancelled": ["CANCELLED"], "RouteType": ["ORIGIN", "DEST"],
}


def train_flights(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """The training table in the shape of `TRAIN_SCHEMA`."""
    wanted = list(columns) if columns is not None else TRAIN_SCHEMA.fieldNames()
    needs = list(dict.fromkeys(raw for c in wanted for raw in _TRAIN_NEEDS[c]))
    keep = list(keep)
    day = F.col("FL_DATE").try_cast("date")
    arrival = _minutes(F.col("DEP_TIME")) + F.col("ACTUAL_ELAPSED_TIME").cast("int")
    rules = {
        "UniqueCarrier": F.col("OP_CARRIER"),
        "Origin": F.col("ORIGIN"),
        "Dest": F.col("DEST"),
        "Month": F.month(day),
        "DayofMonth": F.dayofmonth(day),
        "FlightNum": F.col("OP_CARRIER_FL_NUM"),
        "CRSDepTime": F.lpad("DEP_TIME", 4, "0"),
        "DepDelay": F.col("DEP_DELAY").try_cast("double"),
        "Distance": F.col("DISTANCE").try_cast("double"),
        "CRSArrTime": _hhmm(arrival % 1440),
        "Diverted": F.col("DIVERTED").try_cast("double").cast("int"),
        "Cancelled": F.col("CANCELLED").try_cast("double").cast("int"),
        "RouteType": route_type("ORIGIN", "DEST"),
    }
    return raw_flights(spark, sf_dir, needs, keep).select(
        *keep, *[rules[c].alias(c) for c in wanted])


def labelled_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True class and a prediction that is off by one class for one flight in five."""
    rows = raw_flights(spark, sf_dir, ["DEP_DELAY"], keep=["ok", "pk"])
    label = delay_class(F.col("DEP_DELAY").try_cast("double"))
    wrong = (F.col("ok") + F.col("pk")) % 5 == 0
    return rows.select(label.alias("label"), wrong.alias("wrong")).select(
        "label",
        F.when(F.col("wrong"), (F.col("label") + 1) % 4).otherwise(F.col("label"))
        .cast("double").alias("prediction"))


def flight_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per event, with keys that are absent, null or filled."""
    e = F.col("event_id")
    seen = F.lit(1704067200) + e * 97

    def text(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    def port(letters_when: Column) -> Column:
        return F.when(letters_when, "EG").otherwise("LF")

    def cell(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    null, absent = F.lit("null"), F.lit(None).cast("string")
    parts = [
        cell("firstSeen", F.when(e % 101 == 0, text(seen.cast("string"))).otherwise(
            seen.cast("string"))),
        cell("lastSeen", F.when(e % 103 == 0, "true").otherwise(
            (seen + 1800 + e % 7200).cast("string"))),
        cell("callsign", F.when(e % 41 == 0, null).when(e % 43 == 0, absent).when(
            e % 47 == 0, (e % 1000).cast("string")).otherwise(
            text(F.concat(F.lit(" AB"), (e % 9).cast("string"), (e % 1000).cast("string"),
                          F.lit(" "))))),
        cell("estDepartureAirport", F.when(e % 37 == 0, null).when(e % 53 == 0, absent).otherwise(
            text(F.concat(port(e % 2 == 0), (10 + F.col("user_id") % 80).cast("string"))))),
        cell("estArrivalAirport", F.when(e % 59 == 0, null).when(e % 61 == 0, absent).otherwise(
            text(F.concat(port(e % 3 == 0), (10 + e % 80).cast("string"))))),
        cell("estDepartureAirportHorizDistance",
             F.when(e % 29 == 0, null).when(e % 31 == 0, absent)
             .otherwise((e % 5000).cast("string"))),
        cell("scheduledDepartureTime",
             F.when(e % 3 == 0, absent).when(e % 17 == 0, "0").when(
                 e % 97 == 0, text(seen.cast("string")))
             .otherwise((seen - (e % 120 - 30) * 60).cast("string"))),
        cell("diverted", F.when(e % 19 == 0, "true").when(e % 23 == 0, absent)
             .when(e % 31 == 1, '"false"').when(e % 31 == 2, '""').when(e % 31 == 3, "[]")
             .when(e % 31 == 4, "2.5").otherwise("false")),
    ]
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value"))


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads in the columns a Kafka source delivers; its times are whole milliseconds."""
    e = F.col("event_id")
    return flight_payloads(spark, sf_dir).select(
        e.cast("string").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("flights").alias("topic"),
        (e % 2).cast("int").alias("partition"),
        F.floor(e / 2).alias("offset"),
        F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("timestamp"),
        F.lit(0).alias("timestampType"))
