"""Landed flight payloads turned into flight rows.

A payload key that is absent takes a default, while one that is present but null, or of a
type that cannot be used, makes the record unusable. A record is parsed once, into a variant,
which tells absent, null and every other type of a field apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import route_type

HOUR = 3600
DAY = 24 * HOUR
WEEK = 7 * DAY

# Seconds of the first and last moment a calendar time can hold (years 1-9999).
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799

# Names of variant types.
TEXT, FLAG, NULL = "STRING", "BOOLEAN", "VOID"
NUMBER = "^(BIGINT|DECIMAL|DOUBLE)"

_REQUIRED_TEXT = ["callsign", "estDepartureAirport", "estArrivalAirport"]
_REQUIRED_TIME = ["firstSeen", "lastSeen"]
_PLANNED = "scheduledDepartureTime"
_DISTANCE = "estDepartureAirportHorizDistance"
_DIVERTED = "diverted"


def _part(key: str, name: str) -> Column:
    return F.col(f"field.{key}.{name}")


def _moment(seconds: Column) -> Column:
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)


def _time(key: str) -> Column:
    """A time in seconds: a number, or a flag as 0 or 1."""
    kind = _part(key, "kind")
    return F.when(kind.rlike(NUMBER), _part(key, "number")).when(
        kind == FLAG, _part(key, "flag").cast("double"))


def _seconds(key: str) -> Column:
    return _moment(F.col(f"told.{key}"))


def _truthy(key: str) -> Column:
    return F.col(f"told.{key}_true")


def _counts_as_true(key: str) -> Column:
    """Whether a value counts as true: any but null, zero, false and what is empty.

    A text counts by its length alone, so "false" and "0" are true.
    """
    kind, text = _part(key, "kind"), _part(key, "text")
    return F.coalesce(
        F.when(kind.rlike(NUMBER), _part(key, "number") != 0)
        .when(kind == FLAG, _part(key, "flag"))
        .when(kind == TEXT, text != "")
        .when(kind != NULL, ~text.isin("[]", "{}")), F.lit(False))


def _computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters use.

    A filter is pushed below a projection together with the expressions it uses, which
    would parse every record twice. It is not pushed below an explode.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def _fields(json_df: DataFrame, value: str) -> DataFrame:
    """Add `object`, whether a record is a JSON object, and `field`, its values by key.

    A value has a kind (null where the key is absent), and of text, number and flag what its kind
    calls for; a distance is a number of any kind that can be read so. Each is taken out of the record
    once, whatever the rules ask of it. Reading a value as what it is not is left out, since a
    text that is tried as a number costs more than all else here.
    """
    def found(key: str) -> Column:
        return F.col(f"found.{key}")

    keys = [*_REQUIRED_TEXT, *_REQUIRED_TIME, _PLANNED, _DISTANCE, _DIVERTED]
    payload = F.try_parse_json(F.col(value).cast("string"))
    parsed = _computed_once(json_df, "payload", payload)
    parsed = _computed_once(parsed, "found", F.struct(
        F.coalesce(F.schema_of_variant("payload").startswith("OBJECT"), F.lit(False))
        .alias("object"),
        *(F.try_variant_get("payload", f"$.{key}", "variant").alias(key) for key in keys)))
    parsed = _computed_once(parsed, "kinds", F.struct(
        *(F.schema_of_variant(found(key)).alias(key) for key in keys)))

    def field(key: str) -> Column:
        kind, number = F.col(f"kinds.{key}"), F.try_variant_get(found(key), "$", "double")
        numeric, flag = kind.rlike(NUMBER), kind == FLAG
        return F.struct(
            kind.alias("kind"),
            F.when(~numeric & ~flag & (kind != NULL), F.try_variant_get(found(key), "$", "string"))
            .alias("text"),
            (number if key == _DISTANCE else F.when(numeric, number)).alias("number"),
            F.when(flag, F.try_variant_get(found(key), "$", "boolean")).alias("flag"))

    fields = F.struct(*(field(key).alias(key) for key in keys))
    return _computed_once(parsed, "field", fields).select(
        *json_df.columns, F.col("found.object").alias("object"), "field")


def judged(json_df: DataFrame, with_delay: bool = True, value: str = "value") -> DataFrame:
    """The fields of a record and, in `problem`, why it cannot be used (null when it can).

    What the rules ask for more than once is worked out in steps, each small enough for the JVM to
    compile; generated code in one large piece would be interpreted. While this table is
    persisted, `normalize_flights` of the same records reads it and parses none again.
    """
    parsed = _computed_once(_fields(json_df, value), "told", F.struct(
        *(_time(key).alias(key) for key in [*_REQUIRED_TIME, _PLANNED]),
        *(_counts_as_true(key).alias(f"{key}_true") for key in (_PLANNED, _DIVERTED))))
    problem = F.when(~F.col("object"), "not a JSON object")
    for key in _REQUIRED_TEXT:
        problem = problem.when(_part(key, "kind") != TEXT, f"unusable {key}")
    for key in _REQUIRED_TIME:
        problem = problem.when(
            _part(key, "kind").isNotNull() & _seconds(key).isNull(), f"unusable {key}")
    if with_delay:
        problem = problem.when(
            _truthy(_PLANNED) & _seconds(_PLANNED).isNull(), f"unusable {_PLANNED}")
    return _computed_once(parsed, "problem", problem)


def normalize_flights(
    json_df: DataFrame, with_delay: bool = True, value: str = "value",
) -> tuple[DataFrame, DataFrame]:
    """Usable payloads as flight rows, and the unusable ones with the reason.

    Times are shown in the session zone. `with_delay` adds the departure delay in minutes,
    0 where no departure was scheduled.
    """
    parsed = judged(json_df, with_delay, value)
    # In a usable record a required field that is null was absent.
    call, origin, dest = (F.coalesce(_part(key, "text"), F.lit("")) for key in _REQUIRED_TEXT)
    seen, landed = (F.coalesce(_seconds(key), F.lit(0.0)) for key in _REQUIRED_TIME)
    call = F.regexp_replace(call, r"(?U)^\s+|\s+$", "")
    left, arrived = F.timestamp_seconds(seen), F.timestamp_seconds(landed)
    delay = F.when(_truthy(_PLANNED), (seen - _seconds(_PLANNED)) / 60).otherwise(0.0)
    miles = F.when(_part(_DISTANCE, "kind").isNull(), 0.0).otherwise(_part(_DISTANCE, "number"))
    columns = [
        F.substring(call, 1, 3).alias("UniqueCarrier"),
        origin.alias("Origin"),
        dest.alias("Dest"),
        F.month(left).alias("Month"),
        F.dayofmonth(left).alias("DayofMonth"),
        F.substring(call, 4, 2147483647).alias("FlightNum"),
        F.date_format(left, "HHmm").alias("CRSDepTime"),
        *([delay.alias("DepDelay")] if with_delay else []),
        miles.alias("Distance"),
        F.date_format(arrived, "HHmm").alias("CRSArrTime"),
        F.when(_truthy(_DIVERTED), 1).otherwise(0).alias("Diverted"),
        F.lit(0).alias("Cancelled"),
        route_type(origin, dest).alias("RouteType"),
    ]
    usable = parsed.filter(F.col("problem").isNull()).select(*columns)
    rejected = parsed.filter(F.col("problem").isNotNull()).select(*json_df.columns, "problem")
    return usable, rejected


def window_bounds(begin: float, end: float, now: float) -> tuple[int, int]:
    """Whole seconds of the time range that will be read.

    The end never lies in the future; an empty range becomes the hour before the end; a
    range longer than a week keeps its last week.
    """
    last = min(int(end), int(now))
    first = int(begin)
    if first >= last:
        first = last - HOUR
    return max(first, last - WEEK), last


def flights_in_window(
    json_df: DataFrame, begin: float, end: float, now: float, value: str = "value",
) -> DataFrame:
    """Payloads first seen inside the range, both ends included."""
    first, last = window_bounds(begin, end, now)
    return json_df.filter(_first_seen(value).between(first, last))


def _first_seen(value: str) -> Column:
    return F.get_json_object(F.col(value).cast("string"), "$.firstSeen").try_cast("double")


def land_by_day(json_df: DataFrame, path: str, value: str = "value") -> None:
    """Append payloads to a folder with a part for each day (UTC) in which they were first seen.

    `seen` keeps the second; a payload without a usable one is in the part of no day. A day
    with most of the payloads is written by several tasks.
    """
    seen = _moment(_first_seen(value))
    day = F.floor(seen / DAY).cast("int")
    (json_df.withColumn("seen", seen).withColumn("day", day).hint("rebalance", "day")
     .write.mode("append").partitionBy("day").parquet(path))


def landed_in_window(landed: DataFrame, begin: float, end: float, now: float) -> DataFrame:
    """`flights_in_window` over payloads landed by day: files of other days are not read."""
    first, last = window_bounds(begin, end, now)
    return landed.filter(
        F.col("day").between(first // DAY, last // DAY) & F.col("seen").between(first, last)
    ).drop("seen", "day")
