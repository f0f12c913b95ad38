"""Column rules shared by the reports, the graph, the models and the stream.

All of them are built-in expressions, so they stay inside generated JVM code. Bad
text becomes null through the `try_` forms, with ANSI mode left on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band edges in miles and the names of the bands.
SHORT_HAUL_BELOW = 500
MEDIUM_HAUL_BELOW = 1500

# Text shown for a predicted delay class.
CLASS_TEXT = {
    0: "Đúng giờ hoặc sớm",
    1: "Delay nhẹ (15-45 phút)",
    2: "Delay trung bình (45-90 phút)",
    3: "Delay nặng (>90 phút)",
}

# Lower edges in minutes of delay classes 1, 2 and 3.
CLASS_EDGES = (15, 45, 90)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def double_or_zero(c: Column | str) -> Column:
    return F.coalesce(to_double(c), F.lit(0.0))


def dep_hour(c: Column | str) -> Column:
    """Hour of an unpadded HHMM text; any length other than 3 or 4 gives 0."""
    text = _col(c)
    return (
        F.when(F.length(text) == 4, F.substring(text, 1, 2).try_cast("int"))
        .when(F.length(text) == 3, F.concat(F.lit("0"), F.substring(text, 1, 1)).try_cast("int"))
        .otherwise(F.lit(0))
    )


def hhmm_hour(c: Column | str) -> Column:
    return F.floor(_col(c).try_cast("int") / 100).cast("int")


def hhmm_minute(c: Column | str) -> Column:
    return _col(c).try_cast("int") % 100


def distance_band(c: Column | str) -> Column:
    miles = _col(c)
    return (
        F.when(miles < SHORT_HAUL_BELOW, "Short Haul")
        .when(miles < MEDIUM_HAUL_BELOW, "Medium Haul")
        .otherwise("Long Haul")
    )


def delay_severity(cancelled: Column | str, diverted: Column | str, arrival: Column | str) -> Column:
    late = _col(arrival)
    return (
        F.when(_col(cancelled) == 1, "Cancelled")
        .when(_col(diverted) == 1, "Diverted")
        .when(late <= 0, "On Time")
        .when(late <= 15, "Slight Delay")
        .when(late <= 60, "Moderate Delay")
        .otherwise("Severe Delay")
    )


def delay_class(c: Column | str) -> Column:
    """0 for a missing delay or one below 15 minutes, then 1, 2, 3 by lower edge."""
    late = _col(c)
    first, second, third = CLASS_EDGES
    return (
        F.when(late >= third, 3).when(late >= second, 2).when(late >= first, 1).otherwise(0)
    )


def describe_prediction(c: Column | str) -> Column:
    """Text of a predicted class; null for a class outside the table."""
    out = None
    for value, text in CLASS_TEXT.items():
        hit = _col(c) == value
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out


def route_key(origin: Column | str, dest: Column | str) -> Column:
    return F.concat(_col(origin), F.lit("-"), _col(dest))


def route_type(origin: Column | str, dest: Column | str) -> Column:
    same = F.substring(_col(origin), 1, 2) == F.substring(_col(dest), 1, 2)
    return F.when(same, "Domestic").otherwise("International")


def share(total: Column, rows: Column, places: int) -> Column:
    """Rounded mean out of a sum and a count; null when nothing was counted."""
    return F.round(F.when(rows > 0, total / rows), places)


def sample_stddev(squares: Column, rows: Column, places: int) -> Column:
    """Rounded sample deviation out of squared distances from the mean; null below two values."""
    return F.round(F.when(rows > 1, F.sqrt(squares / (rows - 1))), places)
