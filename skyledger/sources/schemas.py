"""Schemas of the flight tables."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

RAW_COLUMNS = [
    "FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "DEP_TIME", "DEP_DELAY",
    "ARR_DELAY", "TAXI_OUT", "TAXI_IN", "DISTANCE", "AIR_TIME", "CRS_ELAPSED_TIME",
    "ACTUAL_ELAPSED_TIME", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY",
    "LATE_AIRCRAFT_DELAY", "CANCELLED", "DIVERTED",
]

RAW_SCHEMA = StructType([StructField(name, StringType()) for name in RAW_COLUMNS])

TRAIN_SCHEMA = StructType([
    StructField("UniqueCarrier", StringType()),
    StructField("Origin", StringType()),
    StructField("Dest", StringType()),
    StructField("Month", IntegerType()),
    StructField("DayofMonth", IntegerType()),
    StructField("FlightNum", StringType()),
    StructField("CRSDepTime", StringType()),
    StructField("DepDelay", DoubleType()),
    StructField("Distance", DoubleType()),
    StructField("CRSArrTime", StringType()),
    StructField("Diverted", IntegerType()),
    StructField("Cancelled", IntegerType()),
    StructField("RouteType", StringType()),
])

# The stream carries the training columns without the delay, which is what is predicted.
STREAM_SCHEMA = StructType([f for f in TRAIN_SCHEMA.fields if f.name != "DepDelay"])
