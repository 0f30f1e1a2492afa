"""Declared schemas: ride messages, lookups and the fact-table contract."""

from __future__ import annotations

from pyspark.sql import types as T

from fareway.streaming.sources import RIDE_EPOCH_SCHEMA, RIDE_TEXT_SCHEMA  # noqa: F401

_MONEY = T.DecimalType(18, 3)


def _f(name, dtype):
    return T.StructField(name, dtype, True)


# Column contract of the fact table: exact names and types.
FCT_TRIPS_CONTRACT = T.StructType([
    _f("trip_id", T.StringType()), _f("vendor_id", T.IntegerType()), _f("service_type", T.StringType()),
    _f("rate_code_id", T.IntegerType()), _f("pickup_location_id", T.IntegerType()),
    _f("pickup_borough", T.StringType()), _f("pickup_zone", T.StringType()),
    _f("dropoff_location_id", T.IntegerType()), _f("dropoff_borough", T.StringType()),
    _f("dropoff_zone", T.StringType()), _f("pickup_datetime", T.TimestampNTZType()),
    _f("dropoff_datetime", T.TimestampNTZType()), _f("store_and_fwd_flag", T.StringType()),
    _f("passenger_count", T.IntegerType()), _f("trip_distance", _MONEY), _f("trip_type", T.IntegerType()),
    _f("trip_duration_minutes", T.LongType()), _f("fare_amount", _MONEY), _f("extra", _MONEY),
    _f("mta_tax", _MONEY), _f("tip_amount", _MONEY), _f("tolls_amount", _MONEY), _f("ehail_fee", _MONEY),
    _f("improvement_surcharge", _MONEY), _f("total_amount", _MONEY), _f("payment_type", T.IntegerType()),
    _f("payment_type_description", T.StringType()),
])
