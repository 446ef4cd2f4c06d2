"""Literal trip rows for unit tests."""

from __future__ import annotations

import datetime as dt

TRIP_SCHEMA = (
    "pickup_ts timestamp, dropoff_ts timestamp, trip_distance double, total_amount double, "
    "tip_amount double, passenger_count double, payment_type bigint, PULocationID int, "
    "DOLocationID int, color string"
)
NOON = dt.datetime(2020, 5, 4, 12, 0, 0)  # a Monday


def trip(
    pickup=NOON,
    seconds=600,
    miles=2.0,
    amount=12.0,
    tip=1.0,
    passengers=1.0,
    payment=1,
    pu=1,
    do=2,
    color="yellow",
):
    dropoff = None if pickup is None or seconds is None else pickup + dt.timedelta(seconds=seconds)
    return (pickup, dropoff, miles, amount, tip, passengers, payment, pu, do, color)


def trips(spark, rows):
    return spark.createDataFrame(rows, TRIP_SCHEMA)
