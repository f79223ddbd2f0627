"""Small message sets shared by the tests, and pairing by plain loops."""

from __future__ import annotations

import datetime as dt
import math
import random

from pyspark.sql import SparkSession

START = dt.datetime(2024, 1, 1)
DRIVER = "event_id bigint, plate_id string, ride_offer double, location array<double>, ts timestamp"
PASSENGER = ("event_id bigint, passenger_id string, ride_offer double, location array<double>, "
             "dropoff_location array<double>, ts timestamp")


def at(seconds: float) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def driver(n, seconds, lon, lat, offer=2.0, plate="1234ABC"):
    return (n, plate, offer, [lon, lat], at(seconds))


def passenger(n, seconds, lon, lat, offer=2.0, name="12345678A", drop=(-0.327, 39.478)):
    return (n, name, offer, [lon, lat], list(drop), at(seconds))


def frames(spark: SparkSession, drivers, passengers):
    return spark.createDataFrame(drivers, DRIVER), spark.createDataFrame(passengers, PASSENGER)


def crowd(seed: int, count: int, spread: int, seconds: int = 60):
    """Random messages, a third of them at one place and time."""
    rng = random.Random(seed)
    drivers, passengers = [], []
    for n in range(count):
        hot = rng.random() < 1 / 3
        lon = -0.37 if hot else -0.37 + rng.randrange(spread) * 0.0001
        lat = 39.47 if hot else 39.47 + rng.randrange(spread) * 0.0001
        second = 3 if hot else rng.randrange(seconds)
        offer = rng.randrange(100, 301) / 100
        if rng.random() < 0.5:
            drivers.append(driver(n, second, lon, lat, offer, f"{n % 50:04d}ABC"))
        else:
            passengers.append(passenger(n, second, lon, lat, offer, f"{n % 70:08d}P"))
    return drivers, passengers


def window(row, length):
    return math.floor((row[-1] - START).total_seconds() / length)


def pairs(drivers, passengers, length, together):
    return sorted((d[0], p[0]) for d in drivers for p in passengers
                  if window(d, length) == window(p, length) and together(d, p))


def same_bin(d, p, size=0.00025):
    return [int(x / size) for x in d[3]] == [int(x / size) for x in p[3]]
