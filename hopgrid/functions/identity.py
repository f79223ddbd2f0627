"""Identifier checks and trip ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hopgrid.config import PASSENGER_ID_PATTERN, PLATE_PATTERN


def valid_plate(plate_id: Column) -> Column:
    return plate_id.rlike(PLATE_PATTERN)


def valid_passenger_id(passenger_id: Column) -> Column:
    return passenger_id.rlike(PASSENGER_ID_PATTERN)


def random_trip_id() -> Column:
    return F.uuid()


def stable_trip_id(*parts: Column) -> Column:
    """Uuid-shaped digest of the columns that identify a pair."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.regexp_replace(F.md5(text), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
