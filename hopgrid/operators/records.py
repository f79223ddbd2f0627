"""Rows of the ``drivers`` and ``passengers`` tables, seats, payments and positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hopgrid.config import PAYMENT_PER_COORDINATE, PICKUP_RADIUS_KM
from hopgrid.functions import geo, pricing
from hopgrid.sources.routes import coordinate_numbers, is_coordinate_line


def driver_rows(drivers: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """Rows of the ``drivers`` table; nobody is aboard unless the message says so.

    With ``dedupe`` one row per car as in ``passenger_rows``.
    """
    aboard = F.coalesce("passengers", F.lit(0)) if "passengers" in drivers.columns else F.lit(0)
    if not dedupe or drivers.isStreaming:
        rows = _once(drivers, "plate_id") if dedupe else drivers
        return rows.select("plate_id", "seats", aboard.alias("passengers"))
    row = F.struct(F.col("seats"), aboard.alias("passengers"))
    first = F.min_by(row, F.struct("ts", row)).alias("row")
    return drivers.groupBy("plate_id").agg(first).select("plate_id", "row.seats", "row.passengers")


def passenger_rows(passengers: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """Rows of the ``passengers`` table.

    The struct stores the second element under ``longitude`` as the table always
    has; ``unswap_location`` reads it back. With ``dedupe`` only the earliest
    message of each passenger is kept, else one row per message; a stream keeps
    the first to arrive while the watermark has not passed it.
    """
    location = F.struct(F.get("location", F.lit(1)).alias("longitude"),
                        F.get("location", F.lit(0)).alias("latitude"))
    if not dedupe or passengers.isStreaming:
        rows = _once(passengers, "passenger_id") if dedupe else passengers
        return rows.select("passenger_id", location.alias("location"), "ride_offer")
    row = F.struct(location.alias("location"), F.col("ride_offer"))
    first = F.min_by(row, F.struct("ts", row)).alias("row")
    return passengers.groupBy("passenger_id").agg(first).select("passenger_id", "row.location", "row.ride_offer")


def _once(messages: DataFrame, key: str) -> DataFrame:
    return messages.dropDuplicatesWithinWatermark([key])


def to_json_messages(records: DataFrame, key: Column | None = None) -> DataFrame:
    """``value`` JSON text of each record (and ``key``), as a topic takes it."""
    value = F.to_json(F.struct(*records.columns)).alias("value")
    return records.select(value) if key is None else records.select(key.cast("string").alias("key"), value)


def keyed_points(points: DataFrame) -> DataFrame:
    """Point records for the map topic; they all carry the key ``0``."""
    return to_json_messages(points.select("lon", "lat"), F.lit("0"))


def republished(parsed: DataFrame) -> DataFrame:
    """Every message that was valid JSON, unchanged, for the map topic."""
    bad = F.coalesce(F.col("reject_reason"), F.lit("")).isin("invalid_utf8", "malformed_json")
    return parsed.where(~bad).select("value")


def board(pairs: DataFrame, radius_km: float = PICKUP_RADIUS_KM) -> DataFrame:
    """Take a seat in each ``{car, passenger, seats}`` record whose two positions are close.

    ``boarded`` tells which records that were.
    """
    close = geo.within_pickup_radius(
        F.get("car.location", F.lit(0)), F.get("car.location", F.lit(1)),
        F.get("passenger.location", F.lit(0)), F.get("passenger.location", F.lit(1)), radius_km)
    return pairs.withColumn("boarded", F.coalesce(close, F.lit(False))).withColumn(
        "seats", F.when(F.col("boarded"), F.coalesce("seats", F.lit(0)) + 1).otherwise(F.col("seats")))


def coordinate_payment(lines: DataFrame, by: str = "file", line: str = "line") -> DataFrame:
    """Payment per valid coordinate line of each file, and the lines that were not numbers.

    Counted instead of added up line by line, so it does not gather float error.
    A file without any line in question has payment 0.
    """
    first, second = coordinate_numbers(F.col(line))
    wanted = is_coordinate_line(F.col(line))
    valid = wanted & first.isNotNull() & second.isNotNull()
    counts = lines.groupBy(by).agg(F.count_if(valid).alias("valid_lines"),
                                   F.count_if(wanted & ~valid).alias("invalid_lines"))
    return counts.withColumn("payment", pricing.round_money(F.col("valid_lines") * F.lit(PAYMENT_PER_COORDINATE)))


def latest_positions(positions: DataFrame, key: str | None = "id", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Newest position per key, or of all (``key=None``); streams run it in update mode.

    With a single ``order`` column the state of a key is a few fixed-width values.
    """
    newest = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    keys = [key] if key else []
    return positions.groupBy(*keys).agg(
        F.max_by("lon", newest).alias("lon"), F.max_by("lat", newest).alias("lat"),
        F.max(order[0]).alias(order[0]))


def live_positions(positions: DataFrame, live: str, lateness: str = "0 seconds", key: str = "id") -> DataFrame:
    """Newest position per key and stretch of ``live``: as a stream, silent keys leave the state.

    The state of a key lies in the stretch of its last message and goes when the
    watermark passes the stretch; ``current_positions`` picks the newest stretch
    of each key from what the stream wrote.
    """
    timed = positions.withWatermark("ts", lateness) if positions.isStreaming else positions
    newest = timed.groupBy(F.window("ts", live), key).agg(
        F.max_by("lon", "ts").alias("lon"), F.max_by("lat", "ts").alias("lat"), F.max("ts").alias("ts"))
    return newest.select(F.col("window")["start"].alias("since"), key, "lon", "lat", "ts")


def current_positions(written: DataFrame, key: str = "id", after: Column | None = None) -> DataFrame:
    """The newest row per key of a table of ``live_positions``; with ``after`` only of keys heard since then."""
    rows = written if after is None else written.where(F.col("ts") >= after)
    return latest_positions(rows, key)
