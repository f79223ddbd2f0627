"""Pairing drivers with passengers inside tumbling windows.

Every function takes a driver frame (``plate_id, location, ts[, ride_offer]``)
and a passenger frame (``passenger_id, location, dropoff_location, ts[, ride_offer]``),
batch or streaming, and returns one row per pair. Repeated messages give
repeated pairs. ``carry`` names extra columns to hand through; they come out as
``driver_<name>`` and ``passenger_<name>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hopgrid import config as c
from hopgrid.config import EXACT, PRICED, MatchConfig
from hopgrid.functions import geo, identity, pricing
from hopgrid.operators.packs import packed
from hopgrid.operators.skew import balanced_join, hot_keys

SLOT = "match_window"
TIME = "_message_time"
TRIP_COLUMNS = (
    "trip_id", "bin_key", "driver_id", "passenger_id", "pickup_location", "dropoff_location",
    "travelled_distance", "status", "cost", "company_margin", "accepted_offer",
)
UNPRICED_COLUMNS = TRIP_COLUMNS[:7]
EXACT_COLUMNS = (
    "trip_id", "driver_id", "passenger_id", "pickup_location", "dropoff_location", "status",
    "travelled_distance", "cost",
)
BARE_COLUMNS = EXACT_COLUMNS[:6]


def with_window(messages: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Tumbling window of each message.

    A stream keeps the window struct, whose end the watermark is compared with;
    a batch join gets by with its start.
    """
    window = F.window("ts", cfg.window_length)
    return messages.withColumn(SLOT, window if messages.isStreaming else window["start"])


def with_bins(messages: DataFrame, cfg: MatchConfig) -> DataFrame:
    """``bin_0`` / ``bin_1`` of the location, element by element."""
    return messages.withColumns({
        "bin_0": geo.location_bin(_at("location", 0), cfg.bin_size),
        "bin_1": geo.location_bin(_at("location", 1), cfg.bin_size),
    })


def _at(column: str, position: int) -> Column:
    return F.get(F.col(column), F.lit(position))


def _time(messages: DataFrame, cfg: MatchConfig) -> list[Column]:
    return [F.col("ts").alias(TIME)] if messages.isStreaming and cfg.packs else []


def _joined(left: DataFrame, right: DataFrame, keys: list[str], cfg: MatchConfig, condition: Column | None) -> DataFrame:
    def pack(side: DataFrame, on: list[str], name: str) -> DataFrame:
        """A pack lies in one window, that of its newest message; by that message's time it is also late or not."""
        starts = side.withColumn(SLOT, F.col(SLOT)["start"])
        timed = packed(starts, on, TIME, name).withWatermark(TIME, cfg.lateness)
        return timed.withColumn(SLOT, F.window(TIME, cfg.window_length)).drop(TIME)

    return balanced_join(left, right, keys, cfg.split, condition, stream_parts=cfg.stream_parts, crowded=cfg.crowded,
                         pack=pack if cfg.packs else None)


def _driver_side(drivers: DataFrame, keys: Sequence[str], carry: Sequence[str], cfg: MatchConfig) -> DataFrame:
    """Only what the pairs need; the rest would travel through the shuffle."""
    offer = F.col("ride_offer") if "ride_offer" in drivers.columns else F.lit(None).cast("double")
    return drivers.select(
        *keys, *_time(drivers, cfg), F.col("plate_id").alias("driver_id"), offer.alias("driver_offer"),
        _at("location", 0).alias("driver_0"), _at("location", 1).alias("driver_1"),
        *[F.col(name).alias(f"driver_{name}") for name in carry])


def _passenger_side(passengers: DataFrame, keys: Sequence[str], carry: Sequence[str], cfg: MatchConfig) -> DataFrame:
    return passengers.select(
        *keys, *_time(passengers, cfg), "passenger_id", F.col("ride_offer").alias("passenger_offer"),
        _at("location", 0).alias("passenger_0"), _at("location", 1).alias("passenger_1"),
        _at("dropoff_location", 0).alias("dropoff_0"), _at("dropoff_location", 1).alias("dropoff_1"),
        *[F.col(name).alias(f"passenger_{name}") for name in carry])


def pair_by_bin(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED, *,
                priced: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Pairs in the same window and bin, with ``priced`` only at compatible offers, and then with their prices."""
    keys = [SLOT, "bin_0", "bin_1"]
    left = _driver_side(with_bins(with_window(drivers, cfg), cfg), keys, carry, cfg)
    right = _passenger_side(with_bins(with_window(passengers, cfg), cfg), keys, carry, cfg)
    if priced:  # prices hang on the passenger alone: reckoned once per message, not once per pair
        right = right.withColumns(_prices(F.col("passenger_offer")))
    compatible = pricing.offers_compatible(F.col("driver_offer"), F.col("passenger_offer"), cfg.min_offer_share)
    return _joined(left, right, keys, cfg, compatible if priced else None)


def pair_by_location(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = EXACT, *,
                     carry: Sequence[str] = ()) -> DataFrame:
    """Pairs in the same window at the identical location."""
    keys = [SLOT, "at_0", "at_1"]
    place = {"at_0": _at("location", 0), "at_1": _at("location", 1)}
    left = _driver_side(with_window(drivers, cfg).withColumns(place), keys, carry, cfg)
    right = _passenger_side(with_window(passengers, cfg).withColumns(place), keys, carry, cfg)
    return _joined(left, right, keys, cfg, _near(cfg.tolerance))


def pair_within_tolerance(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = EXACT, *,
                          carry: Sequence[str] = ()) -> DataFrame:
    """Pairs in the same window whose coordinates each differ by at most the tolerance.

    A band join as an equi-join: the grid cell is twice the tolerance wide, so a
    passenger's reach touches two cells per axis; the passenger row is copied to
    those and drivers stay where they are.
    """
    reach = cfg.tolerance * (1 + 1e-6)  # room for rounding at a cell border
    width = 2 * reach
    keys = [SLOT, "cell_0", "cell_1"]

    def cell(x: Column) -> Column:
        return F.floor(x / F.lit(width)).try_cast("bigint")

    def reached(x: Column) -> Column:
        return F.explode(F.sequence(cell(x - F.lit(reach)), cell(x + F.lit(reach))))

    left = _driver_side(
        with_window(drivers, cfg).withColumns({"cell_0": cell(_at("location", 0)), "cell_1": cell(_at("location", 1))}),
        keys, carry, cfg)
    right = _passenger_side(
        with_window(passengers, cfg).withColumn("cell_0", reached(_at("location", 0)))
        .withColumn("cell_1", reached(_at("location", 1))),
        keys, carry, cfg)
    return _joined(left, right, keys, cfg, _near(cfg.tolerance))


def _prices(offer: Column) -> dict[str, Column]:
    return {"cost": pricing.customer_cost(offer), "company_margin": pricing.company_margin(offer)}


def _near(tolerance: float) -> Column:
    return geo.within_tolerance(F.col("driver_0"), F.col("driver_1"),
                                F.col("passenger_0"), F.col("passenger_1"), tolerance)


def _trip_id(pairs: DataFrame, cfg: MatchConfig) -> Column:
    if cfg.trip_ids == "random":
        return identity.random_trip_id()
    window = F.col(SLOT)["start"] if pairs.isStreaming else F.col(SLOT)
    names = [n for n in pairs.columns if n not in (SLOT, *_prices(F.lit(0.0)))]
    return identity.stable_trip_id(F.unix_micros(window), *[F.col(n) for n in names])


def _distance() -> Column:
    return geo.trip_distance_km(F.col("driver_0"), F.col("driver_1"), F.col("dropoff_0"), F.col("dropoff_1"))


def _places() -> dict[str, Column]:
    return {"pickup_location": geo.trip_wkt(F.col("driver_0"), F.col("driver_1")),
            "dropoff_location": geo.trip_wkt(F.col("dropoff_0"), F.col("dropoff_1"))}


def _carried(carry: Sequence[str]) -> list[str]:
    return [f"{role}_{name}" for name in carry for role in ("driver", "passenger")]


def match_priced(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED, *,
                 carry: Sequence[str] = (), geographic: bool = False) -> DataFrame:
    """Trips of drivers and passengers in the same window and bin at compatible offers.

    ``geographic`` adds the distance and the pickup text with longitude first.
    """
    pairs = pair_by_bin(drivers, passengers, cfg, carry=carry)
    trips = pairs.withColumns({
        "trip_id": _trip_id(pairs, cfg),
        "bin_key": geo.bin_key(F.col("bin_0"), F.col("bin_1")),
        **_places(),
        "travelled_distance": pricing.round_money(_distance()),
        "status": F.lit(c.STATUS_MATCHED),
        "accepted_offer": F.col("passenger_offer"),
    })
    extra = []
    if geographic:
        trips = trips.withColumns({
            "travelled_distance_geo": pricing.round_money(geo.haversine_km(
                F.col("driver_0"), F.col("driver_1"), F.col("dropoff_0"), F.col("dropoff_1"))),
            "pickup_wkt_lonlat": geo.wkt_point(F.col("driver_0"), F.col("driver_1")),
        })
        extra = ["travelled_distance_geo", "pickup_wkt_lonlat"]
    return trips.select(*TRIP_COLUMNS, *extra, *_carried(carry))


def match_unpriced(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED, *,
                   carry: Sequence[str] = ()) -> DataFrame:
    """Same window and bin, whatever the offers."""
    pairs = pair_by_bin(drivers, passengers, cfg, priced=False, carry=carry)
    trips = pairs.withColumns({
        "trip_id": _trip_id(pairs, cfg),
        "bin_key": geo.bin_key(F.col("bin_0"), F.col("bin_1")),
        **_places(),
        "travelled_distance": pricing.round_money(_distance()),
    })
    return trips.select(*UNPRICED_COLUMNS, *_carried(carry))


def _fared(pairs: DataFrame, cfg: MatchConfig, carry: Sequence[str]) -> DataFrame:
    trips = pairs.withColumns({
        "trip_id": _trip_id(pairs, cfg), **_places(),
        "status": F.lit(c.STATUS_DROPPED_OFF), "travelled_distance": _distance(),
    }).withColumn("cost", pricing.distance_fare(F.col("travelled_distance"), cfg.fare_per_km))
    return trips.select(*EXACT_COLUMNS, *_carried(carry))


def match_exact(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = EXACT, *,
                carry: Sequence[str] = ()) -> DataFrame:
    """Trips at the identical location, charged by distance."""
    return _fared(pair_by_location(drivers, passengers, cfg, carry=carry), cfg, carry)


def match_tolerance(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = EXACT, *,
                    carry: Sequence[str] = ()) -> DataFrame:
    """Trips within the coordinate tolerance, charged by distance."""
    return _fared(pair_within_tolerance(drivers, passengers, cfg, carry=carry), cfg, carry)


def match_bare(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = EXACT, *,
               carry: Sequence[str] = ()) -> DataFrame:
    """Pairs at the identical location without distance or price."""
    pairs = pair_by_location(drivers, passengers, cfg, carry=carry)
    trips = pairs.withColumns({
        "trip_id": _trip_id(pairs, cfg), **_places(), "status": F.lit(c.STATUS_MATCHED)})
    return trips.select(*BARE_COLUMNS, *_carried(carry))


def bin_counts(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED) -> DataFrame:
    """Messages of each kind per window and bin, and the pairs the bin can give.

    Counted per map task first, so no group is ever held in one place.
    """
    sides = _role_flags(drivers, passengers)
    keyed = with_bins(with_window(sides, cfg), cfg)
    return _counted(keyed, "bin_0", "bin_1")


def location_counts(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = EXACT) -> DataFrame:
    """The same per window and identical location."""
    keyed = with_window(_role_flags(drivers, passengers), cfg)
    return _counted(keyed.withColumns({"at_0": _at("location", 0), "at_1": _at("location", 1)}), "at_0", "at_1")


def _role_flags(drivers: DataFrame, passengers: DataFrame) -> DataFrame:
    return (drivers.select("ts", "location", F.lit(1).alias("d"), F.lit(0).alias("p"))
            .unionByName(passengers.select("ts", "location", F.lit(0).alias("d"), F.lit(1).alias("p"))))


def _counted(keyed: DataFrame, *keys: str) -> DataFrame:
    counts = keyed.groupBy(SLOT, *keys).agg(F.sum("d").alias("drivers"), F.sum("p").alias("passengers"))
    return counts.withColumn("pairs", F.col("drivers") * F.col("passengers"))


def crowded_bins(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED) -> DataFrame:
    """Bins that were crowded in some window of recorded messages, with the blocks they need.

    Write it to a table and hand that to a stream as ``MatchConfig.crowded``:
    the stream then cuts these bins and leaves the others whole.
    """
    sides = [with_bins(with_window(messages, cfg), cfg) for messages in (drivers, passengers)]
    hot = hot_keys(*sides, [SLOT, "bin_0", "bin_1"], cfg.split)
    return hot.groupBy("bin_0", "bin_1").agg(
        F.max("left_parts").alias("left_parts"), F.max("right_parts").alias("right_parts"))


def collapse_trips(trips: DataFrame) -> DataFrame:
    """One row per driver, passenger and bin of a trips table, with the number of repeats."""
    return trips.groupBy("driver_id", "passenger_id", "bin_key").agg(
        F.count(F.lit(1)).alias("matches"), F.min("cost").alias("min_cost"), F.max("cost").alias("max_cost"),
        F.min("travelled_distance").alias("min_distance"))


def collapsed_matches(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED) -> DataFrame:
    """The same counts and costs straight from messages, without forming the repeated pairs.

    Repeats of a driver (or passenger) with the same offer in a window and bin
    are counted before the join and the counts multiplied after it.
    """
    keys = [SLOT, "bin_0", "bin_1"]
    cars, riders = (with_bins(with_window(messages, cfg), cfg) for messages in (drivers, passengers))
    left = (cars.groupBy(*keys, F.col("plate_id").alias("driver_id"), F.col("ride_offer").alias("driver_offer"))
            .agg(F.count(F.lit(1)).alias("driver_rows")))
    right = (riders.groupBy(*keys, "passenger_id", F.col("ride_offer").alias("passenger_offer"))
             .agg(F.count(F.lit(1)).alias("passenger_rows")))
    compatible = pricing.offers_compatible(F.col("driver_offer"), F.col("passenger_offer"), cfg.min_offer_share)
    pairs = balanced_join(left, right, keys, cfg.split, compatible, sized_by=(cars, riders))
    cost = pricing.customer_cost(F.col("passenger_offer"))
    return (pairs.withColumn("cost", cost)
            .groupBy("driver_id", "passenger_id", geo.bin_key(F.col("bin_0"), F.col("bin_1")).alias("bin_key"))
            .agg(F.sum(F.col("driver_rows") * F.col("passenger_rows")).alias("matches"),
                 F.min("cost").alias("min_cost"), F.max("cost").alias("max_cost")))
