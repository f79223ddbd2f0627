"""Business figures over the ``drivers``, ``passengers`` and ``trips`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hopgrid.config import PRICED, MatchConfig, SplitPolicy
from hopgrid.functions import geo, pricing
from hopgrid.operators.match import SLOT, with_bins, with_window
from hopgrid.operators.skew import balanced_join


def enrolled_drivers(drivers: DataFrame, *, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return drivers.agg(count("plate_id").alias("enrolled"))


def traded_volume(trips: DataFrame) -> DataFrame:
    return trips.agg(pricing.round_money(F.sum("cost")).alias("total_volume_traded"))


def margins(trips: DataFrame) -> DataFrame:
    """Every margin that is known."""
    return trips.where(F.col("company_margin").isNotNull()).select("company_margin")


def margin_summary(trips: DataFrame) -> DataFrame:
    return margins(trips).agg(F.count("company_margin").alias("trips"),
                              F.avg("company_margin").alias("avg_margin"))


def total_income(trips: DataFrame) -> DataFrame:
    return margins(trips).agg(F.sum("company_margin").alias("total_income"))


def moved(trips: DataFrame) -> DataFrame:
    """Trips with a distance other than zero (an unknown distance does not count)."""
    return trips.where(F.col("travelled_distance") != 0.0)


def matched_drivers(trips: DataFrame) -> DataFrame:
    return moved(trips).agg(F.count_distinct("driver_id").alias("matched"))


def match_ratio(drivers: DataFrame, trips: DataFrame) -> DataFrame:
    """Share of enrolled drivers with a match; NULL when nobody is enrolled."""
    figures = _driver_figures(drivers, trips)
    ratio = pricing.round_money(F.col("matched") / F.nullif(F.col("enrolled").cast("double"), F.lit(0.0)))
    return figures.withColumn("match_ratio", ratio).withColumn("match_percent", F.col("match_ratio") * 100)


def matching_status(drivers: DataFrame, trips: DataFrame) -> DataFrame:
    """Drivers without and with a match, one row each."""
    return _driver_figures(drivers, trips).select(F.stack(
        F.lit(2), F.lit("drivers with no match"), F.col("enrolled") - F.col("matched"),
        F.lit("drivers with match"), F.col("matched")).alias("status", "drivers"))


def _driver_figures(drivers: DataFrame, trips: DataFrame) -> DataFrame:
    """Both distinct counts from one shuffle of ids that map tasks have already thinned out."""
    ids = drivers.select(F.lit("enrolled").alias("list"), F.col("plate_id").alias("id")).unionByName(
        moved(trips).select(F.lit("matched").alias("list"), F.col("driver_id").alias("id")))
    return ids.where(F.col("id").isNotNull()).distinct().agg(
        F.count_if(F.col("list") == "enrolled").alias("enrolled"),
        F.count_if(F.col("list") == "matched").alias("matched"))


def income_and_volume(trips: DataFrame) -> DataFrame:
    """Both money totals in one pass; sums skip NULL margins."""
    return trips.agg(F.sum("company_margin").alias("total_income"),
                     pricing.round_money(F.sum("cost")).alias("total_volume_traded"))


def money_from_messages(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED) -> DataFrame:
    """Trip count, income and volume of the priced match without forming its pairs.

    Cost and margin follow from the passenger's offer, so messages are counted
    per window, bin and offer first and only the counts are joined.
    """
    keys = [SLOT, "bin_0", "bin_1"]

    cars, riders = (with_bins(with_window(messages, cfg), cfg) for messages in (drivers, passengers))

    def counted(messages: DataFrame, name: str) -> DataFrame:
        return (messages.groupBy(*keys, F.col("ride_offer").alias(f"{name}_offer"))
                .agg(F.count(F.lit(1)).alias(f"{name}_rows")))

    pairs = balanced_join(
        counted(cars, "driver"), counted(riders, "passenger"), keys, cfg.split,
        pricing.offers_compatible(F.col("driver_offer"), F.col("passenger_offer"), cfg.min_offer_share),
        sized_by=(cars, riders))
    weight = F.col("driver_rows") * F.col("passenger_rows")
    offer = F.col("passenger_offer")
    return pairs.agg(
        F.sum(weight).alias("trips"),
        pricing.round_money(F.sum(pricing.company_margin(offer) * weight)).alias("total_income"),
        pricing.round_money(F.sum(pricing.customer_cost(offer) * weight)).alias("total_volume_traded"))


def matched_drivers_from_messages(drivers: DataFrame, passengers: DataFrame,
                                  cfg: MatchConfig = PRICED) -> DataFrame:
    """Drivers with a match of some distance, without forming the pairs.

    The best-paying passenger of a window and bin decides for nearly every
    driver there: whoever is too dear for that offer has no match, and the
    others have one unless that dropoff is where they stand. Only those last
    ones are compared with all dropoffs.
    """
    keys = [SLOT, "bin_0", "bin_1"]
    cars = with_bins(with_window(drivers, cfg), cfg).select(
        *keys, "plate_id", F.col("ride_offer").alias("driver_offer"),
        F.get("location", F.lit(0)).alias("driver_0"), F.get("location", F.lit(1)).alias("driver_1"))
    riders = with_bins(with_window(passengers, cfg), cfg).select(
        *keys, F.col("ride_offer").alias("passenger_offer"),
        F.get("dropoff_location", F.lit(0)).alias("dropoff_0"),
        F.get("dropoff_location", F.lit(1)).alias("dropoff_1"))
    compatible = pricing.offers_compatible(F.col("driver_offer"), F.col("passenger_offer"), cfg.min_offer_share)
    # From here on two decimals are not 0.00.
    far = geo.trip_distance_km(
        F.col("driver_0"), F.col("driver_1"), F.col("dropoff_0"), F.col("dropoff_1")) >= 0.005

    best = riders.groupBy(*keys).agg(
        F.max_by("dropoff_0", "passenger_offer").alias("dropoff_0"),
        F.max_by("dropoff_1", "passenger_offer").alias("dropoff_1"),
        F.max("passenger_offer").alias("passenger_offer"))
    judged = balanced_join(cars, best, keys, cfg.split, compatible, sized_by=(cars, None)).withColumn(
        "far", F.coalesce(far, F.lit(False)))
    near = judged.where(~F.col("far")).groupBy(*keys, "plate_id", "driver_0", "driver_1").agg(
        F.min("driver_offer").alias("driver_offer"))
    dropoffs = riders.groupBy(*keys, "dropoff_0", "dropoff_1").agg(F.max("passenger_offer").alias("passenger_offer"))
    rest = balanced_join(near, dropoffs, keys, cfg.split, compatible & far, semi=True, sized_by=(cars, riders))
    return judged.where("far").select("plate_id").unionByName(rest.select("plate_id")).agg(
        F.count_distinct("plate_id").alias("matched"))


def trip_points(trips: DataFrame) -> DataFrame:
    """Pickup, dropoff and the middle between them, read back from the WKT text."""
    pick_0, pick_1 = geo.wkt_pair(F.col("pickup_location"))
    drop_0, drop_1 = geo.wkt_pair(F.col("dropoff_location"))
    return trips.select(
        "trip_id", "driver_id", pick_0.alias("pickup_lat"), pick_1.alias("pickup_lon"),
        drop_0.alias("dropoff_lat"), drop_1.alias("dropoff_lon"),
    ).withColumns({
        "center_lat": (F.col("pickup_lat") + F.col("dropoff_lat")) / 2,
        "center_lon": (F.col("pickup_lon") + F.col("dropoff_lon")) / 2,
    })


def find_trip(trips: DataFrame, trip_id: str) -> DataFrame:
    """Route, price and distance of one trip; the id is a parameter, never SQL text."""
    return trips.sparkSession.sql(
        """SELECT driver_id, pickup_location, dropoff_location, cost, travelled_distance
           FROM {trips} WHERE trip_id = :trip_id
           ORDER BY driver_id, passenger_id, pickup_location, dropoff_location, cost LIMIT 1""",
        args={"trip_id": trip_id}, trips=trips)


def find_passenger(passengers: DataFrame, trips: DataFrame, trip_id: str) -> DataFrame:
    """Positions stored for the passenger of one trip, axes put right again."""
    rows = trips.sparkSession.sql(
        """SELECT location FROM {passengers} WHERE passenger_id = (
             SELECT passenger_id FROM {trips} WHERE trip_id = :trip_id
             ORDER BY passenger_id LIMIT 1)""",
        args={"trip_id": trip_id}, trips=trips, passengers=passengers)
    return unswap_location(rows)


def unswap_location(passengers: DataFrame) -> DataFrame:
    """The stored struct holds latitude under ``longitude`` and the reverse."""
    others = [name for name in passengers.columns if name != "location"]
    return passengers.select(*others, F.col("location.longitude").alias("latitude"),
                             F.col("location.latitude").alias("longitude"))


def passenger_of_trips(passengers: DataFrame, trips: DataFrame,
                       policy: SplitPolicy = PRICED.split) -> DataFrame:
    """``find_passenger`` for all trips at once, with one position per passenger: the smallest one stored.

    Two fixed-width hash aggregates find it; the smallest struct would need a sort.
    """
    first, second = F.col("location.longitude").alias("first"), F.col("location.latitude").alias("second")
    least = passengers.select("passenger_id", first, second).groupBy("passenger_id", "first").agg(
        F.min("second").alias("second"))
    stored = least.groupBy("passenger_id").agg(
        F.min("first").alias("longitude"), F.min_by("second", "first").alias("latitude"))
    joined = balanced_join(trips.select("trip_id", "passenger_id"), stored, ["passenger_id"], policy, sized_by=(trips, None))
    return unswap_location(joined.select("trip_id", "passenger_id", F.struct("longitude", "latitude").alias("location")))

