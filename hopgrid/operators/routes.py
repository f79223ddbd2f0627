"""Route lengths, tariffs, passenger requests and driver trajectories from course points.

Points come as ``(route, idx, lon, lat)``; ``idx`` gives the order within the
route, is unique there, and may have gaps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hopgrid.config import PRICED, SplitPolicy
from hopgrid.functions import geo, pricing
from hopgrid.operators.skew import balanced_join

STRETCH = 1 << 21


def _linked(points: DataFrame, stretch: int) -> DataFrame:
    """Every point once, with the point that follows it on its route (NULL at the end).

    Points are linked inside stretches of ``stretch`` index values first. Only the
    first and last point of each stretch go on to stretches of ``stretch ** 2``
    values, and their ends to the whole route. So however dense or sparse ``idx``
    is, a task sorts at most ``2 * stretch`` points of a route on the first two
    levels, and on the last two per wide stretch (2 ** 23 for the
    default and any 64-bit index).
    """
    open_ = points.select("route", F.col("idx").cast("bigint").alias("idx"), F.col("idx").alias("_idx"), "lon", "lat",
                          F.lit(False).alias("linked"))
    found = []
    for width in (stretch, stretch ** 2, None):
        part = [] if width is None else [F.col("idx") - F.pmod(F.col("idx"), F.lit(width).cast("bigint"))]
        along = Window.partitionBy("route", *part).orderBy("idx")
        here = open_.withColumns({"next": F.lead(F.struct("lon", "lat")).over(along),
                                  "opens": F.lag("idx").over(along).isNull()})
        ended = F.col("next").isNotNull() if width is not None else F.lit(True)
        found.append(here.where(~F.col("linked") & ended).select("route", F.col("_idx").alias("idx"), "lon", "lat", "next"))
        open_ = here.where(F.col("opens") | F.col("next").isNull()).select(
            "route", "idx", "_idx", "lon", "lat", (F.col("linked") | F.col("next").isNotNull()).alias("linked"))
    return reduce(DataFrame.unionByName, found)


def _linked_short(points: DataFrame) -> DataFrame:
    """The same by a single window, for routes known to fit one task (such as one file each)."""
    along = Window.partitionBy("route").orderBy("idx")
    return points.select("route", "idx", "lon", "lat", F.lead(F.struct("lon", "lat")).over(along).alias("next"))


def _links(points: DataFrame, stretch: int | None) -> DataFrame:
    return _linked_short(points) if stretch is None else _linked(points, stretch)


def _segment_km() -> Column:
    return geo.haversine_km(F.col("lon"), F.col("lat"), F.col("next.lon"), F.col("next.lat"))


def segments(points: DataFrame, stretch: int | None = STRETCH) -> DataFrame:
    """Consecutive points of each route with the distance between them.

    ``stretch=None`` takes the single-window form.
    """
    linked = _links(points, stretch).where(F.col("next").isNotNull())
    return linked.select("route", "idx", "lon", "lat", F.col("next.lon").alias("next_lon"),
                         F.col("next.lat").alias("next_lat"), _segment_km().alias("segment_km"))


def route_lengths(points: DataFrame, stretch: int | None = STRETCH) -> DataFrame:
    """Length of each route in km and its point count; a single point has length 0."""
    return _links(points, stretch).groupBy("route").agg(
        F.count(F.lit(1)).alias("points"), F.coalesce(F.sum(_segment_km()), F.lit(0.0)).alias("length_km"))


def driver_offers(drivers: DataFrame, lengths: DataFrame, policy: SplitPolicy = PRICED.split) -> DataFrame:
    """``full_tariff`` and ``ride_offer`` of drivers (``plate_id, seats, route``) from their route."""
    joined = balanced_join(drivers, lengths.select("route", "length_km"), ["route"], policy, sized_by=(drivers, None))
    priced = joined.withColumn("full_tariff", pricing.route_tariff(F.col("length_km")))
    return priced.withColumn("ride_offer", pricing.seat_offer(F.col("full_tariff"), F.col("seats"))).drop("length_km")


def pick_order(route: Column, idx: Column, seed: int) -> Column:
    """A shuffled order of the points of a route that is the same on every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), route.cast("string"), idx.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def route_requests(points: DataFrame, seed: int = 0) -> DataFrame:
    """Per route a random point as pickup and the last point as dropoff.

    All four are fixed-width hash aggregates that shrink inside each map task;
    nothing is sorted and no route is gathered.
    """
    ordered = points.select("route", "idx", "lon", "lat", pick_order(F.col("route"), F.col("idx"), seed).alias("pick"))
    found = ordered.groupBy("route").agg(
        F.min_by("lon", "pick").alias("lon"), F.min_by("lat", "pick").alias("lat"),
        F.max_by("lon", "idx").alias("last_lon"), F.max_by("lat", "idx").alias("last_lat"))
    return found.select("route", F.array("lon", "lat").alias("location"),
                        F.array("last_lon", "last_lat").alias("dropoff_location"))


def passenger_requests(passengers: DataFrame, points: DataFrame, seed: int = 0,
                       policy: SplitPolicy = PRICED.split) -> DataFrame:
    """Requests of passengers (``passenger_id, ride_offer, route``): pickup and dropoff on their route."""
    ends = route_requests(points, seed)
    empty = F.array().cast("array<double>")
    return balanced_join(passengers, ends, ["route"], policy, sized_by=(passengers, None)).withColumn(
        "pick_location", empty)


def trajectories(drivers: DataFrame, points: DataFrame, start: Column, interval_seconds: int = 5,
                 policy: SplitPolicy = PRICED.split) -> DataFrame:
    """One position message per driver and course point, ``interval_seconds`` apart."""
    moves = balanced_join(drivers, points.select("route", "idx", "lon", "lat"), ["route"], policy)
    at = F.timestamp_seconds(F.unix_seconds(start) + F.col("idx") * F.lit(interval_seconds))
    return moves.select(*[n for n in drivers.columns if n != "location"], "idx",
                        F.array("lon", "lat").alias("location"), at.alias("ts"))


def bounding_box(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Smallest box around the points, overall or per group."""
    return points.groupBy(*(by or [])).agg(
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"))


def corner_box(*corners: tuple[Column, Column]) -> dict[str, Column]:
    """The same over corner points held in one row."""
    xs, ys = [x for x, _ in corners], [y for _, y in corners]
    return {"min_0": F.least(*xs), "max_0": F.greatest(*xs), "min_1": F.least(*ys), "max_1": F.greatest(*ys)}
