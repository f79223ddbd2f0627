"""Distinct counts kept as mergeable sketches, so that days need not be counted again.

A day's row has a theta sketch of the cars seen and one of the cars matched.
Unions answer for any span of days, intersections for cars that are in both.
A sketch holds at most 2 ** ``SIZE`` hashes: up to as many ids it is exact,
beyond that its standard error is about 1 / sqrt(2 ** SIZE).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hopgrid.functions import pricing

SIZE = 13
ERROR = 3 / 2 ** (SIZE / 2)   # three standard errors of a union; an intersection's is relative to the union


def daily_sketches(drivers: DataFrame, trips: DataFrame, ts: str = "ts") -> DataFrame:
    """day, enrolled and matched (sketches): ``plate_id`` of drivers, ``driver_id`` of trips that moved."""
    moved = F.when(F.col("travelled_distance") != 0.0, F.col("driver_id"))
    rows = drivers.select(F.to_date(ts).alias("day"), F.col("plate_id").alias("seen"), F.lit(None).cast("string").alias("moved")).unionByName(
        trips.select(F.to_date(ts).alias("day"), F.lit(None).cast("string").alias("seen"), moved.alias("moved")))
    return rows.groupBy("day").agg(
        F.theta_sketch_agg("seen", F.lit(SIZE)).alias("enrolled"), F.theta_sketch_agg("moved", F.lit(SIZE)).alias("matched"))


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of several days as one row, or one per value of ``by``."""
    return sketches.groupBy(*by).agg(
        F.theta_union_agg("enrolled", F.lit(SIZE)).alias("enrolled"), F.theta_union_agg("matched", F.lit(SIZE)).alias("matched"))


def _ratio(part: Column, whole: Column) -> Column:
    return pricing.round_money(part / F.nullif(whole.cast("double"), F.lit(0.0)))


def sketched_figures(sketches: DataFrame, *by: str) -> DataFrame:
    """enrolled, matched, both (matched cars that were seen) and match_ratio, estimated."""
    figures = merged(sketches, *by).select(
        *by, F.theta_sketch_estimate("enrolled").alias("enrolled"), F.theta_sketch_estimate("matched").alias("matched"),
        F.theta_sketch_estimate(F.theta_intersection("enrolled", "matched")).alias("both"))
    return figures.withColumn("match_ratio", _ratio(F.col("matched"), F.col("enrolled")))


def exact_figures(drivers: DataFrame, trips: DataFrame, ts: str = "ts", *, daily: bool = False) -> DataFrame:
    """The same, counted."""
    moved = trips.where(F.col("travelled_distance") != 0.0)
    by = ["day"] if daily else []
    ids = drivers.select(F.to_date(ts).alias("day"), F.col("plate_id").alias("id"), F.lit(1).alias("s"), F.lit(0).alias("m")).unionByName(
        moved.select(F.to_date(ts).alias("day"), F.col("driver_id").alias("id"), F.lit(0).alias("s"), F.lit(1).alias("m")))
    flags = ids.where(F.col("id").isNotNull()).groupBy(*by, "id").agg(F.max("s").alias("s"), F.max("m").alias("m"))
    figures = flags.groupBy(*by).agg(F.sum("s").alias("enrolled"), F.sum("m").alias("matched"), F.sum(F.col("s") * F.col("m")).alias("both"))
    return figures.withColumn("match_ratio", _ratio(F.col("matched"), F.col("enrolled")))
