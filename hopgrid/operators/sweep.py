"""Figures of the priced match by sweeping each bin in price order: no join, no pairs.

A driver takes passengers whose offer is at least a share of the driver's own.
With that share applied both sides have one comparable price, so the partners
of a message are those below or above it in the order of prices of its window
and bin: a running count over one sorted union of both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hopgrid.config import PRICED, MatchConfig
from hopgrid.functions import pricing
from hopgrid.operators.match import SLOT, with_bins, with_window
from hopgrid.session import work_dir

KEYS = [SLOT, "bin_0", "bin_1"]


def priced_counts(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED) -> DataFrame:
    """Messages of each side per window, bin and comparable price; those without one have no partner."""
    def side(messages: DataFrame, price, d: int, p: int) -> DataFrame:
        return with_bins(with_window(messages, cfg), cfg).select(*KEYS, price.alias("price"), F.lit(d).alias("d"), F.lit(p).alias("p"))

    both = side(drivers, F.col("ride_offer") * F.lit(cfg.min_offer_share), 1, 0).unionByName(
        side(passengers, F.col("ride_offer").cast("double"), 0, 1))
    return both.dropna(subset=[*KEYS, "price"]).groupBy(*KEYS, "price").agg(
        F.sum("d").alias("drivers"), F.sum("p").alias("passengers"))


def offer_levels(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED,
                 tasks: int | None = None) -> DataFrame:
    """Per window, bin and price: both counts, drivers at or below it and passengers at or above it.

    The levels are dealt out by ranges of (window, bin, price), so a bin with
    very many prices is swept by many tasks. A task's part of a bin starts from
    the sums of the parts before it, which come in as one more row of the
    sorted part. ``tasks`` fixes the number of ranges; by default Spark chooses.
    """
    spark = drivers.sparkSession
    order = [*KEYS, "price"]
    levels = priced_counts(drivers, passengers, cfg)
    dealt = levels.repartitionByRange(tasks, *order) if tasks else levels.repartitionByRange(*order)
    # Written once: the ranges must be the same for the sums and for the sweep.
    path = work_dir(spark, "offer-levels")
    dealt.withColumn("part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)

    bin_parts = Window.partitionBy(*KEYS).orderBy("part")
    earlier = bin_parts.rowsBetween(Window.unboundedPreceding, -1)
    onwards = bin_parts.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    carried = dealt.groupBy(*KEYS, "part").agg(F.sum("drivers").alias("d"), F.sum("passengers").alias("p")).select(
        *KEYS, "part", F.lit(0).alias("level"), F.lit(None).cast("double").alias("price"),
        F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("drivers"), F.lit(0).cast("bigint").alias("passengers"),
        F.sum("p").over(onwards).alias("above"))
    rows = carried.unionByName(dealt.withColumns({"level": F.lit(1), "above": F.lit(None).cast("bigint")}))
    sweep = Window.partitionBy(*KEYS, "part").orderBy("level", "price").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        *KEYS, "level", "price", "drivers", "passengers", F.sum("drivers").over(sweep).alias("drivers_up_to"),
        (F.first("above").over(sweep) - F.sum("passengers").over(sweep) + F.col("passengers")).alias("passengers_from"),
    ).where("level = 1").drop("level")


def money_sweep(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED, tasks: int | None = None) -> DataFrame:
    """Trip count, income and volume of the priced match: ``kpis.money_from_messages`` without its join."""
    weight, offer = F.col("passengers") * F.col("drivers_up_to"), F.col("price")
    return offer_levels(drivers, passengers, cfg, tasks).where(weight > 0).agg(
        F.sum(weight).alias("trips"),
        pricing.round_money(F.sum(pricing.company_margin(offer) * weight)).alias("total_income"),
        pricing.round_money(F.sum(pricing.customer_cost(offer) * weight)).alias("total_volume_traded"))


def driver_demand(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED, tasks: int | None = None) -> DataFrame:
    """How wanted the drivers of a window and bin are: their trips, and drivers without any."""
    trips = F.col("drivers") * F.col("passengers_from")
    return offer_levels(drivers, passengers, cfg, tasks).where("drivers > 0").groupBy(*KEYS).agg(
        F.sum("drivers").alias("drivers"), F.sum(trips).alias("trips"),
        F.sum(F.when(F.col("passengers_from") == 0, F.col("drivers")).otherwise(0)).alias("without_match"))
