"""Business figures that follow the stream.

Every micro-batch is reduced to one row of sums per window, which is added to
the rows of the batch before; the outcome is written under the batch's number.
A batch that runs again starts from the same predecessor, so it counts once,
and a restarted query goes on where it stopped. The state is one row per
window: money sums, counts, and theta sketches for the distinct cars.
Exact distinct counts come from the ids that are new in each batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hopgrid.functions import pricing
from hopgrid.operators.sketches import SIZE
from hopgrid.session import remove_dir

WINDOW = "1 hour"
SUMS = ("trips", "volume", "income", "margins")
ID_LISTS = ("enrolled", "matched")


def one_stream(drivers: DataFrame, trips: DataFrame) -> DataFrame:
    """Driver messages and trips, each with ``ts``, as the rows that figures are made of."""
    none = F.lit(None)
    return drivers.select("ts", F.col("plate_id").alias("enrolled"), none.cast("string").alias("matched"), none.cast("double").alias("cost"),
                          none.cast("double").alias("margin"), F.lit(0).alias("trip")).unionByName(
        trips.select("ts", none.cast("string").alias("enrolled"),
                     F.when(F.col("travelled_distance") != 0.0, F.col("driver_id")).alias("matched"),
                     F.col("cost").alias("cost"), F.col("company_margin").alias("margin"), F.lit(1).alias("trip")))


class FigureKeeper:
    """What one micro-batch does; ``folder`` holds ``state`` and ``ids`` by batch number."""

    def __init__(self, folder: str, window: str = WINDOW):
        self.folder, self.window = folder.rstrip("/"), window

    def path(self, kind: str, number: int) -> str:
        return f"{self.folder}/{kind}/batch={number}"

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = batch.groupBy(F.window("ts", self.window)["start"].alias("window_start")).agg(
            F.sum("trip").cast("bigint").alias("trips"), F.sum("cost").alias("volume"), F.sum("margin").alias("income"),
            F.count("margin").alias("margins"), *[F.theta_sketch_agg(n, F.lit(SIZE)).alias(n) for n in ID_LISTS])
        if number:
            part = spark.read.parquet(self.path("state", number - 1)).unionByName(part).groupBy("window_start").agg(
                *[F.sum(n).alias(n) for n in SUMS], *[F.theta_union_agg(n, F.lit(SIZE)).alias(n) for n in ID_LISTS])
        part.write.mode("overwrite").parquet(self.path("state", number))

        ids = batch.select(F.explode(F.array(*[F.struct(F.lit(n).alias("list"), F.col(n).alias("id")) for n in ID_LISTS])).alias("r"))
        ids = ids.select("r.*").dropna().distinct()
        if number:
            known = spark.read.parquet(f"{self.folder}/ids").where(F.col("batch") < number)
            ids = ids.join(known.select("list", "id"), ["list", "id"], "left_anti")
        ids.write.mode("overwrite").parquet(self.path("ids", number))
        spark.createDataFrame([(number,)], "number long").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/newest")
        if number > 1:  # not even a replay of this batch reads it
            remove_dir(spark, self.path("state", number - 2))


def start_figures(drivers: DataFrame, trips: DataFrame, folder: str, checkpoint: str, window: str = WINDOW,
                  trigger: dict | None = None) -> StreamingQuery:
    return (one_stream(drivers, trips).writeStream.option("checkpointLocation", checkpoint).foreachBatch(FigureKeeper(folder, window))
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())


def window_figures(spark: SparkSession, folder: str) -> DataFrame:
    """The newest state: window_start, trips, volume, income, margins, sketches."""
    newest = spark.read.parquet(f"{folder}/newest").first().number
    return spark.read.parquet(f"{folder}/state/batch={newest}")


def current_figures(spark: SparkSession, folder: str) -> DataFrame:
    """All figures as of the newest batch, one row; distinct counts exact and from the sketches."""
    newest = spark.read.parquet(f"{folder}/newest").first().number
    ids = spark.read.parquet(f"{folder}/ids").where(F.col("batch") <= newest)
    # Both reduce to one row, put together by one more aggregation instead of a join.
    counts = ids.groupBy().agg(*[F.count_if(F.col("list") == n).alias(n) for n in ID_LISTS])
    sums = window_figures(spark, folder).agg(
        F.sum("trips").alias("trips"), F.sum("volume").alias("volume"), F.sum("income").alias("income"), F.sum("margins").alias("margins"),
        *[F.theta_sketch_estimate(F.theta_union_agg(n, F.lit(SIZE))).alias(f"{n}_estimate") for n in ID_LISTS])
    row = counts.unionByName(sums, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in dict.fromkeys([*counts.columns, *sums.columns])])
    return row.select(
        "enrolled", "matched", "enrolled_estimate", "matched_estimate", "trips",
        pricing.round_money(F.col("volume")).alias("total_volume_traded"), pricing.round_money(F.col("income")).alias("total_income"),
        (F.col("income") / F.col("margins")).alias("avg_margin"),
        pricing.round_money(F.col("matched") / F.nullif(F.col("enrolled").cast("double"), F.lit(0.0))).alias("match_ratio"))
