"""Matching a stream that finds its crowded bins by itself.

A stream-stream join must place a key's rows alike for as long as it waits for
partners, so it cannot react to a burst. Here every micro-batch is joined as a
batch: its new messages with all messages of open windows. The two joins of a
micro-batch stand alone, so each may cut whatever keys are crowded by then.

How crowded a key is comes from count-min sketches: ``DEPTH`` rows of ``WIDTH``
counters per side and micro-batch, kept as a table. Sketches add up, so the
counts of all open windows are a sum of small tables instead of a second read of the messages,
and an estimate is never below the count: no crowded key is missed, and one
that only seems crowded is merely cut.

Everything a micro-batch writes lies in a folder of its number and is written
over when it runs again, so a replayed batch counts once. Messages stay until
the watermark (newest time less the allowed lateness) passes their windows.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hopgrid.config import PRICED, MatchConfig, SplitPolicy
from hopgrid.operators import match as m
from hopgrid.operators.skew import grid_of, grid_table
from hopgrid.session import remove_dir

DEPTH = 4
WIDTH = 1 << 14
KEYS = [m.SLOT, "bin_0", "bin_1"]


def _cells(keys: Sequence[str]) -> Column:
    """The counter of a key in every row of the sketch."""
    return F.array(*[F.struct(F.lit(i).alias("line"), F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(WIDTH)).cast("int").alias("cell"))
                     for i in range(DEPTH)])


def count_sketch(keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count-min sketch of the keys of two sides: line, cell, l, r (at most DEPTH * WIDTH rows).

    ``keyed`` has the keys and ``l`` / ``r``, the number of rows on each side.
    """
    counts = keyed.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return merged_sketches(counts.select(F.inline(_cells(keys)), "l", "r"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("line", "cell").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))


def estimated(keys_of: DataFrame, sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys with estimates ``l`` and ``r``, never below the true counts."""
    wanted = keys_of.select(*keys).dropna().distinct().select(*keys, F.inline(_cells(keys)))
    found = wanted.join(F.broadcast(sketch), ["line", "cell"])  # at most DEPTH * WIDTH rows
    return found.groupBy(*keys).agg(F.min("l").alias("l"), F.min("r").alias("r"))


class BurstMatcher:
    """What one micro-batch does; ``folder`` holds trips, kept messages, sketches and marks by batch number."""

    def __init__(self, folder: str, cfg: MatchConfig = PRICED, matcher=m.match_priced, columns: Sequence[str] = m.TRIP_COLUMNS,
                 carry: Sequence[str] = ()):
        self.folder, self.cfg, self.matcher, self.carry = folder.rstrip("/"), cfg, matcher, list(carry)
        self.columns = [*columns, *[f"{role}_{name}" for name in carry for role in ("driver", "passenger")]]
        if cfg.trip_ids == "random":  # a replayed batch must write the same trips
            self.cfg = dataclasses.replace(cfg, trip_ids="stable")

    def path(self, kind: str, batch: int) -> str:
        return f"{self.folder}/{kind}/batch={batch}"

    def _read(self, spark: SparkSession, kind: str, batches: list[int]) -> DataFrame:
        return spark.read.parquet(*[self.path(kind, b) for b in batches])

    def _sides(self, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
        drivers = kept.where("is_driver").select(F.col("id").alias("plate_id"), "ride_offer", "location", "ts", *self.carry)
        passengers = kept.where("not is_driver").select(
            F.col("id").alias("passenger_id"), "ride_offer", "location", "dropoff_location", "ts", *self.carry)
        return drivers, passengers

    def _keyed(self, messages: DataFrame) -> DataFrame:
        return m.with_bins(m.with_window(messages, self.cfg), self.cfg)

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # (batch, newest time, end of its last window) of open batches: one row each, as left by the batch before.
        marks = self._read(spark, "marks", [number - 1]).collect() if number else []
        horizon = F.lit(max((r.newest for r in marks), default=None)).cast("timestamp") - F.expr(f"INTERVAL {self.cfg.lateness}")
        end = F.window("ts", self.cfg.window_length)["end"]
        in_time = batch.withColumn("window_end", end).where(F.coalesce(F.col("window_end") > horizon, F.lit(not marks)))
        in_time.write.mode("overwrite").parquet(self.path("kept", number))
        fresh = self._read(spark, "kept", [number])
        edge = fresh.agg(F.max("ts").alias("newest"), F.max("window_end").alias("last_end")).first()
        limit = spark.range(1).select(horizon.alias("h")).first().h
        live = [r.batch for r in marks if r.last_end is not None and (limit is None or r.last_end > limit)]

        counted = self._keyed(fresh).select(*KEYS, F.col("is_driver").cast("int").alias("l"), (~F.col("is_driver")).cast("int").alias("r"))
        count_sketch(counted, KEYS).coalesce(1).write.mode("overwrite").parquet(self.path("sketch", number))
        sketch = merged_sketches(self._read(spark, "sketch", [*live, number]))
        grid = grid_table(grid_of(estimated(counted, sketch, KEYS), KEYS, self.cfg.split), self.cfg.split)
        # Nothing is crowded, or the crowded keys are known: either way the join counts nothing.
        cfg = dataclasses.replace(self.cfg, crowded=grid, split=dataclasses.replace(self.cfg.split, enabled=False))

        drivers, passengers = self._sides(fresh)
        old_drivers, old_passengers = self._sides(self._read(spark, "kept", live)) if live else (None, None)
        trips = self.matcher(drivers, passengers.unionByName(old_passengers) if live else passengers, cfg, carry=self.carry)
        if live:
            trips = trips.unionByName(self.matcher(old_drivers, passengers, cfg, carry=self.carry))
        trips.select(*self.columns).write.mode("overwrite").parquet(self.path("trips", number))

        newest = max([t for t in [edge.newest, *[r.newest for r in marks]] if t is not None], default=None)
        rows = [(r.batch, newest, r.last_end) for r in marks if r.batch in live] + [(number, newest, edge.last_end)]
        spark.createDataFrame(rows, "batch long, newest timestamp, last_end timestamp").coalesce(1).write.mode("overwrite").parquet(
            self.path("marks", number))
        # Closed one batch ago: nobody reads these any more, not even a replay of this batch.
        for gone in {r.batch for r in marks} - set(live) - {number - 1}:
            for kind in ("kept", "sketch"):
                remove_dir(spark, self.path(kind, gone))


def one_stream(drivers: DataFrame, passengers: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Both kinds of messages in one frame, as ``BurstMatcher`` takes them."""
    none = F.lit(None).cast("array<double>")
    return drivers.select(F.lit(True).alias("is_driver"), F.col("plate_id").alias("id"), "ride_offer", "location",
                          none.alias("dropoff_location"), "ts", *carry).unionByName(
        passengers.select(F.lit(False).alias("is_driver"), F.col("passenger_id").alias("id"), "ride_offer", "location",
                          "dropoff_location", "ts", *carry))


def start_burst_match(drivers: DataFrame, passengers: DataFrame, folder: str, checkpoint: str, cfg: MatchConfig = PRICED,
                      carry: Sequence[str] = (), trigger: dict | None = None, columns: Sequence[str] = m.TRIP_COLUMNS) -> StreamingQuery:
    """Match two streams into ``folder``/trips, with ``columns`` and the carried ones; crowded bins are found as they come up."""
    return (one_stream(drivers, passengers, carry).writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(BurstMatcher(folder, cfg, columns=columns, carry=carry)).trigger(**(trigger or {"processingTime": "15 seconds"})).start())
