"""Streams that find crowded bins by themselves, and the chained collapse."""

from __future__ import annotations

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from hopgrid.config import PRICED, SplitPolicy
from hopgrid.operators import match as m
from hopgrid.operators.skew import grid_of
from hopgrid.streaming import burst
from hopgrid.streaming import match as st
from messages import DRIVER, PASSENGER, crowd, driver, frames, passenger
from test_streaming import NOW, feed

IDS = ["driver_event_id", "passenger_event_id"]
CFG = dataclasses.replace(PRICED, lateness="5 minutes", split=SplitPolicy(block_rows=8))


def test_burst_stream_equals_batch(spark, tmp_path):
    drivers, passengers = frames(spark, *crowd(8, 300, 6))
    streams = [feed(spark, str(tmp_path / name), frame, 4) for name, frame in (("d", drivers), ("p", passengers))]
    folder = str(tmp_path / "out")
    burst.start_burst_match(*streams, folder, str(tmp_path / "cp"), CFG, ["event_id"], NOW).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{folder}/trips").select(*IDS).collect()))
    batch = m.match_priced(drivers, passengers, PRICED, carry=["event_id"]).select(*IDS)
    assert got == sorted(map(tuple, batch.collect())) and got


def test_replayed_batches_count_once_and_closed_windows_go(spark, tmp_path):
    matcher = burst.BurstMatcher(str(tmp_path), dataclasses.replace(CFG, lateness="10 seconds"), carry=["event_id"])
    here = (-0.37, 39.47)
    batches = [([driver(1, 1, *here)], [passenger(1, 2, *here)]), ([driver(2, 3, *here)], [passenger(2, 4, *here)]),
               ([driver(3, 100, *here)], []), ([driver(4, 5, *here), driver(5, 200, *here)], [passenger(5, 101, *here), passenger(6, 201, *here)])]

    def run(number):
        d, p = batches[number]
        matcher(burst.one_stream(spark.createDataFrame(d, DRIVER), spark.createDataFrame(p, PASSENGER), ["event_id"]), number)

    for number in (0, 1, 1, 2, 3, 3):  # two of them run twice
        run(number)
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/trips").select(*IDS).collect()))
    # Driver 4 is late by more than ten seconds; driver 3 waited for passenger 5 over a batch.
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 5), (5, 6)]
    assert spark.read.parquet(f"{tmp_path}/trips").select("trip_id").distinct().count() == len(got)
    assert sorted(os.listdir(tmp_path / "kept")) == ["batch=2", "batch=3"] or "batch=0" not in os.listdir(tmp_path / "kept")


def test_sketch_never_underestimates_and_adds_up(spark):
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(3000)).alias("k"), (F.col("id") % 3 == 0).cast("int").alias("l"))
    rows = rows.unionByName(spark.range(4000).select(F.lit(7).cast("bigint").alias("k"), F.lit(1).alias("l"))).withColumn("r", 1 - F.col("l"))
    halves = [rows.where(f"pmod(xxhash64(k, l, 1), 2) = {i}") for i in (0, 1)]
    merged = burst.merged_sketches(burst.count_sketch(halves[0], ["k"]).unionByName(burst.count_sketch(halves[1], ["k"])))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, burst.count_sketch(rows, ["k"]).collect()))
    assert merged.count() <= burst.DEPTH * burst.WIDTH
    true = rows.groupBy("k").agg(F.sum("l").alias("tl"), F.sum("r").alias("tr"))
    both = burst.estimated(rows, merged, ["k"]).join(true, "k").collect()
    assert len(both) == true.count() and all(r.l >= r.tl and r.r >= r.tr for r in both)
    assert sum(r.l > r.tl for r in both) < 10


def test_blocks_of_a_burst_are_even(spark):
    """The grid that estimates give leaves no block with over twice the median."""
    drivers, passengers = frames(spark, *crowd(9, 6000, 4))
    cfg = dataclasses.replace(PRICED, split=SplitPolicy(block_rows=128))
    sides = [m.with_bins(m.with_window(f, cfg), cfg).select(*burst.KEYS, "event_id") for f in (drivers, passengers)]
    counted = sides[0].withColumns({"l": F.lit(1), "r": F.lit(0)}).unionByName(sides[1].withColumns({"l": F.lit(0), "r": F.lit(1)}))
    grid = grid_of(burst.estimated(counted, burst.count_sketch(counted, burst.KEYS), burst.KEYS), burst.KEYS, cfg.split)
    grid = grid.orderBy(F.desc("left_parts")).limit(1)  # the burst itself
    hot = grid.first()
    for side in sides:
        n = side.join(grid, burst.KEYS, "left_semi").count()
        parts = hot.left_parts if side is sides[0] else hot.right_parts
        sizes = [r["count"] for r in side.join(grid, burst.KEYS, "left_semi").groupBy(
            F.pmod(F.xxhash64(*side.columns), F.lit(parts))).count().collect()]
        assert len(sizes) == parts > 2 and sum(sizes) == n and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


@pytest.mark.parametrize("files", [1, 3])
def test_collapse_on_the_stream(spark, tmp_path, files):
    drivers, passengers = crowd(4, 160, 3)
    batch = m.collapsed_matches(*frames(spark, drivers, passengers), PRICED)
    end = (5000, -0.1, 39.1)
    closed = frames(spark, drivers + [driver(990, *end)], passengers + [passenger(991, *end)])
    streams = [feed(spark, str(tmp_path / name), frame, files) for name, frame in (("d", closed[0]), ("p", closed[1]))]
    counts = st.collapsed_stream(*streams, dataclasses.replace(PRICED, lateness="2 minutes"))
    (counts.writeStream.format("parquet").option("path", str(tmp_path / "t")).option("checkpointLocation", str(tmp_path / "cp"))
     .trigger(**NOW).start().awaitTermination())
    got = st.collapse_counts(spark.read.parquet(str(tmp_path / "t")))
    assert got.count() > 0 and sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.select(*got.columns).collect()))


def test_burst_writes_the_columns_asked_for(spark, tmp_path):
    """Ids and texts that nobody asked for are not formed for every pair of a burst."""
    drivers, passengers = frames(spark, *crowd(6, 60, 2))
    streams = [feed(spark, str(tmp_path / name), frame, 1) for name, frame in (("d", drivers), ("p", passengers))]
    folder = str(tmp_path / "out")
    burst.start_burst_match(*streams, folder, str(tmp_path / "cp"), CFG, ["event_id"], NOW, columns=["cost"]).awaitTermination()
    trips = spark.read.parquet(f"{folder}/trips").drop("batch")
    assert sorted(trips.columns) == ["cost", *IDS]
    batch = m.match_priced(drivers, passengers, PRICED, carry=["event_id"]).select(*trips.columns)
    assert trips.count() > 0 and trips.exceptAll(batch).count() == batch.exceptAll(trips).count() == 0
