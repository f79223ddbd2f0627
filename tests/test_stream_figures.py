"""Figures that follow the stream, sketches, appends under a job's name, positions that leave."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from hopgrid.operators import kpis, match as m, records, sketches
from hopgrid.sinks.tables import append_once
from hopgrid.streaming import figures
from messages import at, crowd, frames
from test_streaming import NOW, feed


def timed(spark, seed=3, count=300):
    drivers, passengers = frames(spark, *crowd(seed, count, 5))
    trips = m.match_priced(drivers, passengers, carry=["ts"]).withColumnRenamed("driver_ts", "ts")
    return drivers, trips.select("driver_id", "cost", "company_margin", "travelled_distance", "ts")


def batch_figures(drivers, trips):
    money, ratio = kpis.income_and_volume(trips).first(), kpis.match_ratio(drivers, trips).first()
    return (ratio.enrolled, ratio.matched, trips.count(), money.total_volume_traded, round(money.total_income, 2), ratio.match_ratio)


def shown(spark, folder):
    r = figures.current_figures(spark, folder).first()
    assert (r.enrolled_estimate, r.matched_estimate) == (r.enrolled, r.matched)  # few ids: exact
    return (r.enrolled, r.matched, r.trips, r.total_volume_traded, r.total_income, r.match_ratio)


def test_restart_in_mid_stream(spark, tmp_path):
    drivers, trips = timed(spark)
    folder = str(tmp_path / "kept")
    for n, late in enumerate(("ts < '2024-01-01 00:00:20'", "ts >= '2024-01-01 00:00:20'")):
        streams = [feed(spark, str(tmp_path / name), frame.where(late), 3) for name, frame in (("d", drivers), ("t", trips))]
        figures.start_figures(*streams, folder, str(tmp_path / "cp"), "15 seconds", NOW).awaitTermination()
        if not n:
            assert shown(spark, folder) == batch_figures(drivers.where(late), trips.where(late))
    assert shown(spark, folder) == batch_figures(drivers, trips)
    state = figures.window_figures(spark, folder)
    assert state.count() == state.select("window_start").distinct().count() == 4
    assert len([d for d in os.listdir(f"{folder}/state") if d.startswith("batch")]) == 2


def test_replayed_batch_counts_once(spark, tmp_path):
    drivers, trips = timed(spark, 5, 120)
    keeper = figures.FigureKeeper(str(tmp_path), "1 minute")
    parts = [figures.one_stream(drivers.where(w), trips.where(w)) for w in ("second(ts) < 9", "second(ts) between 9 and 30", "second(ts) > 30")]
    for number in (0, 1, 1, 2, 2):
        keeper(parts[number], number)
    assert shown(spark, str(tmp_path)) == batch_figures(drivers, trips)


def test_sketches_keep_their_bound(spark):
    """More ids than a sketch holds: unions and intersections over days stay within the stated error."""
    n = 120_000
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).cast("timestamp")
    drivers = spark.range(n).select((F.col("id") % 90_000).cast("string").alias("plate_id"), day.alias("ts"))
    trips = spark.range(n).select((F.col("id") + 40_000).cast("string").alias("driver_id"),
                                  F.when(F.col("id") % 3 == 0, 0.0).when(F.col("id") % 3 == 1, 1.0).alias("travelled_distance"), day.alias("ts"))
    stored = sketches.daily_sketches(drivers, trips)
    assert stored.count() == 5
    for got, want in ((sketches.sketched_figures(stored), sketches.exact_figures(drivers, trips)),
                      (sketches.sketched_figures(stored, "day").orderBy("day"), sketches.exact_figures(drivers, trips, daily=True).orderBy("day"))):
        for g, w in zip(got.collect(), want.collect(), strict=True):
            for name in ("enrolled", "matched"):
                assert abs(g[name] - w[name]) <= sketches.ERROR * w[name]
            assert abs(g.both - w.both) <= sketches.ERROR * (w.enrolled + w.matched)
    assert max(len(r.enrolled) for r in stored.collect()) < 8 * 2 ** (sketches.SIZE + 1) + 100


def test_append_once(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(10).selectExpr("cast(id as string) as trip_id", "id as x")
    for job, part in (("a", rows.where("x < 5")), ("b", rows.where("x >= 5")), ("a", rows.where("x < 5"))):
        append_once(part, path, job, ("trip_id",))
    table = spark.read.parquet(path)
    assert table.columns == ["trip_id", "job"] and table.count() == 10 and table.where("job = 'a'").count() == 5
    with pytest.raises(ValueError):
        append_once(rows, path, "../x")


def test_silent_cars_leave_the_state(spark, tmp_path):
    rows = [(f"car{k}", float(k), 1.0, at(k % 30)) for k in range(100)] + [("car7", 70.0, 2.0, at(400)), ("car8", 80.0, 2.0, at(4000))]
    frame = spark.createDataFrame(rows, "id string, lon double, lat double, ts timestamp")
    for n, part in enumerate(("ts < '2024-01-01 00:01:00'", "ts between '2024-01-01 00:01:00' and '2024-01-01 00:30:00'", "ts > '2024-01-01 00:30:00'")):
        frame.where(part).coalesce(1).write.parquet(str(tmp_path / "pos" / f"part={n}"))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "pos")).select(*frame.columns)
    query = (records.live_positions(stream, "5 minutes").writeStream.outputMode("update").format("memory").queryName("live")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start())
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(states) >= 50 and states[-1] <= 2
    written = spark.table("live")
    latest = {r["id"]: r["lon"] for r in records.current_positions(written).collect()}
    assert latest == {**{f"car{k}": float(k) for k in range(100)}, "car7": 70.0, "car8": 80.0}
    assert {r["id"] for r in records.current_positions(written, after=F.lit(at(300))).collect()} == {"car7", "car8"}
