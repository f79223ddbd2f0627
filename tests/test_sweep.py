"""The offer sweep against plain loops; its plan; a bin that many tasks share."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from hopgrid.operators import kpis, sweep
from messages import crowd, driver, frames, passenger, same_bin, window


def plain_levels(drivers, passengers):
    cars, riders = Counter(), Counter()
    for side, rows, share in ((cars, drivers, 0.75), (riders, passengers, 1.0)):
        for r in rows:
            if r[2] is not None:
                side[(window(r, 15), *(int(x / 0.00025) for x in r[3]), r[2] * share)] += 1
    out = []
    for *place, price in {*cars, *riders}:
        below = sum(n for k, n in cars.items() if [*k[:3]] == place and k[3] <= price)
        above = sum(n for k, n in riders.items() if [*k[:3]] == place and k[3] >= price)
        out.append((*place[1:], price, cars[(*place, price)], riders[(*place, price)], below, above))
    return sorted(out)


@pytest.mark.parametrize("tasks", [None, 1, 7, 40])
def test_levels_against_loops(spark, tasks):
    drivers, passengers = crowd(3, 260, 5)
    drivers += [driver(900, 3, -0.37, 39.47, None), *drivers[:4]]
    passengers += [passenger(901, 3, -0.37, 39.47, None), passenger(902, 3, -0.37, 39.47, float("inf")), *passengers[:4]]
    got = sweep.offer_levels(*frames(spark, drivers, passengers), tasks=tasks).drop("match_window")
    assert sorted(map(tuple, got.collect())) == plain_levels(drivers, passengers)


def test_money_as_with_the_join(spark):
    both = frames(spark, *crowd(5, 300, 4))
    assert sweep.money_sweep(*both, tasks=9).first() == kpis.money_from_messages(*both).first()
    nothing = [f.where("false") for f in both]
    assert tuple(sweep.money_sweep(*nothing).first()) == (None, None, None)


def test_demand(spark):
    drivers, passengers = crowd(6, 200, 3)
    got = sweep.driver_demand(*frames(spark, drivers, passengers), tasks=5).agg(
        F.sum("drivers"), F.sum("trips"), F.sum("without_match")).first()
    partners = [sum(window(d, 15) == window(p, 15) and same_bin(d, p) and p[2] >= d[2] * 0.75 for p in passengers) for d in drivers]
    assert tuple(got) == (len(drivers), sum(partners), partners.count(0))


def test_plan_has_no_join_and_one_bin_is_shared_by_tasks(spark):
    """A bin with many prices: the sorted parts are swept apart, each from the sums before it."""
    n = 20_000
    ids = spark.range(n)
    place = F.array(F.lit(-0.37), F.lit(39.47))
    when = F.lit("2024-01-01 00:00:03").cast("timestamp")
    offer = 1.0 + F.col("id") / n
    cars = ids.select(F.col("id").alias("event_id"), F.lit("1234ABC").alias("plate_id"), (offer / 0.75).alias("ride_offer"),
                      place.alias("location"), when.alias("ts"))
    riders = ids.select(F.col("id").alias("event_id"), F.lit("12345678A").alias("passenger_id"), (offer + 0.5 / n).alias("ride_offer"),
                        place.alias("location"), place.alias("dropoff_location"), when.alias("ts"))
    levels = sweep.offer_levels(cars, riders, tasks=8)
    plan = levels._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan and "Python" not in plan
    parts = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in levels.inputFiles()}).groupBy("part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 2 * 2 * n / 8
    assert sweep.money_sweep(cars, riders, tasks=8).first().trips == n * (n + 1) // 2
