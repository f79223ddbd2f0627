from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from hopgrid.functions import geo, identity, pricing


def column(spark, values, expression, kind="double"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row[0] for row in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_money_is_rounded_on_the_exact_value(spark):
    rng = random.Random(5)
    values = [i / 1000 for i in range(-3000, 30000)] + [rng.uniform(-1e6, 1e6) for _ in range(5000)]
    values += [2.675, 1.005, -0.005, 0.0, 0.125, -0.125, 0.375, 1e6 + 0.005, 123456789.125, 3e13 + 0.125]
    assert column(spark, values, pricing.round_money) == [round(v, 2) for v in values]
    rng = random.Random(7)
    band = [45000000000000.015625, 2.0 ** 52 / 100, 2.0 ** 46 - 2.0 ** -7, 2.0 ** 46, 2.0 ** 46 + 2.0 ** -6]
    band += [rng.choice((1, -1)) * rng.uniform(low, 2 * low) for low in (4e13, 4.4e13, 6e13, 1e14, 4e15) for _ in range(400)]
    assert column(spark, band, pricing.round_money) == [round(v, 2) for v in band]
    odd = column(spark, [math.inf, -math.inf, 5e15 + 1, None], pricing.round_money)
    assert odd == [math.inf, -math.inf, 5e15 + 1, None]


def test_price_table(spark):
    offers = [0.0, 1.0, 2.0, 2.5, 2.51, 2.55, 2.65, 3.0, 10.0]
    assert column(spark, offers, pricing.customer_cost) == [0.60, 1.81, 3.02, 3.63, 3.95, 4.00, 4.13, 4.60, 13.91]
    assert column(spark, offers, pricing.company_margin) == [0.5, 0.5, 0.5, 0.5, 0.75, 0.76, 0.77, 0.80, 1.5]


def test_compatible_offers_include_the_limit(spark):
    assert column(spark, [1.49, 1.5, 1.51, None], lambda x: pricing.offers_compatible(F.lit(2.0), x)) == [
        False, True, True, None]


def test_seat_offer_without_seats_is_null(spark):
    assert column(spark, [0, 4, None], lambda s: pricing.seat_offer(F.lit(7.396), s), "int") == [None, 1.85, None]


def test_distances(spark):
    lon_a, lat_a, lon_b, lat_b = (F.lit(v) for v in (-0.34471, 39.45879, -0.3270, 39.4780))
    row = spark.range(1).select(
        geo.haversine_km(lon_a, lat_a, lon_b, lat_b), geo.trip_distance_km(lon_a, lat_a, lon_b, lat_b),
        geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)),
        geo.haversine_km(F.lit(None).cast("double"), lat_a, lon_b, lat_b)).first()
    assert row[0] == pytest.approx(2.6217939, abs=1e-6)
    assert row[1] == pytest.approx(2.9052652, abs=1e-6)
    assert row[2] == pytest.approx(math.pi * 6371)
    assert row[3] is None


def test_bins_truncate_toward_zero(spark):
    values = [-0.0003, -0.0002, 0.0, 0.0002, 0.0003, 39.45879, -0.34471]
    bins = column(spark, values, lambda x: geo.location_bin(x, 0.00025))
    assert bins == [int(v / 0.00025) for v in values]
    assert bins[1] == bins[3] == 0
    assert column(spark, [math.nan, None], lambda x: geo.location_bin(x, 0.00025)) == [None, None]


def test_number_text_is_the_shortest_decimal(spark):
    rng = random.Random(9)
    values = [rng.uniform(-180, 180) for _ in range(3000)] + [10 ** rng.uniform(-12, 15) for _ in range(2000)]
    values += [0.0, 0.001, 0.0005, -0.00012, 1e-4, 9e-5, 1e-5, -2.5e-7, 1e7, 123456789.5, -0.34471, 39.45879]
    assert column(spark, values, geo.number_text) == [repr(v) for v in values]


def test_wkt_swaps_the_pair_and_reads_back(spark):
    frame = spark.createDataFrame([(-0.34471, 39.45879)], "a double, b double")
    text = frame.select(geo.trip_wkt(F.col("a"), F.col("b")).alias("t"))
    assert text.first()[0] == "POINT(39.45879 -0.34471)"
    assert tuple(text.select(*geo.wkt_pair(F.col("t"))).first()) == (39.45879, -0.34471)
    # Numbers without a decimal point lose their sign.
    lost = spark.createDataFrame([("POINT(-5 7)",), ("POINT EMPTY",)], "t string")
    assert [tuple(r) for r in lost.select(*geo.wkt_pair(F.col("t"))).collect()] == [(5.0, 7.0), (None, None)]


def test_pickup_radius_and_tolerance(spark):
    def near(x):
        return geo.within_pickup_radius(F.lit(0.0), F.lit(0.0), x, F.lit(0.0))
    assert column(spark, [0.0, 0.00089, 0.0009, None], near) == [True, True, False, None]
    t = 0.00027027

    def tolerated(x):
        return geo.within_tolerance(F.lit(0.0), F.lit(0.0), x, F.lit(0.0), t)
    assert column(spark, [t, -t, t * 1.01], tolerated) == [True, True, False]


def test_ids(spark):
    assert column(spark, ["1234ABC", "1234abc", "123ABC", "1234ABCD"], identity.valid_plate, "string") == [
        True, False, False, False]
    assert column(spark, ["12345678A", "1234567A", "12345678a"], identity.valid_passenger_id, "string") == [
        True, False, False]
    ids = column(spark, ["a", "a", "b", None], lambda x: identity.stable_trip_id(x, F.lit(1)), "string")
    assert ids[0] == ids[1] != ids[2] and len(set(ids)) == 3
    assert all(len(i) == 36 and i.count("-") == 4 for i in ids)
