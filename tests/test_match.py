from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from hopgrid.config import EXACT, PRICED, SplitPolicy
from hopgrid.operators import kpis, match as m
from messages import at, crowd, driver, frames, pairs, passenger, same_bin

SPLIT = SplitPolicy(block_rows=8, sample_fraction=1.0)


def found(trips):
    return sorted((r[0], r[1]) for r in trips.select("driver_event_id", "passenger_event_id").collect())


def compatible(d, p):
    return p[2] >= d[2] * 0.75


def test_trip_columns_and_values(spark):
    drivers, passengers = frames(spark, [driver(1, 0, -0.34471, 39.45879, 1.48, "AB12")],
                                 [passenger(2, 14, -0.34471, 39.45879, 2.55, "P-77")])
    trips = m.match_priced(drivers, passengers, geographic=True)
    row = trips.first().asDict()
    assert tuple(trips.columns) == (*m.TRIP_COLUMNS, "travelled_distance_geo", "pickup_wkt_lonlat")
    assert len(row.pop("trip_id")) == 36
    assert row == {
        "bin_key": f"{int(-0.34471 / 0.00025)}_{int(39.45879 / 0.00025)}", "driver_id": "AB12",
        "passenger_id": "P-77", "pickup_location": "POINT(39.45879 -0.34471)",
        "dropoff_location": "POINT(39.478 -0.327)", "travelled_distance": 2.91, "status": "matched", "cost": 4.0,
        "company_margin": 0.76, "accepted_offer": 2.55, "travelled_distance_geo": 2.62,
        "pickup_wkt_lonlat": "POINT(-0.34471 39.45879)"}


def test_window_edges_offers_and_repeats(spark):
    here = (-0.37, 39.47)
    drivers = [driver(1, 14.999, *here), driver(2, 15.0, *here), driver(3, 15.5, *here), driver(4, 20, 0.37, 39.47)]
    passengers = [passenger(11, 14, *here, 1.5), passenger(12, 29.9, *here, 1.49), passenger(13, 29.9, *here, 1.5),
                  passenger(14, 30.0, *here), passenger(15, 16, 0.37, 39.47, 9.0)]
    trips = m.match_priced(*frames(spark, drivers, passengers), carry=["event_id"])
    assert found(trips) == [(1, 11), (2, 13), (3, 13), (4, 15)]


def test_bins_around_zero_are_one_bin(spark):
    trips = m.match_priced(*frames(spark, [driver(1, 0, -0.0002, 0.0001)], [passenger(2, 0, 0.0002, -0.0001)]),
                           carry=["event_id"])
    assert found(trips) == [(1, 2)] and trips.first()["bin_key"] == "0_0"


@pytest.mark.parametrize("policy", [SplitPolicy(enabled=False), SPLIT, dataclasses.replace(SPLIT, broadcast_keys=0),
                                    dataclasses.replace(SPLIT, sample_fraction=0.3),
                                    dataclasses.replace(SPLIT, block_rows=1)])
def test_every_matcher_against_loops(spark, policy):
    drivers, passengers = crowd(3, 300, 8)
    sides = frames(spark, drivers, passengers)
    priced, exact = (dataclasses.replace(c, split=policy) for c in (PRICED, EXACT))
    assert found(m.match_priced(*sides, priced, carry=["event_id"])) == pairs(
        drivers, passengers, 15, lambda d, p: same_bin(d, p) and compatible(d, p))
    assert found(m.match_unpriced(*sides, priced, carry=["event_id"])) == pairs(drivers, passengers, 15, same_bin)
    same_place = pairs(drivers, passengers, 10, lambda d, p: d[3] == p[3])
    assert found(m.match_exact(*sides, exact, carry=["event_id"])) == same_place
    assert found(m.match_bare(*sides, exact, carry=["event_id"])) == same_place
    near = pairs(drivers, passengers, 10, lambda d, p: all(abs(a - b) <= 0.00027027 for a, b in zip(d[3], p[3])))
    assert found(m.match_tolerance(*sides, exact, carry=["event_id"])) == near
    assert len(near) > len(same_place) > 0


def test_identical_messages_all_pair_up(spark):
    drivers, passengers = [driver(1, 0, 1.0, 2.0)] * 30, [passenger(2, 0, 1.0, 2.0)] * 40
    cfg = dataclasses.replace(PRICED, split=SPLIT)
    trips = m.match_priced(*frames(spark, drivers, passengers), cfg)
    assert trips.count() == 1200 and trips.select("trip_id").distinct().count() == 1200


def test_split_cuts_the_hot_place_only(spark):
    from hopgrid.operators.skew import hot_keys
    drivers, passengers = frames(spark, *crowd(3, 300, 8))
    left, right = (m.with_bins(m.with_window(f, PRICED), PRICED) for f in (drivers, passengers))
    hot = hot_keys(left, right, [m.SLOT, "bin_0", "bin_1"], SPLIT).collect()
    assert len(hot) == 1 and hot[0]["left_parts"] > 1 and hot[0]["right_parts"] > 1


def test_tolerance_at_cell_borders(spark):
    t = EXACT.tolerance
    spots = [i * t / 2 for i in range(-9, 10)] + [i * t for i in range(100000, 100005)]
    drivers = [driver(i, 0, x, 39.47) for i, x in enumerate(spots)]
    passengers = [passenger(i, 0, x, 39.47) for i, x in enumerate(spots)]
    expected = pairs(drivers, passengers, 10, lambda d, p: abs(d[3][0] - p[3][0]) <= t)
    assert found(m.match_tolerance(*frames(spark, drivers, passengers), carry=["event_id"])) == expected


def test_stable_ids_repeat_and_random_ids_do_not(spark):
    sides = frames(spark, *crowd(4, 60, 4))
    stable = dataclasses.replace(PRICED, trip_ids="stable")
    ids = [sorted(r[0] for r in m.match_priced(*sides, cfg, carry=["event_id"]).select("trip_id").collect())
           for cfg in (stable, stable, PRICED)]
    assert ids[0] == ids[1] and len(set(ids[0])) == len(ids[0]) and not set(ids[0]) & set(ids[2])


def test_counts_equal_the_pairs(spark):
    drivers, passengers = crowd(5, 300, 8)
    sides = frames(spark, drivers, passengers)
    assert m.bin_counts(*sides).agg(F.sum("pairs")).first()[0] == len(pairs(drivers, passengers, 15, same_bin))
    assert m.location_counts(*sides).agg(F.sum("pairs")).first()[0] == len(
        pairs(drivers, passengers, 10, lambda d, p: d[3] == p[3]))


def test_collapsed_forms_agree(spark):
    sides = frames(spark, *crowd(6, 300, 8))
    columns = ["driver_id", "passenger_id", "bin_key", "matches", "min_cost", "max_cost"]
    cfg = dataclasses.replace(PRICED, split=SPLIT)
    one = m.collapse_trips(m.match_priced(*sides, cfg)).select(columns)
    two = m.collapsed_matches(*sides, cfg).select(columns)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.agg(F.max("matches")).first()[0] > 1


def test_money_and_drivers_without_pairs(spark):
    sides = frames(spark, *crowd(7, 400, 6))
    for policy in (SPLIT, SplitPolicy(enabled=False)):
        cfg = dataclasses.replace(PRICED, split=policy)
        trips = m.match_priced(*sides, cfg).persist()
        direct = kpis.money_from_messages(*sides, cfg).first()
        assert direct["trips"] == trips.count()
        assert direct["total_volume_traded"] == kpis.traded_volume(trips).first()[0]
        assert direct["total_income"] == pytest.approx(kpis.total_income(trips).first()[0])
        assert kpis.matched_drivers_from_messages(*sides, cfg).first() == kpis.matched_drivers(trips).first()
        trips.unpersist()


def test_null_places_never_match(spark):
    drivers = [(1, "1234ABC", 1.0, None, at(0)), (2, "1234ABC", 1.0, [float("nan"), 1.0], at(0))]
    passengers = [(3, "12345678A", 1.0, None, None, at(0)), (4, "12345678A", 1.0, [float("nan"), 1.0], [1.0, 1.0], at(0))]
    assert m.match_priced(*frames(spark, drivers, passengers)).count() == 0


def test_drivers_standing_at_a_dropoff(spark):
    """The best offer leads to where the car stands; a lower one leads away, or none does."""
    here, away = (-0.37, 39.47), (-0.30, 39.50)
    drivers = [driver(1, 0, *here, 2.0, "1111AAA"), driver(2, 20, *here, 2.0, "2222AAA"), driver(3, 40, *here, 2.0, "3333AAA"),
               driver(4, 60, *here, 9.0, "4444AAA")]
    passengers = [passenger(11, 0, *here, 9.0, drop=here), passenger(12, 0, *here, 1.5, drop=away),
                  passenger(13, 20, *here, 9.0, drop=here), passenger(14, 20, *here, 1.4, drop=away),
                  passenger(15, 40, *here, 1.5, drop=away), passenger(16, 60, *here, 5.0, drop=away)]
    sides = frames(spark, drivers, passengers)
    assert kpis.matched_drivers_from_messages(*sides).first()[0] == 2
    assert kpis.matched_drivers(m.match_priced(*sides)).first()[0] == 2


def test_known_crowded_bins_are_cut_without_counting(spark, monkeypatch):
    drivers, passengers = crowd(9, 400, 6)
    sides = frames(spark, drivers, passengers)
    cfg = dataclasses.replace(PRICED, split=SPLIT)
    bins = m.crowded_bins(*sides, cfg)
    rows = {(r["bin_0"], r["bin_1"]): (r["left_parts"], r["right_parts"]) for r in bins.collect()}
    assert min(rows[int(-0.37 / 0.00025), int(39.47 / 0.00025)]) > 4
    monkeypatch.setattr("hopgrid.operators.skew.hot_keys", None)  # nothing may be counted
    trips = m.match_priced(*sides, dataclasses.replace(cfg, crowded=bins), carry=["event_id"])
    assert found(trips) == pairs(drivers, passengers, 15, lambda d, p: same_bin(d, p) and compatible(d, p))
    with pytest.raises(ValueError):
        m.match_exact(*sides, dataclasses.replace(EXACT, crowded=bins))


def test_prices_are_reckoned_once_per_passenger(spark):
    """Costs lie below the join in the plan: a crowded bin does not reckon them anew for every pair."""
    sides = frames(spark, *crowd(8, 60, 6))
    costs = m.match_priced(*sides, carry=["event_id"]).select("driver_event_id", "cost", "company_margin")
    above, below = costs._jdf.queryExecution().optimizedPlan().toString().split("Join Inner", 1)
    assert "transform(" not in above and "transform(" in below
