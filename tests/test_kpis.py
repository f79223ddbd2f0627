from __future__ import annotations

import pytest

from hopgrid.operators import kpis
from hopgrid.sources import documents

TRIP = ("trip_id string, driver_id string, passenger_id string, pickup_location string, dropoff_location string, "
        "travelled_distance double, cost double, company_margin double")


@pytest.fixture(scope="module")
def tables(spark):
    trips = spark.createDataFrame([
        ("t1", "A", "p1", "POINT(39.5 -0.5)", "POINT(39.7 -0.3)", 2.5, 1.81, 0.5),
        ("t2", "A", "p2", "POINT(39.5 -0.5)", "POINT(39.7 -0.3)", 0.0, 3.95, 0.75),
        ("t3", "B", "p1", "POINT(39.5 -0.5)", "POINT(39.7 -0.3)", 1.0, 2.0, None),
        ("t4", "C", "p9", "POINT(39.5 -0.5)", "POINT(39.7 -0.3)", None, 1.0, 0.5),
        ("t' OR '1'='1", "D", "p9", "POINT(1.5 2.5)", "POINT(1.5 2.5)", 0.0, 0.0, 0.0)], TRIP)
    drivers = spark.createDataFrame([("A", 4, 0), ("A", 4, 0), ("B", 5, 0), ("C", 6, 0), ("D", 6, 0), ("E", 6, 0),
                                     ("F", 4, 0)], "plate_id string, seats int, passengers int")
    passengers = spark.createDataFrame([
        ("p1", (39.47, -0.37), 1.0), ("p1", (39.48, -0.36), 1.0), ("p2", (39.49, -0.35), 2.0)],
        "passenger_id string, location struct<longitude: double, latitude: double>, ride_offer double")
    return drivers, passengers, trips


def test_figures(tables):
    drivers, _, trips = tables
    assert kpis.enrolled_drivers(drivers).first()[0] == 6
    assert kpis.enrolled_drivers(drivers, approximate=True).first()[0] == 6
    assert kpis.traded_volume(trips).first()[0] == 8.76
    assert kpis.total_income(trips).first()[0] == 1.75
    assert sorted(r[0] for r in kpis.margins(trips).collect()) == [0.0, 0.5, 0.5, 0.75]
    assert tuple(kpis.margin_summary(trips).first()) == (4, 0.4375)
    assert kpis.matched_drivers(trips).first()[0] == 2
    assert tuple(kpis.match_ratio(drivers, trips).first()) == (6, 2, 0.33, 33.0)
    assert [tuple(r) for r in kpis.matching_status(drivers, trips).collect()] == [
        ("drivers with no match", 4), ("drivers with match", 2)]
    assert tuple(kpis.income_and_volume(trips).first()) == (1.75, 8.76)


def test_ratio_without_drivers_is_null(tables):
    drivers, _, trips = tables
    assert kpis.match_ratio(drivers.limit(0), trips).first()["match_ratio"] is None


def test_lookups_take_the_id_as_a_value(tables):
    _, passengers, trips = tables
    assert kpis.find_trip(trips, "t1").first()["travelled_distance"] == 2.5
    assert kpis.find_trip(trips, "t' OR '1'='1").first()["driver_id"] == "D"
    assert kpis.find_trip(trips, "x' OR '1'='1").count() == 0
    found = kpis.find_passenger(passengers, trips, "t2").first().asDict()
    assert found == {"latitude": 39.49, "longitude": -0.35}
    bulk = {r["trip_id"]: (r["latitude"], r["longitude"]) for r in kpis.passenger_of_trips(passengers, trips).collect()}
    assert bulk == {"t1": (39.47, -0.37), "t2": (39.49, -0.35), "t3": (39.47, -0.37)}


def test_trip_points(tables):
    row = kpis.trip_points(tables[2]).where("trip_id = 't1'").first()
    assert (row["pickup_lat"], row["pickup_lon"], row["dropoff_lat"], row["dropoff_lon"]) == (39.5, -0.5, 39.7, -0.3)
    assert (row["center_lat"], row["center_lon"]) == (pytest.approx(39.6), pytest.approx(-0.4))


def test_tables_by_name(spark, tables, tmp_path):
    for name, frame in zip(documents.TABLES, tables):
        frame.write.parquet(str(tmp_path / name))
    documents.open_tables(spark, str(tmp_path))
    assert spark.sql("SELECT COUNT(DISTINCT plate_id) FROM drivers").first()[0] == 6
    assert spark.sql("SELECT SUM(company_margin) FROM trips WHERE company_margin IS NOT NULL").first()[0] == 1.75
    joined = spark.table("passengers").join(spark.table("trips").where("trip_id = 't2'"), "passenger_id", "left_semi")
    assert joined.select("location").count() == 1
    with pytest.raises(ValueError):
        documents.register_tables(spark, rides=tables[0])


def test_documents(spark, tmp_path):
    (tmp_path / "driver.json").write_text("""{"plate_id": "AB12",
      "course": [[2.5, 41.25]], "seats": 3, "passengers": 1, "trip_cost": 8.25,
      "full_tariff": 9.5, "location": [{"lon": 2.5, "lat": 41.25}]}""")
    (tmp_path / "passenger.json").write_text("""{"passenger_id": "P-77", "pick_location": [],
      "dropoff_location": [], "distance": 0.0, "location": [2.5, 41.25]}""")
    row = documents.driver_summary(documents.read_documents(spark, str(tmp_path / "driver.json"))).first()
    assert tuple(row) == ("AB12", 8.25, 2.5, 41.25)
    passenger = documents.read_documents(spark, str(tmp_path / "passenger.json"), documents.PASSENGER_DOCUMENT).first()
    assert passenger["location"] == [2.5, 41.25] and passenger["pick_location"] == []
