from __future__ import annotations

import json

from pyspark.sql import functions as F

from hopgrid.operators import records
from hopgrid.sources import messages as s
from messages import at

DRIVER = {"plate_id": "AB12", "seats": 5, "full_tariff": 7.4, "ride_offer": 1.48, "location": [-0.34471, 39.45879]}
PASSENGER = {"passenger_id": "P-77", "pick_location": [], "location": [-0.34471, 39.45879], "ride_offer": 2.55,
             "dropoff_location": [-0.327, 39.478]}


def parse(spark, *values, kind="string"):
    raw = spark.createDataFrame([(v, at(i)) for i, v in enumerate(values)], f"value {kind}, ts timestamp")
    return s.parse_messages(raw)


def reasons(parsed):
    return [r[0] for r in parsed.orderBy("ts").select("reject_reason").collect()]


def test_reject_reasons(spark):
    good = json.dumps(DRIVER)
    cases = {
        good: None, json.dumps(PASSENGER): None,
        "{": "malformed_json", "": "malformed_json", good + " tail": "malformed_json", good + good: "malformed_json",
        "[1, 2]": "wrong_type", "7": "wrong_type", "{'plate_id': 'x'}": "malformed_json", "null": "malformed_json",
        json.dumps({**DRIVER, "seats": "four"}): "wrong_type",
        json.dumps({"location": [1.0, 2.0]}): "no_id",
        json.dumps({**DRIVER, "location": [1.0, 2.0, 3.0]}): "bad_location",
        json.dumps({**DRIVER, "location": [1.0, None]}): "bad_location",
        json.dumps({**DRIVER, "location": None}): "bad_location",
        json.dumps({"plate_id": "AB12"}): "bad_location",
        '{"plate_id": "AB12", "location": [NaN, 1.0]}': "bad_location",
        json.dumps({**DRIVER, "location": [1, 2], "colour": {"deep": [1]}}): None,
    }
    assert dict(zip(cases, reasons(parse(spark, *cases)))) == cases


def test_bytes_and_bad_utf8(spark):
    parsed = parse(spark, json.dumps(DRIVER).encode(), b'{"plate_id": "\xff\xfe", "location": [1, 2]}', None, kind="binary")
    assert reasons(parsed) == [None, "invalid_utf8", "malformed_json"]
    assert s.accepted(parsed).count() == 1
    assert s.rejected(parsed).columns == ["value", "reject_reason", "ts"]


def test_roles_follow_key_presence(spark):
    both = {**PASSENGER, **DRIVER}
    null_plate = {**PASSENGER, "plate_id": None}
    parsed = s.accepted(parse(spark, *[json.dumps(m) for m in (DRIVER, PASSENGER, both, null_plate)]))
    drivers, passengers = s.split_roles(parsed)
    assert (drivers.count(), passengers.count()) == (3, 3)
    drivers, passengers = s.split_roles(parsed, exclusive=True)
    assert (drivers.count(), passengers.count()) == (3, 1)
    assert [r[0] for r in s.tag_role(parsed).orderBy("ts").select("role").collect()] == [
        "driver", "passenger", "driver", "driver"]
    flat = s.flatten_roles(*s.split_roles(parsed))
    assert flat.count() == 6 and "dropoff_location" in flat.columns


def test_messages_a_matcher_cannot_use(spark):
    no_drop = {k: v for k, v in PASSENGER.items() if k != "dropoff_location"}
    no_offer = {**DRIVER, "ride_offer": None}
    parsed = parse(spark, *[json.dumps(m) for m in (DRIVER, no_offer, PASSENGER, no_drop)])
    assert reasons(s.check_for_match(parsed)) == [None, "no_offer", None, "bad_dropoff"]
    nan = json.dumps(DRIVER).replace("1.48", "NaN")
    assert reasons(s.check_for_match(parse(spark, nan))) == ["no_offer"]
    assert reasons(s.check_for_match(parsed, priced=False)) == [None, None, None, "bad_dropoff"]


def test_republished_text_is_unchanged(spark):
    odd = '{"plate_id":  "AB12", "colour": "red", "location": [1, 2]}'
    parsed = parse(spark, odd, "{", '{"other": 1}', json.dumps({**DRIVER, "seats": "x"}))
    assert {r[0] for r in records.republished(parsed).collect()} == {
        odd, '{"other": 1}', json.dumps({**DRIVER, "seats": "x"})}


def test_points_and_positions(spark):
    raw = spark.createDataFrame([('{"lon": -0.32, "lat": 39.45}',), ("{",), ('{"lat": 1.0}',)], "value string")
    assert [tuple(r) for r in s.parse_points(raw).collect()] == [(-0.32, 39.45)]
    parsed = s.accepted(parse(spark, json.dumps(DRIVER)))
    row = s.message_positions(parsed).first()
    assert (row["first"], row["second"]) == (-0.34471, 39.45879)
    keyed = records.keyed_points(s.parse_points(raw)).first()
    assert (keyed["key"], json.loads(keyed["value"])) == ("0", {"lon": -0.32, "lat": 39.45})


def test_table_rows(spark):
    parsed = s.accepted(parse(spark, json.dumps(DRIVER), json.dumps(PASSENGER), json.dumps({**PASSENGER, "ride_offer": 1.0})))
    drivers, passengers = s.split_roles(parsed)
    assert tuple(records.driver_rows(drivers).first()) == ("AB12", 5, 0)
    aboard = drivers.withColumn("passengers", F.lit(2))
    assert records.driver_rows(aboard).first()["passengers"] == 2
    rows = records.passenger_rows(passengers)
    assert rows.count() == 2
    assert rows.first()["location"].asDict() == {"longitude": 39.45879, "latitude": -0.34471}
    once = records.passenger_rows(passengers, dedupe=True).collect()
    assert len(once) == 1 and once[0]["ride_offer"] == 2.55
    later = drivers.withColumns({"seats": F.lit(1), "ts": F.col("ts") + F.expr("interval 1 minute")})
    for both in (later.union(drivers), drivers.union(later).repartition(3)):
        assert [tuple(r) for r in records.driver_rows(both, dedupe=True).collect()] == [("AB12", 5, 0)]
    text = records.to_json_messages(drivers.select(*s.DRIVER_FIELDS), F.col("plate_id")).first()
    assert text["key"] == "AB12" and json.loads(text["value"]) == DRIVER


def test_boarding(spark):
    car = {"location": [0.0, 0.0]}
    rows = [(car, {"location": [0.0005, 0.0]}, 2), (car, {"location": [0.0005, 0.0]}, None),
            (car, {"location": [0.001, 0.0]}, 3), (car, {"location": [0.001, 0.0]}, None)]
    place = "struct<location: array<double>>"
    frame = spark.createDataFrame(rows, f"car {place}, passenger {place}, seats int")
    assert [(r["boarded"], r["seats"]) for r in records.board(frame).collect()] == [
        (True, 3), (True, 1), (False, 3), (False, None)]


def test_message_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps(DRIVER) + "\n" + json.dumps(PASSENGER) + "\nbroken\n")
    raw = s.text_messages(spark, str(tmp_path))
    parsed = s.parse_messages(raw)
    assert s.accepted(parsed).count() == 2 and s.rejected(parsed).where(F.col("ts").isNotNull()).count() == 1
