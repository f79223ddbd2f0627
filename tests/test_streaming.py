from __future__ import annotations

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from hopgrid.config import EXACT, PRICED, SplitPolicy
from hopgrid.operators import match as m
from hopgrid.operators.records import keyed_points
from hopgrid.session import work_dir
from hopgrid.sinks.tables import append_stream, append_table, send_to_files
from hopgrid.sources.messages import replay_messages
from hopgrid.streaming import match as st
from messages import DRIVER, PASSENGER, at, crowd, driver, frames, passenger

NOW = {"availableNow": True}


def feed(spark, folder, frame, parts=3):
    """Write the messages as several files in time order, so that they arrive in several batches."""
    frame = frame.orderBy("ts")
    frame.coalesce(1).write.option("maxRecordsPerFile", max(1, frame.count() // parts)).mode("append").parquet(folder)
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("matcher, cfg", [
    ("priced", PRICED), ("unpriced", PRICED), ("exact", EXACT), ("bare", EXACT), ("tolerance", EXACT),
    ("priced", dataclasses.replace(PRICED, stream_parts=3))])
def test_stream_equals_batch(spark, tmp_path, matcher, cfg):
    cfg = dataclasses.replace(cfg, lateness="5 minutes")
    drivers, passengers = frames(spark, *crowd(8, 120, 6))
    streams = [feed(spark, str(tmp_path / n), f) for n, f in (("d", drivers), ("p", passengers))]
    trips = st.match_stream(*streams, cfg, matcher, ["event_id"])
    columns = [*st.MATCHERS[matcher][1], "driver_event_id", "passenger_event_id"]
    append_stream(trips, str(tmp_path / "out"), str(tmp_path / "cp"), tuple(columns), trigger=NOW).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("trip_id")
    want = st.MATCHERS[matcher][0](drivers, passengers, cfg, carry=["event_id"]).select(got.columns)
    assert got.count() > 0
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_stream_cuts_known_crowded_bins(spark, tmp_path):
    cfg = dataclasses.replace(PRICED, lateness="5 minutes", split=SplitPolicy(block_rows=8, sample_fraction=1.0))
    drivers, passengers = frames(spark, *crowd(8, 300, 6))
    m.crowded_bins(drivers, passengers, cfg).write.parquet(str(tmp_path / "bins"))
    cut = dataclasses.replace(cfg, crowded=spark.read.parquet(str(tmp_path / "bins")))
    streams = [feed(spark, str(tmp_path / name), frame, 3) for name, frame in (("d", drivers), ("p", passengers))]
    trips = st.match_stream(*streams, cut, "priced", ["event_id"])
    ids = ["driver_event_id", "passenger_event_id"]
    append_stream(trips, str(tmp_path / "t"), str(tmp_path / "cp"), tuple(ids), trigger=NOW).awaitTermination()
    stored = sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).select(*ids).collect()))
    batch = m.match_priced(drivers, passengers, cfg, carry=["event_id"]).select(*ids)
    assert stored == sorted(map(tuple, batch.collect())) and stored


def test_late_messages_are_discarded(spark, tmp_path):
    """A driver that arrives long after its window was closed finds no partner."""
    def write(name, kind, n, rows):
        folder = tmp_path / name
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(folder / f"part={n}"))
    here = (-0.37, 39.47)
    for name, kind, make in (("d", DRIVER, driver), ("p", PASSENGER, passenger)):
        write(name, kind, 0, [make(1, 1, *here)])
        for n, second in ((1, 100), (2, 200), (3, 300)):
            write(name, kind, n, [make(10 + n, second, *here)])
    write("d", DRIVER, 4, [driver(99, 2, *here), driver(50, 301, *here)])
    write("p", PASSENGER, 4, [passenger(60, 301, *here)])

    def stream(name, kind):
        return (spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
                .select(*[c.split(" ")[0] for c in kind.split(", ")]))
    trips = st.match_stream(stream("d", DRIVER), stream("p", PASSENGER), PRICED, "priced", ["event_id"])
    query = (trips.writeStream.format("memory").queryName("late").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start())
    query.awaitTermination()
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    rows = {(r[0], r[1]) for r in spark.table("late").select("driver_event_id", "passenger_event_id").collect()}
    assert (1, 1) in rows and (50, 60) in rows and (11, 11) in rows
    assert not any(d == 99 for d, _ in rows) and dropped >= 1


def test_raw_messages_to_trips_and_republish(spark, tmp_path):
    here = [-0.37, 39.47]
    car = {"plate_id": "1234ABC", "seats": 4, "full_tariff": 4.0, "ride_offer": 1.0, "location": here}
    person = {"passenger_id": "12345678A", "pick_location": [], "location": here, "ride_offer": 2.0,
              "dropoff_location": [-0.3, 39.5]}
    values = [json.dumps(car), json.dumps(person), "broken", json.dumps({"location": here}), json.dumps(person)]
    raw = spark.createDataFrame([(v, at(i)) for i, v in enumerate(values)], "value string, ts timestamp")
    raw.write.parquet(str(tmp_path / "raw"))
    trips = st.match_messages(replay_messages(spark, str(tmp_path / "raw"), streaming=True))
    st.start_match(trips, str(tmp_path / "trips"), str(tmp_path / "cp1"), trigger=NOW).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "trips"))
    assert tuple(table.columns) == m.TRIP_COLUMNS and table.count() == 2
    st.start_republish(replay_messages(spark, str(tmp_path / "raw"), streaming=True), str(tmp_path / "map"),
                       str(tmp_path / "cp2"), NOW).awaitTermination()
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "map")).collect()) == sorted(
        v for v in values if v != "broken")


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    drivers, passengers = frames(spark, [driver(1, 1, 0.5, 39.5)], [passenger(2, 2, 0.5, 39.5)])
    for run in (1, 2):
        streams = [feed(spark, str(tmp_path / n), f, 1) for n, f in (("d", drivers), ("p", passengers))]
        st.start_match(st.match_stream(*streams), str(tmp_path / "out"), str(tmp_path / "cp"), trigger=NOW
                       ).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == run ** 2


def test_latest_stream(spark, tmp_path):
    rows = [("a", 1.0, 1.0, at(1)), ("a", 2.0, 2.0, at(3)), ("b", 5.0, 5.0, at(2)), ("a", 3.0, 3.0, at(2))]
    frame = spark.createDataFrame(rows, "id string, lon double, lat double, ts timestamp")
    stream = feed(spark, str(tmp_path / "pos"), frame, 4)
    (st.latest_stream(stream).writeStream.outputMode("complete").format("memory").queryName("latest")
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start().awaitTermination())
    assert sorted((r["id"], r["lon"]) for r in spark.table("latest").collect()) == [("a", 2.0), ("b", 5.0)]


def test_batch_sinks(spark, tmp_path):
    trips = m.match_priced(*frames(spark, [driver(1, 1, 0.5, 39.5)], [passenger(2, 2, 0.5, 39.5)]))
    for _ in range(2):
        append_table(trips.withColumn("day", F.lit("2024-01-01")), str(tmp_path / "t"), m.UNPRICED_COLUMNS, ("day",))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 2 and table.columns == [*m.UNPRICED_COLUMNS, "day"]
    points = spark.createDataFrame([(1.0, 2.0)], "lon double, lat double")
    assert send_to_files(keyed_points(points), str(tmp_path / "k")) is None
    assert json.loads(spark.read.text(str(tmp_path / "k")).first()[0]) == {"lon": 1.0, "lat": 2.0}


def test_work_dir_is_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one.startswith(f"{base}/x-") and one != two


def test_crowded_streams_keep_packs(spark, tmp_path):
    """The state of a join on crowded keys has a row per pack, not per message, and goes with its window; no pair is lost."""
    cfg = dataclasses.replace(PRICED, stream_parts=2)
    drivers, passengers = [[kind(n, n % 10, -0.5, 39.6, 1.5) for n in range(400)] for kind in (driver, passenger)]
    end = (400, 600, -0.1, 39.1)
    late = (401, 3, -0.5, 39.6, 1.5)
    streams, sides = [], []
    for name, kind, rows, schema in (("d", driver, drivers, DRIVER), ("p", passenger, passengers, PASSENGER)):
        for n, part in enumerate((rows, [kind(*end)], [kind(410, 700, -0.1, 39.1)], [kind(*late)])):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / name / f"part={n}"))
        sides.append(spark.createDataFrame([*rows, kind(*end), kind(410, 700, -0.1, 39.1)], schema))
        streams.append(spark.readStream.schema(sides[-1].schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
                       .select(*sides[-1].columns))
    trips = st.match_stream(*streams, cfg, "priced", ["event_id"])
    ids = ["driver_event_id", "passenger_event_id"]
    query = append_stream(trips, str(tmp_path / "t"), str(tmp_path / "cp"), tuple(ids), trigger=NOW)
    query.awaitTermination()
    stored = sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).select(*ids).collect()))
    assert stored == sorted(map(tuple, m.match_priced(*sides, PRICED, carry=["event_id"]).select(*ids).collect())) and len(stored) == 160_002
    rows = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(rows) <= 3 * 8 and rows[-1] < max(rows)


def test_late_steps_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """No step of the late stream passes through one task; nothing late finds a partner."""
    from hopgrid.plans import events, matching
    rows = spark.range(0, 400, 1, 4).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", "id % 3 AS user_id",
        "element_at(array('click', 'purchase'), cast(id % 2 AS int) + 1) AS event_type", "1.0D AS value", "'' AS props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(matching, "work_dir", lambda spark, purpose: str(tmp_path / purpose))
    found = sorted(map(tuple, matching.stream_late_discarded(spark, str(tmp_path)).select(*matching.IDS).collect()))
    trips = m.match_priced(*events.messages(spark, str(tmp_path)), carry=["event_id"])
    assert found == sorted(map(tuple, trips.select(*matching.IDS).collect())) and found
    for side in (0, 1):
        assert len(list((tmp_path / "late" / f"arriving-{side}" / "part=00").glob("part-*.parquet"))) == 4
        assert len(list((tmp_path / "late" / f"arriving-{side}" / "part=20").glob("part-*.parquet"))) == 4
