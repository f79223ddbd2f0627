from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from hopgrid.config import SplitPolicy
from hopgrid.operators import records, routes
from hopgrid.sources import routes as files

KML = """<?xml version="1.0" encoding="UTF-8"?>
<kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>a route, drawn</name>{first}
<Placemark><name>line</name><LineString><coordinates>
   -0.34471,39.45879,0
   -0.34480,39.45890,7.5
\t-0.34500,39.45900,0
</coordinates></LineString></Placemark></Document></kml>"""
PIN = "<Folder><Placemark><Point><coordinates>-0.1,39.1,3</coordinates></Point></Placemark></Folder>"


def km(a, b):
    lon_a, lat_a, lon_b, lat_b = map(math.radians, (*a, *b))
    h = math.sin((lat_b - lat_a) / 2) ** 2 + math.cos(lat_a) * math.cos(lat_b) * math.sin((lon_b - lon_a) / 2) ** 2
    return 6371 * 2 * math.asin(math.sqrt(h))


@pytest.fixture
def folder(tmp_path):
    for name in ("plain.kml", "copy (1) +x.kml"):
        (tmp_path / name).write_text(KML.format(first=""))
    (tmp_path / "pinned.kml").write_text(KML.format(first=PIN))
    (tmp_path / "other.nokml").write_text(KML.format(first=""))
    (tmp_path / "bare").write_text(KML.format(first=""))
    return str(tmp_path)


def route_text(rng: random.Random, points: int, odd: str = "") -> str:
    """A document whose first placemark may lack a route, and whose lines are cut anywhere between points."""
    track = "".join(f"{rng.uniform(-1, 1):.6f},{rng.uniform(39, 40):.6f},0" + rng.choice([" ", "\n", "\r\n", "\n\t "])
                    for _ in range(points))
    body = rng.choice(["<LineString>{}</LineString>", "<x:MultiGeometry>\n<x:LineString>{}</x:LineString></x:MultiGeometry>"])
    tag = rng.choice(["coordinates", "x:coordinates"])
    mark = f"<Placemark\n id='1'><name>a, b</name>{body.format(f'<{tag}>{track}</{tag}>')}</Placemark>"
    pins = "<Placemark><Point><coordinates>7,8,9</coordinates></Point></Placemark>"
    first = rng.choice(["", "<coordinates>5,5,5</coordinates>", "<Folder/>\n", "<Placemarks><coordinates/></Placemarks>"])
    return f"<kml xmlns:x='u'><Document>{first}{odd}{mark}\n{pins}</Document></kml>"


def test_files_read_in_splits_give_the_points_of_whole_documents(spark, tmp_path):
    rng = random.Random(5)
    texts = {f"r{i} +.kml": route_text(rng, rng.choice([0, 1, 30, 400])) for i in range(12)}
    texts |= {"long.kml": route_text(rng, 3000), "none.kml": "<kml/>", "empty.kml": "",
              "bare.kml": "<kml><Placemark/><Placemark><coordinates>1,2</coordinates></Placemark></kml>",
              "closed.kml": "<kml><Placemark><coordinates/></Placemark><Placemark><coordinates>1,2</coordinates></Placemark></kml>",
              "comment.kml": route_text(rng, 50, "<!-- <Placemark><coordinates>0,0\n</coordinates></Placemark> -->"),
              "cdata.kml": route_text(rng, 50, "<description><![CDATA[<Placemark>]]></description>"),
              "words.kml": "<kml><Placemark><coordinates>\none,two 1d,2f\n3,4</coordinates></Placemark></kml>", "skipped.txt": route_text(rng, 5)}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    rows = lambda frame: sorted((tuple(r) for r in frame.collect()), key=repr)
    whole = rows(files.course_points(files.read_route_files(spark, str(tmp_path)).where("content <> ''")))
    sizes = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in sizes}
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        scanned = rows(files.scan_course_points(spark, str(tmp_path)))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(whole) > 3000 and scanned == whole
    none = tmp_path / "sub"
    none.mkdir()
    with pytest.raises(FileNotFoundError):
        files.scan_course_points(spark, str(none))


def test_route_files(spark, folder, tmp_path_factory):
    documents = files.read_route_files(spark, folder)
    points = files.course_points(documents)
    by_route = {r["route"]: r["n"] for r in points.groupBy("route").agg(F.count("idx").alias("n")).collect()}
    assert by_route == {"plain.kml": 3, "copy (1) +x.kml": 3, "pinned.kml": 1}
    plain = points.where("route = 'plain.kml'").orderBy("idx").collect()
    assert [tuple(r)[1:] for r in plain] == [(0, -0.34471, 39.45879), (1, -0.3448, 39.4589), (2, -0.345, 39.459)]
    anywhere = files.document_points(documents)
    assert anywhere.where("route = 'pinned.kml'").first()["point"] == [-0.1, 39.1, 3.0]
    none = spark.createDataFrame([("x", "<kml/>")], "route string, content string")
    assert tuple(files.document_points(none).first()) == ("x", None, None)
    lengths = {r["route"]: r["length_km"] for r in routes.route_lengths(points).collect()}
    assert lengths["pinned.kml"] == 0.0
    track = [(-0.34471, 39.45879), (-0.3448, 39.4589), (-0.345, 39.459)]
    assert lengths["plain.kml"] == pytest.approx(km(*track[:2]) + km(*track[1:]))
    with pytest.raises(FileNotFoundError):
        files.read_route_files(spark, str(tmp_path_factory.mktemp("empty")))


@pytest.mark.parametrize("spacing", [1, 7, 100_003, 1 << 45])
def test_segments_of_sparse_and_dense_routes(spark, spacing):
    rows = [(r, (i - 20) * spacing + (i * i % 5 if spacing > 5 else 0), float(i % 11), float(i)) for r in (1, 2) for i in range(50) if (i * r) % 9]
    points = spark.createDataFrame(rows, "route long, idx long, lon double, lat double")
    expected = sorted((a[0], a[1], b[2], b[3]) for a, b in zip(sorted(rows), sorted(rows)[1:]) if a[0] == b[0])
    for stretch in (4, routes.STRETCH):
        found = sorted(tuple(r) for r in routes.segments(points, stretch).select("route", "idx", "next_lon", "next_lat").collect())
        assert found == expected


@pytest.mark.parametrize("stretch", [None, 1, 3, 10, 100_000])
def test_segments_do_not_depend_on_the_stretch(spark, stretch):
    rng = random.Random(2)
    tracks = {"long": 200, "short": 2, "single": 1}
    rows, expected = [], {}
    for route, n in tracks.items():
        idx = sorted(rng.sample(range(1000), n))
        points = [(rng.uniform(-1, 1), rng.uniform(39, 40)) for _ in idx]
        rows += [(route, i, *p) for i, p in zip(idx, points)]
        expected[route] = (n, math.fsum(km(a, b) for a, b in zip(points, points[1:])))
    rng.shuffle(rows)
    points = spark.createDataFrame(rows, "route string, idx bigint, lon double, lat double")
    assert routes.segments(points, stretch).count() == 200
    lengths = {r["route"]: (r["points"], r["length_km"]) for r in routes.route_lengths(points, stretch).collect()}
    assert {k: v[0] for k, v in lengths.items()} == {k: v[0] for k, v in expected.items()}
    for route in tracks:
        assert lengths[route][1] == pytest.approx(expected[route][1])


def test_offers_and_requests(spark):
    points = spark.createDataFrame([("r", i, float(i), 39.0) for i in range(50)] + [("s", 0, 5.0, 40.0)],
                                   "route string, idx int, lon double, lat double")
    lengths = spark.createDataFrame([("r", 4.931), ("s", 0.0)], "route string, length_km double")
    drivers = spark.createDataFrame([("A", n, "r") for n in (4, 5, 6)] + [("B", 4, "s")],
                                    "plate_id string, seats int, route string")
    offers = {(r["plate_id"], r["seats"]): r["ride_offer"] for r in routes.driver_offers(drivers, lengths).collect()}
    assert offers == {("A", 4): 1.85, ("A", 5): 1.48, ("A", 6): 1.23, ("B", 4): 0.0}
    one, same, other = (
        {r["route"]: r for r in routes.route_requests(points, seed).collect()} for seed in (1, 1, 2))
    assert one == same and one["r"]["location"] != other["r"]["location"]
    assert one["r"]["dropoff_location"] == [49.0, 39.0] and one["s"]["location"] == [5.0, 40.0]
    passengers = spark.createDataFrame([("p", 2.0, "r"), ("q", 2.0, "s")],
                                       "passenger_id string, ride_offer double, route string")
    asked = {r["passenger_id"]: r for r in routes.passenger_requests(passengers, points, 1).collect()}
    assert asked["p"]["location"] == one["r"]["location"] and asked["p"]["pick_location"] == []


def test_trajectories(spark):
    points = spark.createDataFrame([("r", i, float(i), 39.0) for i in range(30)] + [("s", 0, 5.0, 40.0)],
                                   "route string, idx int, lon double, lat double")
    drivers = spark.createDataFrame([(f"d{i}", "r") for i in range(20)] + [("e", "s")], "plate_id string, route string")
    start = F.lit("2024-01-01").cast("timestamp")
    for policy in (SplitPolicy(enabled=False), SplitPolicy(block_rows=4, sample_fraction=1.0)):
        moves = routes.trajectories(drivers, points, start, 5, policy)
        assert moves.count() == moves.distinct().count() == 601
        one = moves.where("plate_id = 'd3'").orderBy("ts").collect()
        assert [r["location"][0] for r in one] == [float(i) for i in range(30)]
        assert (one[-1]["ts"] - one[0]["ts"]).total_seconds() == 145


def test_boxes(spark):
    points = spark.createDataFrame([("a", 1.0, 2.0), ("a", -1.0, 5.0), ("b", 0.0, 0.0)], "g string, lon double, lat double")
    assert tuple(routes.bounding_box(points).first()) == (-1.0, 1.0, 0.0, 5.0)
    assert routes.bounding_box(points, ["g"]).where("g = 'a'").first()["min_lat"] == 2.0
    corners = [(F.lit(x), F.lit(y)) for x, y in ((41.5, 2.25), (41.25, 2.75),
                                                 (40.75, 2.0), (41.0, 2.5))]
    row = spark.range(1).select(*[c.alias(n) for n, c in routes.corner_box(*corners).items()]).first()
    assert tuple(row) == (40.75, 41.5, 2.0, 2.75)


def test_coordinate_payment(spark, tmp_path):
    (tmp_path / "track.txt").write_text(
        "<name>a, b</name>\n-0.1,39.1,0\n 1e2 , 5 \nno comma\n1d,2\n5,\n1,2,3,4\n")
    (tmp_path / "empty.txt").write_text("nothing here\n")
    lines = files.read_coordinate_text(spark, str(tmp_path))
    paid = {r["file"]: (r["valid_lines"], r["invalid_lines"], r["payment"])
            for r in records.coordinate_payment(lines).collect()}
    assert paid == {"track.txt": (3, 2, 0.3), "empty.txt": (0, 0, 0.0)}
    kept = files.coordinate_lines(lines)
    assert kept.count() == 5 and kept.where("valid").count() == 3


def test_latest_positions(spark):
    rows = [("a", 1.0, 1.0, 1), ("a", 2.0, 2.0, 3), ("a", 3.0, 3.0, 2), ("b", 9.0, 9.0, 0)]
    frame = spark.createDataFrame(rows, "id string, lon double, lat double, ts int")
    assert sorted(map(tuple, records.latest_positions(frame).collect())) == [("a", 2.0, 2.0, 3), ("b", 9.0, 9.0, 0)]
    assert tuple(records.latest_positions(frame, None).first()) == (2.0, 2.0, 3)
