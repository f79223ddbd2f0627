"""Registered queries: routes, tariffs, requests, trajectories and positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hopgrid.functions import pricing
from hopgrid.operators import records, routes
from hopgrid.plans import events as e
from hopgrid.session import rename_files, work_dir
from hopgrid.sources import routes as route_files
from hopgrid.streaming.match import latest_stream

PICK_SEED = 7


def route_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.segments(e.course_points(spark, sf_dir)).withColumn("segment_km", F.round("segment_km", 6))


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = routes.route_lengths(e.course_points(spark, sf_dir))
    return lengths.withColumn("length_km", pricing.round_money(F.col("length_km")))


def driver_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One driver per event, on the course of that event's user."""
    drivers = e.read_events(spark, sf_dir).where(F.col("event_type").isin(*e.DRIVER_TYPES)).select(
        "event_id", e.plate_id().alias("plate_id"), e.seats().alias("seats"), F.col("user_id").alias("route"))
    offers = routes.driver_offers(drivers, _lengths(spark, sf_dir))
    return offers.withColumn("full_tariff", pricing.round_money(F.col("full_tariff")))


def route_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(routes.route_requests(e.course_points(spark, sf_dir), PICK_SEED))


def passenger_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    passengers = e.read_events(spark, sf_dir).where(F.col("event_type").isin(*e.PASSENGER_TYPES)).select(
        "event_id", e.passenger_id().alias("passenger_id"), e.ride_offer().alias("ride_offer"),
        F.col("user_id").alias("route"))
    requests = routes.passenger_requests(passengers, e.course_points(spark, sf_dir), PICK_SEED)
    return _flat(requests).withColumn("pick_points", F.size("pick_location")).drop("pick_location")


def _flat(requests: DataFrame) -> DataFrame:
    named = {f"{short}_{i}": F.get(name, F.lit(i)) for short, name in
             (("at", "location"), ("drop", "dropoff_location")) for i in (0, 1)}
    return requests.withColumns(named).drop("location", "dropoff_location")


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a driver whose course is its line items."""
    # The order date has no zone; built from its parts it reads as UTC in any session.
    date = F.col("o_orderdate")
    seconds = (F.unix_date(date.cast("date")).cast("bigint") * 86400
               + F.hour(date) * 3600 + F.minute(date) * 60 + F.second(date))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("route"), F.col("o_custkey").alias("driver"),
        F.timestamp_seconds(seconds).alias("start"))
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("route"), F.col("l_linenumber").alias("idx"),
        (F.lit(-0.37) - (F.col("l_partkey") % 997) * F.lit(0.00005)).alias("lon"),
        (F.lit(39.47) + (F.col("l_suppkey") % 613) * F.lit(0.00003)).alias("lat"))
    moves = routes.trajectories(orders, items, F.col("start"))
    return moves.select("route", "driver", "idx", F.get("location", F.lit(0)).alias("lon"),
                        F.get("location", F.lit(1)).alias("lat"), F.unix_seconds("ts").alias("at"))


def bounding_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.bounding_box(e.course_points(spark, sf_dir), ["route"])


def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.bounding_box(e.course_points(spark, sf_dir))


def corner_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    to_0, to_1 = e.dropoff()
    corners = [(e.lon(), e.lat()), (to_0, to_1), (e.lon(), to_1 + 0.25), (to_0 - 0.25, e.lat())]
    return e.read_events(spark, sf_dir).select("event_id", *[
        box.alias(name) for name, box in routes.corner_box(*corners).items()])


def kml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A route file per document, with a point for each word of the whole text and a later pin."""
    doc = F.col("doc_id")
    words = F.split(F.coalesce("text", F.lit("")), " ")
    tokens = F.transform(words, lambda word, i: F.concat_ws(
        ",", (F.lit(-0.37) - (doc % 97) * F.lit(0.0001) - F.length(word) * F.lit(0.00005)).cast("string"),
        (F.lit(39.47) + i * F.lit(0.00003)).cast("string"), F.lit("0")))
    content = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><Document>'
              "<Placemark><LineString><coordinates>\n   "),
        F.array_join(tokens, "\n   "),
        F.lit("\n  </coordinates></LineString></Placemark>"
              "<Placemark><Point><coordinates>1,2,3</coordinates></Point></Placemark></Document></kml>"))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(doc.alias("route"), content.alias("content"))


def _kml_folder(spark: SparkSession, sf_dir: str, between: str) -> str:
    """Files of events, a thousand to a file: those of even thousands are named .kml, the others .txt, in one folder."""
    event, folder = F.col("event_id"), work_dir(spark, "kml-files")
    point = F.concat_ws(",", (F.lit(-0.37) - (event % 997) * F.lit(0.00005)).cast("string"),
                        (F.lit(39.47) + (event % 613) * F.lit(0.00003)).cast("string"), F.lit("0"))
    block = F.floor(event / 1000)
    points = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(event.alias("n"), point.alias("p")))), lambda x: x["p"]), between)
    texts = e.read_events(spark, sf_dir).groupBy(block.alias("block")).agg(F.concat(
        F.lit("<kml><Placemark><LineString><coordinates>"), points, F.lit("</coordinates></LineString></Placemark></kml>")).alias("text"))
    for name, rest in (("kml", 0), ("txt", 1)):
        texts.where(F.col("block") % 2 == rest).select("text").write.option("maxRecordsPerFile", 1).text(f"{folder}/{name}")
    rename_files(spark, f"{folder}/kml", "part-*.txt", f"{folder}/txt", ".kml")
    return f"{folder}/txt"


def kml_files_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_files.course_points(route_files.read_route_files(spark, _kml_folder(spark, sf_dir, " "))).drop("route")


def kml_files_scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files with a point to a line, read in splits."""
    return route_files.scan_course_points(spark, _kml_folder(spark, sf_dir, "\n")).drop("route")


def kml_course_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_files.course_points(kml_documents(spark, sf_dir))


def kml_document_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = route_files.document_points(kml_documents(spark, sf_dir))
    return points.select("route", "idx", *[
        F.get("point", F.lit(i)).alias(name) for i, name in enumerate(("lon", "lat", "altitude"))])


def _text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents, and one line of coordinates per event in its user's file."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("file"),
        F.explode(F.split("text", "\n")).alias("line"))
    return documents.unionByName(_track_lines(spark, sf_dir))


def _track_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e.read_events(spark, sf_dir).select(
        F.concat(F.lit("track-"), F.col("user_id").cast("string")).alias("file"),
        F.when(F.col("event_type") == "error", F.lit("<name>x, y</name>"))
        .otherwise(F.concat_ws(",", e.lon().cast("string"), e.lat().cast("string"), F.lit("0"))).alias("line"))


def coordinate_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the tracks as text files, read back whole."""
    path = work_dir(spark, "coordinates")
    _track_lines(spark, sf_dir).select("line").write.text(path)
    lines = route_files.read_coordinate_text(spark, path)
    return route_files.coordinate_lines(lines).select("first", "second", "valid")


def coordinate_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.coordinate_payment(_text_lines(spark, sf_dir))


def coordinate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_files.coordinate_lines(_text_lines(spark, sf_dir)).select("file", "first", "second", "valid")


def latest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.latest_positions(_positions(e.read_events(spark, sf_dir)), "id", ("at",))


def latest_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.latest_positions(_positions(e.read_events(spark, sf_dir)), None, ("at",))


def _positions(events: DataFrame) -> DataFrame:
    """Every car moves with each of its events, which come out of order: ``at`` runs backwards in stretches."""
    event = F.col("event_id")
    return events.where(F.col("event_type").isin(*e.DRIVER_TYPES)).select(
        e.plate_id().alias("id"), (e.lon() - (event % 997) * F.lit(0.00005)).alias("lon"),
        (e.lat() + (event % 613) * F.lit(0.00003)).alias("lat"), event.bitwiseXOR(F.lit(4095)).alias("at"))


def stream_latest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kept up to date by a stream; each update batch is appended, the newest row per car counts."""
    positions = _positions(e.read_events(spark, sf_dir, streaming=True)).withColumnRenamed("at", "ts")
    folder = work_dir(spark, "latest")
    query = (latest_stream(positions).writeStream.outputMode("update")
             .option("checkpointLocation", f"{folder}/checkpoint")
             .foreachBatch(lambda batch, _: batch.write.mode("append").parquet(f"{folder}/table"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return records.latest_positions(spark.read.parquet(f"{folder}/table"))


QUERIES = {
    "route_segments": route_segments,
    "route_lengths": _lengths,
    "driver_offers": driver_offers,
    "route_requests": route_requests,
    "passenger_requests": passenger_requests,
    "trajectories": trajectories,
    "bounding_boxes": bounding_boxes,
    "bounding_box": bounding_box,
    "corner_boxes": corner_boxes,
    "kml_files_selected": kml_files_selected,
    "kml_files_scanned": kml_files_scanned,
    "kml_course_points": kml_course_points,
    "kml_document_points": kml_document_points,
    "coordinate_payment": coordinate_payment,
    "coordinate_lines": coordinate_lines,
    "coordinate_files_read": coordinate_files_read,
    "latest_positions": latest_positions,
    "latest_position": latest_position,
    "stream_latest_positions": stream_latest_positions,
}

_KM = e.haversine_sql("lon", "lat", "next_lon", "next_lat")
_LENGTHS = f"""WITH {e.COURSE_SQL},
len AS (SELECT route, count(*) AS points, {e.money_sql(f'coalesce(sum({_KM}), 0)')} AS length_km
        FROM seg GROUP BY route)"""
_ENDS = f"""picks AS (
  SELECT route, arg_min(lon, k) AS at_0, arg_min(lat, k) AS at_1, arg_max(lon, idx) AS drop_0,
         arg_max(lat, idx) AS drop_1
  FROM (SELECT *, md5('{PICK_SEED}:' || route::varchar || ':' || idx::varchar)[1:15] AS k FROM pts) GROUP BY route)"""
_KML = """FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i
      FROM (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS words FROM documents))"""
_KML_POINT = """-0.37::double - (doc_id % 97) * 0.0001::double - length(word) * 0.00005::double AS lon,
       39.47::double + i * 0.00003::double AS lat"""
_NUMBER = r"'\s*[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?\s*'"


def _number_sql(part: int) -> str:
    text = f"string_split(line, ',')[{part}]"
    return f"CASE WHEN regexp_full_match({text}, {_NUMBER}) THEN try_cast(trim({text}) AS double) END"


_LINES = f"""WITH {e.EVENT_SQL},
lines AS (
  SELECT 'doc-' || doc_id::varchar AS file, unnest(string_split(text, chr(10))) AS line FROM documents
  UNION ALL
  SELECT 'track-' || user_id::varchar, CASE WHEN event_type = 'error' THEN '<name>x, y</name>'
         ELSE lon::varchar || ',' || lat::varchar || ',0' END FROM ev),
checked AS (
  SELECT file, contains(line, ',') AND NOT contains(line, 'name') AS wanted,
         {_number_sql(1)} AS first, {_number_sql(2)} AS second FROM lines),
judged AS (SELECT *, first IS NOT NULL AND second IS NOT NULL AS valid FROM checked)"""
_MOVED = f"""WITH {e.EVENT_SQL},
moved AS (SELECT plate_id AS id, lon - (event_id % 997) * 0.00005::double AS lon,
                 lat + (event_id % 613) * 0.00003::double AS lat, xor(event_id, 4095) AS stamp FROM d)
SELECT arg_max(lon, stamp) AS lon, arg_max(lat, stamp) AS lat"""

_FILES_SQL = """SELECT cast(row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1 AS integer) AS idx,
       -0.37::double - (event_id % 997) * 0.00005::double AS lon, 39.47::double + (event_id % 613) * 0.00003::double AS lat
FROM events WHERE event_id // 1000 % 2 = 0"""

ORACLES = {
    "route_segments": f"""WITH {e.COURSE_SQL}
SELECT route, idx, lon, lat, next_lon, next_lat, round({_KM}, 6) AS segment_km FROM seg WHERE next_lon IS NOT NULL""",
    "route_lengths": _LENGTHS + " SELECT * FROM len",
    "driver_offers": _LENGTHS + f""", {e.EVENT_SQL}
SELECT event_id, plate_id, seats, route, {e.money_sql('length_km * 1.5::double')} AS full_tariff,
       {e.money_sql('length_km * 1.5::double / seats::double')} AS ride_offer
FROM d JOIN len ON len.route = d.user_id""",
    "route_requests": f"WITH {e.COURSE_SQL}, {_ENDS} SELECT * FROM picks",
    "passenger_requests": f"""WITH {e.COURSE_SQL}, {_ENDS}, {e.EVENT_SQL}
SELECT event_id, passenger_id, offer AS ride_offer, picks.*, cast(0 AS integer) AS pick_points
FROM p JOIN picks ON picks.route = p.user_id""",
    "trajectories": """SELECT o_orderkey AS route, o_custkey AS driver, l_linenumber AS idx,
       -0.37::double - (l_partkey % 997) * 0.00005::double AS lon,
       39.47::double + (l_suppkey % 613) * 0.00003::double AS lat,
       cast(epoch(o_orderdate) AS bigint) + l_linenumber * 5 AS at
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "bounding_boxes": f"""WITH {e.COURSE_SQL} SELECT route, min(lon) AS min_lon, max(lon) AS max_lon,
       min(lat) AS min_lat, max(lat) AS max_lat FROM pts GROUP BY route""",
    "bounding_box": f"""WITH {e.COURSE_SQL} SELECT min(lon) AS min_lon, max(lon) AS max_lon,
       min(lat) AS min_lat, max(lat) AS max_lat FROM pts""",
    "corner_boxes": f"""WITH {e.EVENT_SQL}
SELECT event_id, least(lon, drop_0, drop_0 - 0.25::double) AS min_0,
       greatest(lon, drop_0, drop_0 - 0.25::double) AS max_0,
       least(lat, drop_1, drop_1 + 0.25::double) AS min_1,
       greatest(lat, drop_1, drop_1 + 0.25::double) AS max_1 FROM ev2""",
    "kml_files_selected": _FILES_SQL,
    "kml_files_scanned": _FILES_SQL,
    "kml_course_points": f"SELECT doc_id AS route, cast(i AS integer) AS idx, {_KML_POINT} {_KML}",
    "kml_document_points": f"""SELECT doc_id AS route, cast(i AS integer) AS idx, {_KML_POINT},
       0.0::double AS altitude {_KML}""",
    "coordinate_payment": _LINES + f"""
SELECT file, count(*) FILTER (WHERE wanted AND valid) AS valid_lines,
       count(*) FILTER (WHERE wanted AND NOT valid) AS invalid_lines,
       {e.money_sql('0.10::double * count(*) FILTER (WHERE wanted AND valid)')} AS payment
FROM judged GROUP BY file""",
    "coordinate_lines": _LINES + " SELECT file, first, second, valid FROM judged WHERE wanted",
    "coordinate_files_read": f"""WITH {e.EVENT_SQL}
SELECT lon AS first, lat AS second, true AS valid FROM ev WHERE event_type <> 'error'""",
    "latest_positions": _MOVED + ", max(stamp) AS at, id FROM moved GROUP BY id",
    "latest_position": _MOVED + ", max(stamp) AS at FROM moved",
    "stream_latest_positions": _MOVED + ", max(stamp) AS ts, id FROM moved GROUP BY id",
}
