"""Registered queries: messages, table rows, topic records and per-row rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hopgrid.config import EXACT, PRICED
from hopgrid.functions import geo, identity, pricing
from hopgrid.operators import match as m
from hopgrid.operators import records
from hopgrid.plans import events as e
from hopgrid.session import work_dir
from hopgrid.sources import documents, messages
from hopgrid.streaming.match import start_republish


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_messages(e.raw_messages(e.read_events(spark, sf_dir)))


def _event_id() -> Column:
    return F.col("message_id").cast("bigint").alias("event_id")


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.accepted(messages.check_for_match(_parsed(spark, sf_dir)))


def drivers_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    drivers, _ = messages.split_roles(_usable(spark, sf_dir))
    return drivers.select(_event_id(), "plate_id", "seats", "full_tariff", "ride_offer",
                          F.get("location", F.lit(0)).alias("lon"), F.get("location", F.lit(1)).alias("lat"))


def passengers_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, passengers = messages.split_roles(_usable(spark, sf_dir), exclusive=True)
    return passengers.select(
        _event_id(), "passenger_id", "ride_offer", F.size("pick_location").alias("pick_points"),
        F.get("location", F.lit(0)).alias("lon"), F.get("location", F.lit(1)).alias("lat"),
        F.get("dropoff_location", F.lit(0)).alias("drop_0"), F.get("dropoff_location", F.lit(1)).alias("drop_1"))


def messages_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.rejected(_parsed(spark, sf_dir)).select(_event_id(), "reject_reason")


def messages_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.tag_role(messages.accepted(_parsed(spark, sf_dir))).select(_event_id(), "role")


def messages_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = messages.flatten_roles(*e.messages(spark, sf_dir))
    return flat.select("event_id", "plate_id", "passenger_id", "ride_offer", F.unix_seconds("ts").alias("at"),
                       F.get("dropoff_location", F.lit(0)).alias("drop_0"))


def message_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = messages.accepted(_parsed(spark, sf_dir))
    return messages.message_positions(parsed).select("plate_id", "passenger_id", "first", "second",
                                                     F.unix_seconds("ts").alias("at"))


def message_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both window lengths of each message, next to its bin."""
    flat = messages.flatten_roles(*e.messages(spark, sf_dir))
    flat = m.with_window(m.with_bins(flat, PRICED), PRICED).withColumnRenamed(m.SLOT, "long")
    flat = m.with_window(flat, EXACT).withColumnRenamed(m.SLOT, "short")
    return flat.select(
        "event_id", "bin_0", "bin_1", geo.bin_key(F.col("bin_0"), F.col("bin_1")).alias("bin_key"),
        F.unix_seconds("long").alias("window_15"), F.unix_seconds("short").alias("window_10"))


def _republished(raw: DataFrame) -> DataFrame:
    return records.republished(messages.parse_messages(raw))


def messages_republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(_republished(e.raw_messages(e.read_events(spark, sf_dir))))


def stream_republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = e.raw_messages(e.read_events(spark, sf_dir, streaming=True))
    folder = work_dir(spark, "republished")
    start_republish(raw, f"{folder}/out", f"{folder}/checkpoint", {"availableNow": True}).awaitTermination()
    return _readable(spark.read.text(f"{folder}/out"))


def _readable(values: DataFrame) -> DataFrame:
    """Each whole text and how often it was sent."""
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("texts"))


def driver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.driver_rows(e.messages(spark, sf_dir)[0])


def _flat_passengers(rows: DataFrame) -> DataFrame:
    return rows.select("passenger_id", F.col("location.longitude").alias("longitude"),
                       F.col("location.latitude").alias("latitude"), "ride_offer")


def passenger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_passengers(records.passenger_rows(e.messages(spark, sf_dir)[1]))


def passenger_rows_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_passengers(records.passenger_rows(e.messages(spark, sf_dir)[1], dedupe=True))


def driver_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    drivers = e.messages(spark, sf_dir)[0]
    return records.to_json_messages(drivers.select("plate_id", "seats", "ride_offer", "location"), F.col("plate_id"))


def passenger_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    passengers = e.messages(spark, sf_dir)[1]
    return records.to_json_messages(passengers.select("passenger_id", "ride_offer", "location", "dropoff_location"), F.col("passenger_id"))


def keyed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.keyed_points(e.read_events(spark, sf_dir).select(e.lon().alias("lon"), e.lat().alias("lat")))


def points_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_points(keyed_points(spark, sf_dir)).select("lon", "lat")


def _driver_document() -> Column:
    place = F.struct(e.lon().alias("lon"), e.lat().alias("lat"))
    return F.struct(
        e.plate_id().alias("plate_id"), F.array(F.array(e.lon(), e.lat())).alias("course"),
        e.seats().alias("seats"), F.lit(0).alias("passengers"), F.col("value").alias("trip_cost"),
        F.lit(5.0).alias("full_tariff"), F.array(place).alias("location"))


def driver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = e.read_events(spark, sf_dir).select(F.to_json(_driver_document()).alias("text"))
    return documents.driver_summary(documents.parse_documents(texts))


def driver_documents_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of many lines, a thousand events to a file, and back."""
    path = work_dir(spark, "documents")
    block = F.floor(F.col("event_id") / 1000)
    texts = e.read_events(spark, sf_dir).groupBy(block.alias("block")).agg(
        F.to_json(F.collect_list(_driver_document()), {"pretty": "true"}).alias("text"))
    texts.select("text").write.option("maxRecordsPerFile", 1).text(path)
    return documents.driver_summary(documents.read_documents(spark, path))


def seats_taken(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    near = F.array(e.lon() + F.lit(0.0001) * (event % 20), e.lat() + F.lit(0.0001) * (event % 7))
    pairs = e.read_events(spark, sf_dir).select(
        "event_id", F.struct(F.array(e.lon(), e.lat()).alias("location")).alias("car"),
        F.struct(near.alias("location")).alias("passenger"),
        F.when(event % 4 != 0, (event % 5).cast("int")).alias("seats"))
    return records.board(pairs).select("event_id", "boarded", "seats")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price rules on each event's offer and on its raw value."""
    offer, value = e.ride_offer(), F.col("value")
    return e.read_events(spark, sf_dir).select(
        "event_id", pricing.customer_cost(offer).alias("cost"), pricing.company_margin(offer).alias("margin"),
        pricing.customer_cost(value).alias("value_cost"), pricing.company_margin(value).alias("value_margin"),
        pricing.offers_compatible(F.lit(2.0), offer).alias("compatible"),
        pricing.round_money(value / 7).alias("rounded"),
        F.round(pricing.distance_fare(value), 6).alias("fare"),
        pricing.seat_offer(pricing.route_tariff(value), e.seats()).alias("seat_offer"))


def money_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounding where doubles are nearly or more than a cent apart."""
    event = F.col("event_id")
    scale = F.when(event % 3 == 0, 1.0).when(event % 3 == 1, 3.0).otherwise(200.0)
    amount = (F.lit(4.5e13) + event * F.lit(0.015625)) * scale
    return e.read_events(spark, sf_dir).select("event_id", pricing.round_money(amount).alias("rounded"))


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    to_0, to_1 = e.dropoff()
    return e.read_events(spark, sf_dir).select(
        "event_id", F.round(geo.haversine_km(e.lon(), e.lat(), to_0, to_1), 6).alias("km"),
        F.round(geo.trip_distance_km(e.lon(), e.lat(), to_0, to_1), 6).alias("trip_km"),
        F.round(geo.planar_km(e.lon(), e.lat(), to_0, to_1), 6).alias("planar_km"),
        geo.within_pickup_radius(e.lon(), e.lat(), to_0, to_1).alias("close"),
        geo.within_tolerance(e.lon(), e.lat(), to_0, to_1, PRICED.tolerance).alias("near"))


def wkt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of each position, also near the meridian, and the numbers read back from it."""
    small = (F.col("event_id") % 100) * F.lit(0.000013)
    frame = e.read_events(spark, sf_dir).select("event_id", geo.trip_wkt(small, e.lat()).alias("wkt"))
    first, second = geo.wkt_pair(F.col("wkt"))
    return frame.select("event_id", "wkt", first.alias("first"), second.alias("second"))


def ids_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    plate = F.when(event % 3 == 0, F.lower(e.plate_id())).otherwise(e.plate_id())
    passenger = F.when(event % 3 == 1, F.concat(e.passenger_id(), F.lit("Z"))).otherwise(e.passenger_id())
    return e.read_events(spark, sf_dir).select(
        "event_id", identity.valid_plate(plate).alias("plate_ok"),
        identity.valid_passenger_id(passenger).alias("passenger_ok"))


QUERIES = {
    "drivers_parsed": drivers_parsed,
    "passengers_parsed": passengers_parsed,
    "messages_rejected": messages_rejected,
    "messages_tagged": messages_tagged,
    "messages_flattened": messages_flattened,
    "message_positions": message_positions,
    "message_windows": message_windows,
    "messages_republished": messages_republished,
    "stream_republished": stream_republished,
    "driver_rows": driver_rows,
    "passenger_rows": passenger_rows,
    "passenger_rows_once": passenger_rows_once,
    "driver_texts": driver_texts,
    "passenger_texts": passenger_texts,
    "keyed_points": keyed_points,
    "points_parsed": points_parsed,
    "driver_documents": driver_documents,
    "driver_documents_read": driver_documents_read,
    "seats_taken": seats_taken,
    "prices": prices,
    "money_large": money_large,
    "distances": distances,
    "wkt_texts": wkt_texts,
    "ids_checked": ids_checked,
}

_W = f"WITH {e.EVENT_SQL} "
_DRIVER_TEXT = """'{"plate_id":"' || plate_id || '","seats":' || seats::varchar || ',"full_tariff":0.0,"ride_offer":'
         || offer::varchar || ',"location":[' || lon::varchar || ',' || lat::varchar || ']}'"""
_PASSENGER_TEXT = """'{"passenger_id":"' || passenger_id || '","pick_location":[],"location":[' || lon::varchar || ','
         || lat::varchar || '],"ride_offer":' || offer::varchar || ',"dropoff_location":[' || drop_0::varchar || ','
         || drop_1::varchar || ']}'"""
_REPUBLISHED = _W + f"""
SELECT CASE WHEN event_type IN ('click', 'view') THEN {_DRIVER_TEXT}
            WHEN event_type <> 'error' THEN {_PASSENGER_TEXT}
            WHEN event_id % 5 = 1 THEN '{{"plate_id": "1234ABC", "seats": "four", "location": [0.5, 39.5]}}'
            WHEN event_id % 5 = 2 THEN '{{"location": [0.5, 39.5], "ride_offer": 1.5}}'
            ELSE '{{"passenger_id": "12345678A", "location": [0.5, 39.5, 7.0]}}' END AS value, count(*) AS texts
FROM ev2 WHERE event_type <> 'error' OR event_id % 5 IN (1, 2, 3) GROUP BY 1"""


def _cost_sql(x: str) -> str:
    return e.COST_SQL.replace("p.offer", x)


def _margin_sql(x: str) -> str:
    return e.MARGIN_SQL.replace("p.offer", x)


_PLANAR = "sqrt((lon - drop_0) * (lon - drop_0) + (lat - drop_1) * (lat - drop_1)) * 111.319::double"

ORACLES = {
    "drivers_parsed": _W + """SELECT event_id, plate_id, seats, 0.0::double AS full_tariff, offer AS ride_offer,
       lon, lat FROM d""",
    "passengers_parsed": _W + """SELECT event_id, passenger_id, offer AS ride_offer, cast(0 AS integer) AS pick_points,
       lon, lat, drop_0, drop_1 FROM p""",
    "messages_rejected": f"SELECT event_id, {e.BROKEN_SQL} AS reject_reason FROM events WHERE event_type = 'error'",
    "messages_tagged": """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'driver' ELSE 'passenger' END
       AS role FROM events WHERE event_type <> 'error'""",
    "messages_flattened": _W + f"""SELECT event_id, plate_id, NULL::varchar AS passenger_id, offer AS ride_offer,
       {e.EPOCH} + sec AS at, NULL::double AS drop_0 FROM d
UNION ALL SELECT event_id, NULL, passenger_id, offer, {e.EPOCH} + sec, drop_0 FROM p""",
    "message_positions": _W + f"""SELECT plate_id, NULL::varchar AS passenger_id, lon AS first, lat AS second,
       {e.EPOCH} + sec AS at FROM d
UNION ALL SELECT NULL, passenger_id, lon, lat, {e.EPOCH} + sec FROM p""",
    "message_windows": _W + f"""SELECT event_id, bin_0, bin_1, bin_0::varchar || '_' || bin_1::varchar AS bin_key,
       {e.EPOCH} + sec // 15 * 15 AS window_15, {e.EPOCH} + sec // 10 * 10 AS window_10
FROM ev2 WHERE event_type <> 'error'""",
    "messages_republished": _REPUBLISHED,
    "stream_republished": _REPUBLISHED,
    "driver_rows": _W + "SELECT plate_id, seats, cast(0 AS integer) AS passengers FROM d",
    "passenger_rows": _W + """SELECT passenger_id, lat AS longitude, lon AS latitude, offer AS ride_offer FROM p""",
    "passenger_rows_once": _W + """
SELECT passenger_id, longitude, latitude, ride_offer FROM (
  SELECT passenger_id, lat AS longitude, lon AS latitude, offer AS ride_offer,
         row_number() OVER (PARTITION BY passenger_id ORDER BY sec, lat, lon, offer) AS n FROM p) WHERE n = 1""",
    "driver_texts": _W + """SELECT plate_id AS key, '{"plate_id":"' || plate_id || '","seats":' || seats::varchar ||
       ',"ride_offer":' || offer::varchar || ',"location":[' || lon::varchar || ',' || lat::varchar || ']}' AS value
FROM d""",
    "passenger_texts": _W + """SELECT passenger_id AS key, '{"passenger_id":"' || passenger_id || '","ride_offer":' || offer::varchar ||
       ',"location":[' || lon::varchar || ',' || lat::varchar || '],"dropoff_location":[' || drop_0::varchar || ',' || drop_1::varchar || ']}' AS value
FROM p""",
    "keyed_points": _W + """SELECT '0' AS key, '{"lon":' || lon::varchar || ',"lat":' || lat::varchar || '}' AS value
FROM ev""",
    "points_parsed": _W + "SELECT lon, lat FROM ev",
    "driver_documents": _W + "SELECT plate_id, value AS trip_cost, lon, lat FROM ev",
    "driver_documents_read": _W + "SELECT plate_id, value AS trip_cost, lon, lat FROM ev",
    "seats_taken": _W + """
SELECT event_id, close AS boarded, CASE WHEN close THEN coalesce(seats, 0) + 1 ELSE seats END AS seats FROM (
  SELECT event_id, cast(CASE WHEN event_id % 4 <> 0 THEN event_id % 5 END AS integer) AS seats,
         sqrt((lon - to_0) * (lon - to_0) + (lat - to_1) * (lat - to_1)) * 111.319::double <= 0.1::double AS close
  FROM (SELECT event_id, lon, lat, lon + 0.0001::double * (event_id % 20) AS to_0,
               lat + 0.0001::double * (event_id % 7) AS to_1 FROM ev))""",
    "prices": _W + f"""SELECT event_id, {_cost_sql('offer')} AS cost, {_margin_sql('offer')} AS margin,
       {_cost_sql('value')} AS value_cost, {_margin_sql('value')} AS value_margin,
       offer >= 2.0::double * 0.75::double AS compatible, {e.money_sql('value / 7')} AS rounded,
       round(value * 0.08::double, 6) AS fare, {e.money_sql('value * 1.5::double / seats::double')} AS seat_offer
FROM ev""",
    "money_large": f"""SELECT event_id, {e.money_sql("""(45000000000000::double + event_id * 0.015625::double)
       * CASE event_id % 3 WHEN 0 THEN 1::double WHEN 1 THEN 3::double ELSE 200::double END""")} AS rounded FROM events""",
    "distances": _W + f"""SELECT event_id, round({e.haversine_sql('lon', 'lat', 'drop_0', 'drop_1')}, 6) AS km,
       round({e.haversine_sql('lat', 'lon', 'drop_1', 'drop_0')}, 6) AS trip_km, round({_PLANAR}, 6) AS planar_km,
       {_PLANAR} <= 0.1::double AS close,
       abs(lon - drop_0) <= 0.00027027::double AND abs(lat - drop_1) <= 0.00027027::double AS near FROM ev2""",
    "wkt_texts": _W + r"""
SELECT event_id, wkt, n[1]::double AS first, n[2]::double AS second FROM (
  SELECT event_id, wkt, regexp_extract_all(wkt, '[-+]?\d*\.\d+|\d+') AS n FROM (
    SELECT event_id, 'POINT(' || lat::varchar || ' ' || ((event_id % 100) * 0.000013::double)::varchar || ')' AS wkt
    FROM ev))""",
    "ids_checked": """SELECT event_id, event_id % 3 <> 0 AS plate_ok, event_id % 3 <> 1 AS passenger_ok FROM events""",
}
