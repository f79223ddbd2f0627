"""Ride messages derived from the ``events`` table.

Clicks and views become driver messages, purchases and signups passenger
messages, errors unusable ones. Five events make one second of traffic, so the
number of windows, and with it every result, grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hopgrid.operators.match import match_priced

DRIVER_TYPES = ("click", "view")
PASSENGER_TYPES = ("purchase", "signup")
EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC

# The same derivation as CTEs of the comparison SQL.
EVENT_SQL = """
ev AS (
  SELECT event_id, user_id, event_type, value,
         event_id // 5 AS sec,
         -0.37::double - (user_id % 10) * 0.0001::double AS lon,
         39.47::double + ((user_id // 10) % 8) * 0.0001::double AS lat,
         (100 + cast(round(value * 100) AS bigint) % 201) / 100.0::double AS offer,
         cast(4 + user_id % 3 AS integer) AS seats,
         lpad(cast(user_id % 10000 AS varchar), 4, '0') || chr(cast(65 + (user_id // 10000) % 26 AS integer))
           || chr(cast(65 + (user_id // 260000) % 26 AS integer)) || 'A' AS plate_id,
         lpad(cast(user_id % 100000000 AS varchar), 8, '0') || 'P' AS passenger_id
  FROM events),
ev2 AS (
  SELECT *, lon + 0.001::double * (event_id % 30) AS drop_0, lat + 0.0005::double * (event_id % 17) AS drop_1,
         cast(trunc(lon / 0.00025::double) AS bigint) AS bin_0,
         cast(trunc(lat / 0.00025::double) AS bigint) AS bin_1
  FROM ev),
d AS (SELECT * FROM ev2 WHERE event_type IN ('click', 'view')),
p AS (SELECT * FROM ev2 WHERE event_type IN ('purchase', 'signup'))"""


def money_sql(x: str) -> str:
    return f"cast(printf('%.2f', {x}) AS double)"


def haversine_sql(lon_a: str, lat_a: str, lon_b: str, lat_b: str) -> str:
    return (f"(6371.0::double * 2 * asin(sqrt(pow(sin((radians({lat_b}) - radians({lat_a})) / 2), 2) + "
            f"cos(radians({lat_a})) * cos(radians({lat_b})) * "
            f"pow(sin((radians({lon_b}) - radians({lon_a})) / 2), 2))))")


def point_sql(first: str, second: str) -> str:
    return f"'POINT(' || {first}::varchar || ' ' || {second}::varchar || ')'"


# Trip distances are measured with the axes exchanged, as the trips table has them.
TRIP_KM_SQL = haversine_sql("d.lat", "d.lon", "p.drop_1", "p.drop_0")
PAIR_SQL = "FROM d JOIN p ON d.sec // 15 = p.sec // 15 AND d.bin_0 = p.bin_0 AND d.bin_1 = p.bin_1"
COST_SQL = ("CASE WHEN p.offer > 2.5 THEN "
            + money_sql("(p.offer * 1.10::double + 0.50::double) * 1.21::double") + " ELSE "
            + money_sql("(p.offer + 0.50::double) * 1.21::double") + " END")
MARGIN_SQL = ("CASE WHEN p.offer > 2.5 THEN " + money_sql("p.offer * 0.10::double + 0.50::double")
              + " ELSE 0.5::double END")
PLACES_SQL = f"""d.plate_id AS driver_id, p.passenger_id,
         {point_sql('d.lat', 'd.lon')} AS pickup_location,
         {point_sql('p.drop_1', 'p.drop_0')} AS dropoff_location"""
TRIPS_SQL = EVENT_SQL + f""",
trips AS (
  SELECT d.event_id AS driver_event_id, p.event_id AS passenger_event_id,
         d.event_id::varchar || '-' || p.event_id::varchar AS trip_id,
         d.bin_0::varchar || '_' || d.bin_1::varchar AS bin_key,
         {PLACES_SQL},
         {money_sql(TRIP_KM_SQL)} AS travelled_distance, 'matched' AS status,
         {COST_SQL} AS cost, {MARGIN_SQL} AS company_margin, p.offer AS accepted_offer,
         {money_sql(haversine_sql('d.lon', 'd.lat', 'p.drop_0', 'p.drop_1'))} AS travelled_distance_geo,
         {point_sql('d.lon', 'd.lat')} AS pickup_wkt_lonlat
  {PAIR_SQL} AND p.offer >= d.offer * 0.75::double)"""


def read_events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    if not streaming:
        return spark.read.parquet(f"{sf_dir}/events.parquet")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _div(column: Column, by: int) -> Column:
    return F.floor(column / F.lit(by)).cast("bigint")


def lon() -> Column:
    return F.lit(-0.37) - (F.col("user_id") % 10) * F.lit(0.0001)


def lat() -> Column:
    return F.lit(39.47) + (_div(F.col("user_id"), 10) % 8) * F.lit(0.0001)


def dropoff() -> tuple[Column, Column]:
    return (lon() + F.lit(0.001) * (F.col("event_id") % 30),
            lat() + F.lit(0.0005) * (F.col("event_id") % 17))


def plate_id() -> Column:
    user = F.col("user_id")
    letters = [F.chr(65 + _div(user, by) % 26) for by in (10000, 260000)]
    return F.concat(F.lpad((user % 10000).cast("string"), 4, "0"), *letters, F.lit("A"))


def passenger_id() -> Column:
    return F.concat(F.lpad((F.col("user_id") % 100000000).cast("string"), 8, "0"), F.lit("P"))


def ride_offer() -> Column:
    return (100 + F.round(F.col("value") * 100).cast("bigint") % 201) / F.lit(100.0)


def seats() -> Column:
    return (4 + F.col("user_id") % 3).cast("int")


def seconds() -> Column:
    return _div(F.col("event_id"), 5)


def message_time() -> Column:
    return F.timestamp_seconds(F.lit(EPOCH) + seconds())


def driver_messages(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(*DRIVER_TYPES)).select(
        "event_id", plate_id().alias("plate_id"), seats().alias("seats"), ride_offer().alias("ride_offer"),
        F.array(lon(), lat()).alias("location"), message_time().alias("ts"))


def passenger_messages(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(*PASSENGER_TYPES)).select(
        "event_id", passenger_id().alias("passenger_id"), ride_offer().alias("ride_offer"),
        F.array(lon(), lat()).alias("location"), F.array(*dropoff()).alias("dropoff_location"),
        message_time().alias("ts"))


def messages(spark: SparkSession, sf_dir: str, streaming: bool = False) -> tuple[DataFrame, DataFrame]:
    events = read_events(spark, sf_dir, streaming)
    return driver_messages(events), passenger_messages(events)


def crowded_messages(spark: SparkSession, sf_dir: str, streaming: bool = False) -> tuple[DataFrame, DataFrame]:
    """The messages with every third one of 20,000 events in one burst: one place, one window."""
    event = F.col("event_id")
    burst = event % 3 == 0
    start = _div(_div(event, 20000) * 4000, 15) * 15
    return tuple(side.withColumns({
        "ts": F.when(burst, F.timestamp_seconds(F.lit(EPOCH) + start + event % 15)).otherwise(F.col("ts")),
        "location": F.when(burst, F.array(F.lit(-0.5), F.lit(39.6))).otherwise(F.col("location"))})
        for side in messages(spark, sf_dir, streaming))


CROWDED_SQL = EVENT_SQL + """,
burst AS (
  SELECT event_id, event_type, offer,
         CASE WHEN event_id % 3 = 0 THEN (event_id // 20000 * 4000) // 15 ELSE sec // 15 END AS slot,
         CASE WHEN event_id % 3 = 0 THEN cast(trunc(-0.5::double / 0.00025::double) AS bigint) ELSE bin_0 END AS bin_0,
         CASE WHEN event_id % 3 = 0 THEN cast(trunc(39.6::double / 0.00025::double) AS bigint) ELSE bin_1 END AS bin_1
  FROM ev2),
bd AS (SELECT * FROM burst WHERE event_type IN ('click', 'view')),
bp AS (SELECT * FROM burst WHERE event_type IN ('purchase', 'signup'))"""


def trips_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced trips with an id made of the two event ids, so that SQL can form it too."""
    drivers, passengers = messages(spark, sf_dir)
    trips = match_priced(drivers, passengers, carry=["event_id"])
    return trips.withColumn("trip_id", F.concat_ws("-", F.col("driver_event_id").cast("string"),
                                                   F.col("passenger_event_id").cast("string")))


def raw_messages(events: DataFrame) -> DataFrame:
    """The messages as JSON text; errors come in five kinds of unusable text."""
    location = F.array(lon(), lat())
    driver = F.to_json(F.struct(
        plate_id().alias("plate_id"), seats().alias("seats"),
        F.lit(0.0).alias("full_tariff"), ride_offer().alias("ride_offer"), location.alias("location")))
    passenger = F.to_json(F.struct(
        passenger_id().alias("passenger_id"), F.array().cast("array<double>").alias("pick_location"),
        location.alias("location"), ride_offer().alias("ride_offer"), F.array(*dropoff()).alias("dropoff_location")))
    kind = F.col("event_id") % 5
    broken = (F.when(kind == 0, F.concat(F.lit('{"plate_id": "'), plate_id()))
              .when(kind == 1, F.lit('{"plate_id": "1234ABC", "seats": "four", "location": [0.5, 39.5]}'))
              .when(kind == 2, F.lit('{"location": [0.5, 39.5], "ride_offer": 1.5}'))
              .when(kind == 3, F.lit('{"passenger_id": "12345678A", "location": [0.5, 39.5, 7.0]}'))
              .otherwise(F.concat(driver, F.lit(" trailing"))))
    value = (F.when(F.col("event_type").isin(*DRIVER_TYPES), driver)
             .when(F.col("event_type").isin(*PASSENGER_TYPES), passenger).otherwise(broken))
    return events.select(value.alias("value"), message_time().alias("ts"),
                         F.col("event_id").cast("string").alias("message_id"))


BROKEN_SQL = """CASE event_id % 5 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'wrong_type' WHEN 2 THEN 'no_id'
         WHEN 3 THEN 'bad_location' ELSE 'malformed_json' END"""


def course_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as a course, in event order."""
    event = F.col("event_id")
    return read_events(spark, sf_dir).select(
        F.col("user_id").alias("route"), event.alias("idx"),
        (F.lit(-0.37) - (event % 997) * F.lit(0.00005)).alias("lon"),
        (F.lit(39.47) + (event % 613) * F.lit(0.00003)).alias("lat"))


COURSE_SQL = """
pts AS (
  SELECT user_id AS route, event_id AS idx, -0.37::double - (event_id % 997) * 0.00005::double AS lon,
         39.47::double + (event_id % 613) * 0.00003::double AS lat FROM events),
seg AS (
  SELECT *, lead(lon) OVER w AS next_lon, lead(lat) OVER w AS next_lat FROM pts
  WINDOW w AS (PARTITION BY route ORDER BY idx))"""
