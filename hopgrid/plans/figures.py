"""Registered queries: business figures and lookups over trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hopgrid.functions import pricing
from hopgrid.operators import kpis
from hopgrid.operators.records import driver_rows, passenger_rows
from hopgrid.plans import events as e
from hopgrid.session import work_dir
from hopgrid.operators.match import match_priced
from hopgrid.sinks.tables import append_along_curve, append_once, append_table, trips_in_box
from hopgrid.operators import sketches
from hopgrid.plans.matching import arriving
from hopgrid.sources.documents import open_tables
from hopgrid.streaming.figures import current_figures, start_figures, window_figures


def _drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_rows(e.messages(spark, sf_dir)[0])


def _passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passengers move a little with each message, so the position of a row matters."""
    event = F.col("event_id")
    moved = F.array(F.get("location", F.lit(0)) + (event * 3 % 11) * F.lit(0.00001),
                    F.get("location", F.lit(1)) + (event % 7) * F.lit(0.00001))
    return passenger_rows(e.messages(spark, sf_dir)[1].withColumn("location", moved))


def _stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three tables, written once and opened under their names."""
    folder = work_dir(spark, "tables")
    append_table(_drivers(spark, sf_dir), f"{folder}/drivers")
    append_table(_passengers(spark, sf_dir), f"{folder}/passengers")
    append_table(e.trips_table(spark, sf_dir), f"{folder}/trips")
    return open_tables(spark, folder)


def _on_trips(figure):
    return lambda spark, sf_dir: figure(e.trips_table(spark, sf_dir))


def _on_messages(figure):
    return lambda spark, sf_dir: figure(*e.messages(spark, sf_dir))


def _on_both(figure):
    return lambda spark, sf_dir: figure(_drivers(spark, sf_dir), e.trips_table(spark, sf_dir))


def _money(figure, *names: str):
    """Sums of doubles differ in the last bits between engines; compare them in cents."""
    return lambda trips: figure(trips).withColumns({n: pricing.round_money(F.col(n)) for n in names})


def enrolled_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.enrolled_drivers(_drivers(spark, sf_dir))


def moved_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.moved(e.trips_table(spark, sf_dir)).select("trip_id", "travelled_distance")


def margin_summary(trips: DataFrame) -> DataFrame:
    return kpis.margin_summary(trips).withColumn("avg_margin", F.round("avg_margin", 6))


def trip_points(trips: DataFrame) -> DataFrame:
    return kpis.trip_points(trips).withColumns(
        {n: F.round(n, 9) for n in ("center_lat", "center_lon")})


def _first_trip(trips: DataFrame) -> str:
    return trips.agg(F.min("trip_id")).first()[0]


def found_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Looked up in the stored table, whose row groups a bloom filter on the id skips."""
    trips = _stored_tables(spark, sf_dir)["trips"]
    return kpis.find_trip(trips, _first_trip(trips))


def found_passenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored_tables(spark, sf_dir)
    return kpis.find_passenger(tables["passengers"], tables["trips"], _first_trip(tables["trips"]))


def passenger_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.passenger_of_trips(_passengers(spark, sf_dir), e.trips_table(spark, sf_dir))


def passengers_unswapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.unswap_location(_passengers(spark, sf_dir))


_FIGURES_QUERY = """SELECT (SELECT count(DISTINCT plate_id) FROM {drivers}) AS enrolled,
                  count(DISTINCT driver_id) FILTER (WHERE travelled_distance <> 0.0) AS matched,
                  cast(format_number(sum(cost), '0.00') AS double) AS total_volume_traded,
                  cast(format_number(sum(company_margin) FILTER (WHERE company_margin IS NOT NULL), '0.00')
                       AS double) AS total_income
           FROM {trips}"""


def figures_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures as plain SQL over frames."""
    return spark.sql(_FIGURES_QUERY, drivers=_drivers(spark, sf_dir), trips=e.trips_table(spark, sf_dir))


def figures_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the stored tables."""
    tables = _stored_tables(spark, sf_dir)
    return spark.sql(_FIGURES_QUERY, drivers=tables["drivers"], trips=tables["trips"])


def _timed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Driver messages, and trips with the time of the driver's message."""
    drivers, passengers = e.messages(spark, sf_dir)
    return drivers.select("plate_id", "ts"), match_priced(drivers, passengers, carry=["ts"]).select(
        "driver_id", "cost", "company_margin", "travelled_distance", F.col("driver_ts").alias("ts"))


def _followed(spark: SparkSession, sf_dir: str) -> str:
    folder = work_dir(spark, "figures")
    start_figures(*arriving(spark, _timed(spark, sf_dir)), f"{folder}/kept", f"{folder}/checkpoint", "10 minutes",
                  {"availableNow": True}).awaitTermination()
    return f"{folder}/kept"


def stream_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures from a stream in several micro-batches."""
    return current_figures(spark, _followed(spark, sf_dir)).drop("enrolled_estimate", "matched_estimate").withColumn(
        "avg_margin", F.round("avg_margin", 6))


def stream_window_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state behind them: one row per window."""
    return window_figures(spark, _followed(spark, sf_dir)).select(
        F.unix_seconds("window_start").alias("window_start"), "trips", pricing.round_money(F.col("volume")).alias("volume"),
        pricing.round_money(F.col("income")).alias("income"), "margins")


def figures_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact and sketched distinct counts side by side, by day and over all days; sketches are stored and read back."""
    drivers, trips = _timed(spark, sf_dir)
    path = work_dir(spark, "sketches")
    sketches.daily_sketches(drivers, trips).write.parquet(path)
    stored = spark.read.parquet(path)

    def rows(exact: DataFrame, sketched: DataFrame) -> DataFrame:
        names = ["enrolled", "matched", "both"]
        both = exact.withColumn("day", F.coalesce("day", F.lit("all"))).join(
            sketched.withColumn("day", F.coalesce("day", F.lit("all"))).withColumnsRenamed({n: f"{n}_s" for n in names}), "day")
        wide = [F.struct(F.lit(n).alias("figure"), F.col(n).alias("exact"),
                         (F.abs(F.col(f"{n}_s") - F.col(n)) <= sketches.ERROR * F.greatest("enrolled", "matched")).alias("within_bound"))
                for n in names]
        return both.select("day", F.inline(F.array(*wide)))

    day = F.col("day").cast("string")
    none = F.lit(None).cast("string")
    exact = sketches.exact_figures(drivers, trips, daily=True).withColumn("day", day).unionByName(
        sketches.exact_figures(drivers, trips).withColumn("day", none))
    sketched = sketches.sketched_figures(stored, "day").withColumn("day", day).unionByName(
        sketches.sketched_figures(stored).withColumn("day", none))
    return rows(exact, sketched)


def trips_appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs append, and the first one is run again."""
    path = work_dir(spark, "trips-once")
    trips = e.trips_table(spark, sf_dir)
    low = F.col("accepted_offer") <= 2.0
    columns = ("trip_id", "driver_id", "passenger_id", "cost")
    for job, part in (("low", trips.where(low)), ("high", trips.where(~low)), ("low", trips.where(low))):
        append_once(part, path, job, columns)
    return spark.read.parquet(path)


def trips_boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of a box of bins, from a table laid out along a space-filling curve."""
    path = work_dir(spark, "trips-curve")
    bins = F.split("bin_key", "_")
    trips = e.trips_table(spark, sf_dir).withColumns({"bin_0": F.get(bins, F.lit(0)).cast("bigint"), "bin_1": F.get(bins, F.lit(1)).cast("bigint")})
    append_along_curve(trips, path, columns=("trip_id", "driver_id", "cost", "bin_0", "bin_1"))
    return trips_in_box(spark.read.parquet(path), (-1482, 157880), (-1481, 157881))


QUERIES = {
    "trips_boxed": trips_boxed,
    "stream_figures": stream_figures,
    "stream_window_figures": stream_window_figures,
    "figures_sketched": figures_sketched,
    "trips_appended_once": trips_appended_once,
    "enrolled_drivers": enrolled_drivers,
    "traded_volume": _on_trips(kpis.traded_volume),
    "margins": _on_trips(kpis.margins),
    "margin_summary": _on_trips(margin_summary),
    "total_income": _on_trips(_money(kpis.total_income, "total_income")),
    "income_and_volume": _on_trips(_money(kpis.income_and_volume, "total_income")),
    "moved_trips": moved_trips,
    "matched_drivers": _on_trips(kpis.matched_drivers),
    "match_ratio": _on_both(kpis.match_ratio),
    "matching_status": _on_both(kpis.matching_status),
    "money_from_messages": _on_messages(kpis.money_from_messages),
    "matched_drivers_from_messages": _on_messages(kpis.matched_drivers_from_messages),
    "figures_in_sql": figures_in_sql,
    "figures_from_tables": figures_from_tables,
    "trip_points": _on_trips(trip_points),
    "found_trip": found_trip,
    "found_passenger": found_passenger,
    "passenger_of_trips": passenger_of_trips,
    "passengers_unswapped": passengers_unswapped,
}

_T = f"WITH {e.TRIPS_SQL} "
_VOLUME = e.money_sql("sum(cost)")
_INCOME = e.money_sql("sum(company_margin)")
_FIGURES = f"""{_T}, f AS (
  SELECT (SELECT count(DISTINCT plate_id) FROM d) AS enrolled,
         (SELECT count(DISTINCT driver_id) FROM trips WHERE travelled_distance <> 0.0) AS matched)"""
_RATIO = e.money_sql("matched::double / enrolled")
_STORED = """stored AS (
  SELECT passenger_id, offer, lon + (event_id * 3 % 11) * 0.00001::double AS lon,
         lat + (event_id % 7) * 0.00001::double AS lat FROM p)"""
_IN_SQL = _FIGURES + f"""SELECT enrolled, matched,
       (SELECT {_VOLUME} FROM trips) AS total_volume_traded, (SELECT {_INCOME} FROM trips) AS total_income FROM f"""
_MATCHED = _T + "SELECT count(DISTINCT driver_id) AS matched FROM trips WHERE travelled_distance <> 0.0"

ORACLES = {
    "enrolled_drivers": f"WITH {e.EVENT_SQL} SELECT count(DISTINCT plate_id) AS enrolled FROM d",
    "traded_volume": _T + f"SELECT {_VOLUME} AS total_volume_traded FROM trips",
    "margins": _T + "SELECT company_margin FROM trips WHERE company_margin IS NOT NULL",
    "margin_summary": _T + "SELECT count(company_margin) AS trips, round(avg(company_margin), 6) AS avg_margin FROM trips",
    "total_income": _T + f"SELECT {_INCOME} AS total_income FROM trips",
    "income_and_volume": _T + f"SELECT {_INCOME} AS total_income, {_VOLUME} AS total_volume_traded FROM trips",
    "moved_trips": _T + "SELECT trip_id, travelled_distance FROM trips WHERE travelled_distance <> 0.0",
    "matched_drivers": _MATCHED,
    "match_ratio": _FIGURES + f"""SELECT enrolled, matched, {_RATIO} AS match_ratio,
       {_RATIO} * 100 AS match_percent FROM f""",
    "matching_status": _FIGURES + """SELECT 'drivers with no match' AS status, enrolled - matched AS drivers FROM f
UNION ALL SELECT 'drivers with match', matched FROM f""",
    "money_from_messages": _T + f"""SELECT count(*) AS trips, {_INCOME} AS total_income,
       {_VOLUME} AS total_volume_traded FROM trips""",
    "matched_drivers_from_messages": _MATCHED,
    "figures_in_sql": _IN_SQL,
    "figures_from_tables": _IN_SQL,
    "trips_boxed": f"""WITH {e.EVENT_SQL}
SELECT d.event_id::varchar || '-' || p.event_id::varchar AS trip_id, d.plate_id AS driver_id, {e.COST_SQL} AS cost, d.bin_0, d.bin_1
{e.PAIR_SQL} AND p.offer >= d.offer * 0.75::double
WHERE d.bin_0 BETWEEN -1482 AND -1481 AND d.bin_1 BETWEEN 157880 AND 157881""",
    "trips_appended_once": _T + """SELECT trip_id, driver_id, passenger_id, cost,
       CASE WHEN accepted_offer <= 2.0 THEN 'low' ELSE 'high' END AS job FROM trips""",
    "stream_figures": _FIGURES + f"""SELECT enrolled, matched, (SELECT count(*) FROM trips) AS trips,
       (SELECT {_VOLUME} FROM trips) AS total_volume_traded, (SELECT {_INCOME} FROM trips) AS total_income,
       (SELECT round(avg(company_margin), 6) FROM trips) AS avg_margin, {_RATIO} AS match_ratio FROM f""",
    "stream_window_figures": _T + f""", w AS (SELECT DISTINCT sec // 600 AS slot FROM d),
t AS (SELECT d.sec // 600 AS slot, trips.* FROM trips JOIN d ON d.event_id = trips.driver_event_id)
SELECT {e.EPOCH} + w.slot * 600 AS window_start, count(t.slot) AS trips, {_VOLUME} AS volume, {_INCOME} AS income,
       count(company_margin) AS margins FROM w LEFT JOIN t USING (slot) GROUP BY w.slot""",
    "figures_sketched": _T + f""", seen AS (
  SELECT strftime(to_timestamp({e.EPOCH} + sec) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, plate_id AS id FROM d),
moved AS (
  SELECT strftime(to_timestamp({e.EPOCH} + d.sec) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, driver_id AS id
  FROM trips JOIN d ON d.event_id = trips.driver_event_id WHERE travelled_distance <> 0.0),
s2 AS (SELECT DISTINCT * FROM (SELECT * FROM seen UNION ALL SELECT 'all', id FROM seen)),
m2 AS (SELECT DISTINCT * FROM (SELECT * FROM moved UNION ALL SELECT 'all', id FROM moved))
SELECT day, 'enrolled' AS figure, count(*) AS exact, true AS within_bound FROM s2 GROUP BY day
UNION ALL SELECT day, 'matched', count(m2.id), true FROM (SELECT DISTINCT day FROM s2) LEFT JOIN m2 USING (day) GROUP BY day
UNION ALL SELECT day, 'both', count(m2.id), true FROM s2 LEFT JOIN m2 USING (day, id) GROUP BY day""",
    "trip_points": f"""WITH {e.EVENT_SQL}
SELECT d.event_id::varchar || '-' || p.event_id::varchar AS trip_id, d.plate_id AS driver_id,
       d.lat AS pickup_lat, abs(d.lon) * sign(d.lon) AS pickup_lon, p.drop_1 AS dropoff_lat, p.drop_0 AS dropoff_lon,
       round((d.lat + p.drop_1) / 2, 9) AS center_lat, round((d.lon + p.drop_0) / 2, 9) AS center_lon
{e.PAIR_SQL} AND p.offer >= d.offer * 0.75::double""",
    "found_trip": _T + """SELECT driver_id, pickup_location, dropoff_location, cost, travelled_distance
FROM trips WHERE trip_id = (SELECT min(trip_id) FROM trips)""",
    "found_passenger": f"""{_T}, {_STORED} SELECT lon AS longitude, lat AS latitude FROM stored
WHERE passenger_id = (SELECT passenger_id FROM trips WHERE trip_id = (SELECT min(trip_id) FROM trips))""",
    "passenger_of_trips": f"""{_T}, {_STORED}
SELECT trip_id, passenger_id, f.lon AS longitude, f.lat AS latitude
FROM trips JOIN (SELECT *, row_number() OVER (PARTITION BY passenger_id ORDER BY lat, lon) AS n FROM stored) f
  USING (passenger_id) WHERE n = 1""",
    "passengers_unswapped": f"""WITH {e.EVENT_SQL}, {_STORED}
SELECT passenger_id, offer AS ride_offer, lon AS longitude, lat AS latitude FROM stored""",
}
