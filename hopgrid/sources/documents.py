"""Nested JSON documents and the persisted tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DRIVER_DOCUMENT = (
    "plate_id string, course array<array<double>>, seats int, passengers int, trip_cost double, "
    "full_tariff double, location array<struct<lon: double, lat: double>>"
)
PASSENGER_DOCUMENT = (
    "passenger_id string, pick_location array<double>, dropoff_location array<double>, "
    "distance double, location array<double>"
)
TABLES = ("drivers", "passengers", "trips")


def read_documents(spark: SparkSession, path: str, schema: str = DRIVER_DOCUMENT) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_documents(texts: DataFrame, schema: str = DRIVER_DOCUMENT, text: str = "text") -> DataFrame:
    """The same documents held in a text column."""
    return texts.select(F.from_json(F.col(text), schema).alias("d")).select("d.*")


def driver_summary(documents: DataFrame) -> DataFrame:
    """Car id, price and the first position of each driver document."""
    first = F.get("location", F.lit(0))
    return documents.select("plate_id", "trip_cost", first["lon"].alias("lon"), first["lat"].alias("lat"))


def register_tables(spark: SparkSession, **frames: DataFrame) -> None:
    """Make ``drivers``, ``passengers`` and ``trips`` known to SQL by name."""
    for name, frame in frames.items():
        if name not in TABLES:
            raise ValueError(f"unknown table {name}, expected one of {TABLES}")
        frame.createOrReplaceTempView(name)


def open_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Read the parquet tables of ``folder`` and register them."""
    frames = {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in TABLES}
    register_tables(spark, **frames)
    return frames
