"""Message sources, parsing, quarantine and role split.

A *raw* frame has ``value`` (text or bytes) and ``ts`` (arrival time); batch and
streaming frames go through the same functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MESSAGE_SCHEMA = (
    "plate_id string, passenger_id string, seats int, passengers int, full_tariff double, "
    "ride_offer double, location array<double>, pick_location array<double>, "
    "dropoff_location array<double>"
)
REPLAY_SCHEMA = "value string, ts timestamp"

DRIVER_FIELDS = ("plate_id", "seats", "full_tariff", "ride_offer", "location")
PASSENGER_FIELDS = ("passenger_id", "pick_location", "location", "ride_offer", "dropoff_location")


def kafka_messages(spark: SparkSession, servers: str, topic: str, *, streaming: bool = True,
                   starting: str = "earliest", options: dict[str, str] | None = None) -> DataFrame:
    """Raw frame from a topic; ``message_id`` is the record's own position."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting).options(**(options or {}))
    return reader.load().select(
        "value", F.col("timestamp").alias("ts"),
        F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
        .alias("message_id"))


def text_messages(spark: SparkSession, path: str, *, streaming: bool = False) -> DataFrame:
    """Raw frame from text files, one message per line, stamped with the file's time."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").load(path).select(
        "value", F.col("_metadata.file_modification_time").alias("ts"))


def replay_messages(spark: SparkSession, path: str, *, streaming: bool = False,
                    schema: str = REPLAY_SCHEMA, max_files: int | None = None) -> DataFrame:
    """Raw frame from recorded parquet files that carry their arrival time."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(schema)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def parse_messages(raw: DataFrame) -> DataFrame:
    """Decode and parse every message; the outcome is in ``reject_reason``.

    Nothing is dropped here: ``accepted`` and ``rejected`` are plain filters.
    ``has_plate`` / ``has_passenger`` tell whether the key is present, which a
    JSON null also is. Other columns of the raw frame are kept.
    """
    keep = [F.col(name) for name in raw.columns if name != "value"]
    texts = raw.select(F.col("value").cast("string").alias("value"), *keep)
    # A generator, as filters on its output are not merged into it: each text is parsed once.
    parsed = texts.select("*", F.inline(F.array(_wrapped(MESSAGE_SCHEMA))))
    has_plate, has_passenger = _has_key("plate_id"), _has_key("passenger_id")
    # Only texts that failed are parsed again, to tell bad JSON from a bad type.
    strict = F.from_json(_in_wrapper(), "m string, corrupt string", _JSON)
    reason = (
        F.when(F.col("value").isNull(), "malformed_json")
        .when(~F.is_valid_utf8(F.col("value")), "invalid_utf8")
        .when(F.col("corrupt").isNotNull(),
              F.when(strict["corrupt"].isNotNull(), "malformed_json").otherwise("wrong_type"))
        .when(F.col("m").isNull(), "malformed_json")
        .when(~(has_plate | has_passenger), "no_id")
        .when(~_is_point(F.col("m.location")), "bad_location")
    )
    return parsed.select(
        "value", "m.*", has_plate.alias("has_plate"), has_passenger.alias("has_passenger"),
        reason.alias("reject_reason"), *keep)


_JSON = {"columnNameOfCorruptRecord": "corrupt", "allowSingleQuotes": "false"}


def _in_wrapper() -> Column:
    """The text as a member of an object, so that text after its closing brace is malformed."""
    return F.concat(F.lit('{"m":'), F.coalesce("value", F.lit("")), F.lit("}"))


def _wrapped(schema: str) -> Column:
    return F.from_json(_in_wrapper(), f"m struct<{_struct_fields(schema)}>, corrupt string", _JSON)


def _struct_fields(schema: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in
                     (part.strip().split(" ", 1) for part in schema.split(",")))


def _has_key(name: str) -> Column:
    """Whether the key is there; only a key whose value is null needs the list of keys."""
    text = F.col("value")
    may_be_null = text.contains(f'"{name}"') | text.contains("\\u")
    listed = F.coalesce(F.array_contains(F.json_object_keys(text), name), F.lit(False))
    # CASE, not OR: operands of OR that occur twice are computed ahead for every row.
    return F.when(F.col(f"m.{name}").isNotNull(), True).when(may_be_null, listed).otherwise(False)


def _is_point(location: Column) -> Column:
    """Two finite coordinates."""
    finite = F.forall(location, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(location) == 2) & finite, F.lit(False))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull())


def rejected(parsed: DataFrame) -> DataFrame:
    """The quarantine: original text and why it was turned away."""
    kept = [name for name in ("ts", "message_id") if name in parsed.columns]
    return parsed.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason", *kept)


def check_for_match(parsed: DataFrame, *, priced: bool = True) -> DataFrame:
    """Also turn away messages that a matcher could not use."""
    no_offer = F.lit(priced) & (F.col("ride_offer").isNull() | F.isnan("ride_offer"))
    no_dropoff = F.col("has_passenger") & ~_is_point(F.col("dropoff_location"))
    return parsed.withColumn("reject_reason", F.coalesce(
        F.col("reject_reason"),
        F.when(no_offer, "no_offer").when(no_dropoff, "bad_dropoff")))


def split_roles(messages: DataFrame, *, exclusive: bool = False) -> tuple[DataFrame, DataFrame]:
    """Drivers and passengers by key presence.

    A message with both keys is in both frames, or with ``exclusive`` a driver only.
    """
    passenger = F.col("has_passenger")
    if exclusive:
        passenger = passenger & ~F.col("has_plate")
    return (_role(messages.where(F.col("has_plate")), DRIVER_FIELDS),
            _role(messages.where(passenger), PASSENGER_FIELDS))


def tag_role(messages: DataFrame) -> DataFrame:
    """``role`` column; messages without an id are dropped, a plate wins over a passenger."""
    role = F.when(F.col("has_plate"), "driver").when(F.col("has_passenger"), "passenger")
    return messages.withColumn("role", role).where(F.col("role").isNotNull())


def _role(messages: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    kept = [name for name in ("ts", "message_id") if name in messages.columns]
    return messages.select(*fields, *kept)


def flatten_roles(drivers: DataFrame, passengers: DataFrame) -> DataFrame:
    """Bag union of both streams; fields of one role are NULL in the other."""
    return drivers.unionByName(passengers, allowMissingColumns=True)


def parse_points(raw: DataFrame) -> DataFrame:
    """``{"lon","lat"}`` records; ``marker_*`` is the pair in the order maps draw it."""
    point = F.from_json(F.col("value").cast("string"), "lon double, lat double")
    kept = [F.col(name) for name in raw.columns if name != "value"]
    return (raw.select(point.alias("p"), *kept)
            .where(F.col("p.lon").isNotNull() & F.col("p.lat").isNotNull())
            .select("p.lon", "p.lat", *kept))


def message_positions(parsed: DataFrame) -> DataFrame:
    """First two elements of ``location`` of any message, in message order."""
    kept = [name for name in ("plate_id", "passenger_id", "ts") if name in parsed.columns]
    return parsed.where(F.size("location") >= 2).select(
        *kept, F.get("location", F.lit(0)).alias("first"), F.get("location", F.lit(1)).alias("second"))
