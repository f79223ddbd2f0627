"""Matching as a stream: both inputs under a watermark, pairs appended as they appear."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from hopgrid.config import PRICED, MatchConfig
from hopgrid.functions import geo, pricing
from hopgrid.operators import match as m
from hopgrid.operators.records import latest_positions, republished
from hopgrid.operators.skew import balanced_join
from hopgrid.sinks.tables import append_stream, send_to_files
from hopgrid.sources.messages import accepted, check_for_match, parse_messages, split_roles

# Matchers by name with the columns their table has.
MATCHERS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "priced": (m.match_priced, m.TRIP_COLUMNS),
    "unpriced": (m.match_unpriced, m.UNPRICED_COLUMNS),
    "exact": (m.match_exact, m.EXACT_COLUMNS),
    "bare": (m.match_bare, m.BARE_COLUMNS),
    "tolerance": (m.match_tolerance, m.EXACT_COLUMNS),
}


def timed(messages: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Arrival time as event time; messages later than the allowed lateness are discarded."""
    arrived = messages.withColumn("ts", F.col("ts").cast("timestamp"))
    return arrived if cfg.packs else arrived.withWatermark("ts", cfg.lateness)


def match_stream(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED,
                 matcher: str = "priced", carry: Sequence[str] = ()) -> DataFrame:
    """Streaming trips; a window's state goes once the watermark passes its end.

    Where keys are cut they are crowded, and packs are joined instead of rows.
    """
    function, _ = MATCHERS[matcher]
    cfg = dataclasses.replace(cfg, packs=cfg.crowded is not None or cfg.stream_parts > 1)
    return function(timed(drivers, cfg), timed(passengers, cfg), cfg, carry=carry)


def match_messages(raw: DataFrame, cfg: MatchConfig = PRICED, matcher: str = "priced",
                   carry: Sequence[str] = ()) -> DataFrame:
    """From raw messages (all topics in one frame) to trips; roles are told by content."""
    usable = accepted(check_for_match(parse_messages(raw), priced=matcher == "priced"))
    drivers, passengers = split_roles(usable, exclusive=matcher not in ("priced", "unpriced"))
    return match_stream(drivers, passengers, cfg, matcher, carry)


def collapsed_stream(drivers: DataFrame, passengers: DataFrame, cfg: MatchConfig = PRICED) -> DataFrame:
    """Repeats of one driver, passenger and bin per window, as counts: two stateful steps in a row.

    Each side is first counted per window, bin, id and offer; a count leaves its
    state when the watermark passes the window, and only then enters the join,
    whose state holds one row per distinct message instead of one per message.
    The windows carry the watermark on. ``collapse_counts`` adds up what was appended.
    """
    keys = [m.SLOT, "bin_0", "bin_1"]

    cfg = dataclasses.replace(cfg, packs=False)

    def counted(messages: DataFrame, name: str, own_id: str) -> DataFrame:
        keyed = m.with_bins(m.with_window(timed(messages, cfg), cfg), cfg)
        return keyed.groupBy(*keys, F.col(own_id).alias(f"{name}_id"), F.col("ride_offer").alias(f"{name}_offer")).agg(
            F.count(F.lit(1)).alias(f"{name}_rows"))

    compatible = pricing.offers_compatible(F.col("driver_offer"), F.col("passenger_offer"), cfg.min_offer_share)
    pairs = balanced_join(counted(drivers, "driver", "plate_id"), counted(passengers, "passenger", "passenger_id"), keys, cfg.split,
                          compatible, stream_parts=cfg.stream_parts, crowded=cfg.crowded)
    return pairs.select(
        F.col(m.SLOT)["start"].alias("window_start"), "driver_id", "passenger_id",
        geo.bin_key(F.col("bin_0"), F.col("bin_1")).alias("bin_key"),
        (F.col("driver_rows") * F.col("passenger_rows")).alias("matches"), pricing.customer_cost(F.col("passenger_offer")).alias("cost"))


def collapse_counts(counts: DataFrame) -> DataFrame:
    """``match.collapsed_matches`` from the table that ``collapsed_stream`` appended to."""
    return counts.groupBy("driver_id", "passenger_id", "bin_key").agg(
        F.sum("matches").alias("matches"), F.min("cost").alias("min_cost"), F.max("cost").alias("max_cost"))


def start_match(trips: DataFrame, path: str, checkpoint: str, matcher: str = "priced",
                trigger: dict | None = None) -> StreamingQuery:
    return append_stream(trips, path, checkpoint, MATCHERS[matcher][1], trigger=trigger)


def start_republish(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Pass every readable message on to the map, as a query of its own."""
    return send_to_files(republished(parse_messages(raw)), path, checkpoint, trigger)


def latest_stream(positions: DataFrame, key: str | None = "id") -> DataFrame:
    """Newest position per key, for ``outputMode("update")``; one row of state per key."""
    return latest_positions(positions, key)
