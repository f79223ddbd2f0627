"""Settings shared by every operator: fixed business values and tunable knobs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Results only agree with the existing service when these are equal.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.319
BIN_SIZE_DEGREES = 0.00025
TOLERANCE_DEGREES = 0.00027027
PRICED_WINDOW_SECONDS = 15
EXACT_WINDOW_SECONDS = 10
MIN_OFFER_SHARE = 0.75
TIER_OFFER = 2.50
TIER_MULTIPLIER = 1.10
TIER_MARGIN_SHARE = 0.10
FIXED_MARGIN = 0.50
VAT_MULTIPLIER = 1.21
FARE_PER_KM = 0.08
TARIFF_PER_KM = 1.50
PAYMENT_PER_COORDINATE = 0.10
PICKUP_RADIUS_KM = 0.1
STATUS_MATCHED = "matched"
STATUS_DROPPED_OFF = "dropped off"
PLATE_PATTERN = "^[0-9]{4}[A-Z]{3}$"
PASSENGER_ID_PATTERN = "^[0-9]{8}[A-Z]$"
WKT_NUMBER_PATTERN = r"([-+]?\d*\.\d+|\d+)"


@dataclass(frozen=True)
class SplitPolicy:
    """How joins spread keys that hold too many rows for one task.

    ``block_rows`` is the number of rows per side that one task may pair up;
    a key above ``block_rows ** 2`` pairs (or ``max_key_rows`` rows on one side)
    is cut into a grid of blocks. Keys are found on a ``sample_fraction`` of the
    key columns: the sample only decides the number of blocks, every row is
    joined whatever it says. Up to ``broadcast_keys`` hot keys are broadcast,
    more are joined by shuffle.
    """

    enabled: bool = True
    block_rows: int = 4096
    max_key_rows: int = 1_000_000
    sample_fraction: float = 0.02
    broadcast_keys: int = 50_000


@dataclass(frozen=True)
class MatchConfig:
    """Knobs of the matching operators; the defaults are the priced match."""

    window_seconds: int = PRICED_WINDOW_SECONDS
    bin_size: float = BIN_SIZE_DEGREES
    tolerance: float = TOLERANCE_DEGREES
    min_offer_share: float = MIN_OFFER_SHARE
    fare_per_km: float = FARE_PER_KM
    lateness: str = "0 seconds"
    # "random": a new uuid per trip. "stable": uuid-shaped digest of the pair, so
    # a task that runs again writes the same id.
    trip_ids: str = "random"
    # Streams cannot count keys ahead: every key is cut into stream_parts ** 2 blocks.
    stream_parts: int = 1
    # Known crowded keys, as ``match.crowded_bins`` gives them: a stream cuts these further, a batch join counts no keys.
    crowded: DataFrame | None = field(default=None, compare=False)
    split: SplitPolicy = field(default_factory=SplitPolicy)
    # Streams join packs of rows; the watermark is then set on the packs, so the matchers take frames without one.
    packs: bool = False

    @property
    def window_length(self) -> str:
        return f"{self.window_seconds} seconds"


PRICED = MatchConfig()
EXACT = MatchConfig(window_seconds=EXACT_WINDOW_SECONDS)
