"""Money rounding and the price rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hopgrid import config as c


def round_money(amount: Column) -> Column:
    """Two decimals, judged on the exact binary value, ties to even.

    ``F.round`` works on the decimal text of the double and differs (2.675).
    Here the scaling error is kept: the amount is split into two halves whose
    products with 100 are exact, so when the scaled value lands on a tie the
    remainder tells which side the amount is on. From 2 ** 46 up doubles lie
    more than a cent apart, so the double nearest to the rounded amount is the
    amount itself: there rounding changes nothing, and the scaled value, which
    might overflow, is not needed.
    """
    # The lambda evaluates the amount once; written out, the amount's own
    # expression would be repeated at each of its uses below.
    return F.get(F.transform(F.array(amount), _cents_rounded), F.lit(0))


def _cents_rounded(amount: Column) -> Column:
    scaled = amount * 100.0
    below = F.floor(scaled).cast("double")
    spread = amount * 134217729.0  # 2 ** 27 + 1
    high = spread - (spread - amount)
    remainder = (amount - high) * 100.0 - (scaled - high * 100.0)
    cents = (
        F.when((scaled - below != 0.5) | (remainder == 0.0), F.rint(scaled))
        .when(remainder > 0.0, below + 1.0)
        .otherwise(below)
    )
    return F.when(F.abs(amount) < 2.0 ** 46, cents / 100.0).otherwise(amount)


def customer_cost(offer: Column) -> Column:
    """Offer plus margin plus VAT; offers above the tier pay a share on top."""
    high = (offer * c.TIER_MULTIPLIER + c.FIXED_MARGIN) * c.VAT_MULTIPLIER
    low = (offer + c.FIXED_MARGIN) * c.VAT_MULTIPLIER
    return round_money(F.when(offer > c.TIER_OFFER, high).otherwise(low))


def company_margin(offer: Column) -> Column:
    share = round_money(offer * c.TIER_MARGIN_SHARE + c.FIXED_MARGIN)
    return F.when(offer > c.TIER_OFFER, share).otherwise(F.lit(c.FIXED_MARGIN))


def offers_compatible(driver_offer: Column, passenger_offer: Column,
                      share: float = c.MIN_OFFER_SHARE) -> Column:
    return passenger_offer >= driver_offer * F.lit(share)


def distance_fare(distance_km: Column, per_km: float = c.FARE_PER_KM) -> Column:
    return distance_km * F.lit(per_km)


def route_tariff(length_km: Column) -> Column:
    return length_km * F.lit(c.TARIFF_PER_KM)


def seat_offer(full_tariff: Column, seats: Column) -> Column:
    """Price of one seat; NULL for a car without seats."""
    return round_money(full_tariff / F.nullif(seats.cast("double"), F.lit(0.0)))
