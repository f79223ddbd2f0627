"""Distances, location bins and WKT text as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from hopgrid.config import EARTH_RADIUS_KM, KM_PER_DEGREE, PICKUP_RADIUS_KM, WKT_NUMBER_PATTERN


def haversine_km(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """Great-circle distance in km."""
    half_dlon = F.sin((F.radians(lon_b) - F.radians(lon_a)) / 2)
    half_dlat = F.sin((F.radians(lat_b) - F.radians(lat_a)) / 2)
    chord = half_dlat * half_dlat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_dlon * half_dlon
    # At opposite ends of the globe rounding can lift the chord above 1, where asin is NaN.
    return F.nanvl(F.asin(F.sqrt(chord)), F.lit(math.pi / 2)) * 2.0 * EARTH_RADIUS_KM


def trip_distance_km(from_0: Column, from_1: Column, to_0: Column, to_1: Column) -> Column:
    """Distance as trips record it.

    Locations are ``[lon, lat]`` but trips have always been measured with the
    second element as longitude; stored distances must stay comparable. Use
    ``haversine_km`` for the geographic value.
    """
    return haversine_km(from_1, from_0, to_1, to_0)


def planar_km(a_0: Column, a_1: Column, b_0: Column, b_1: Column) -> Column:
    """Straight-line distance in degrees, scaled to km."""
    return F.sqrt((a_0 - b_0) * (a_0 - b_0) + (a_1 - b_1) * (a_1 - b_1)) * KM_PER_DEGREE


def within_pickup_radius(a_0: Column, a_1: Column, b_0: Column, b_1: Column,
                         radius_km: float = PICKUP_RADIUS_KM) -> Column:
    return planar_km(a_0, a_1, b_0, b_1) <= F.lit(radius_km)


def within_tolerance(a_0: Column, a_1: Column, b_0: Column, b_1: Column, tolerance: float) -> Column:
    return (F.abs(a_0 - b_0) <= F.lit(tolerance)) & (F.abs(a_1 - b_1) <= F.lit(tolerance))


def location_bin(coordinate: Column, bin_size: float) -> Column:
    """Bin index, truncated toward zero (so the bins touching 0 are double width)."""
    return (coordinate / F.lit(bin_size)).try_cast("bigint")


def bin_key(bin_0: Column, bin_1: Column) -> Column:
    return F.concat_ws("_", bin_0.cast("string"), bin_1.cast("string"))


def number_text(value: Column) -> Column:
    """Shortest decimal text of a double: plain from 1e-4 up, ``5e-05`` below.

    A cast alone would switch to ``5.0E-4`` below 1e-3 (positions near the
    meridian) and above 1e7.
    """
    size = F.abs(value)
    plain = F.call_function("format_number", value, F.lit("0.0###################"))
    small = F.call_function("format_number", value, F.lit("0.####################E00"))
    return (F.when((value == 0) | ((size >= 1e-3) & (size < 1e7)), value.cast("string"))
            .when(size >= 1e-4, plain)
            .otherwise(F.lower(small)))


def wkt_point(first: Column, second: Column) -> Column:
    # A lambda keeps the rarely used branches out of the generated loop, which
    # would otherwise grow past what the JVM compiles.
    return F.concat(F.lit("POINT("), F.array_join(F.transform(F.array(first, second), number_text), " "), F.lit(")"))


def trip_wkt(loc_0: Column, loc_1: Column) -> Column:
    """WKT as trips record it: second element of the location first."""
    return wkt_point(loc_1, loc_0)


def wkt_numbers(text: Column) -> Column:
    """All numbers found in a WKT text, as doubles (integers lose their sign)."""
    return F.transform(F.regexp_extract_all(text, F.lit(WKT_NUMBER_PATTERN), F.lit(1)),
                       lambda part: part.cast("double"))


def wkt_pair(text: Column) -> tuple[Column, Column]:
    numbers = wkt_numbers(text)
    return F.get(numbers, F.lit(0)), F.get(numbers, F.lit(1))


def curve_key(bin_0: Column, bin_1: Column) -> Column:
    """Bits of two bins by turns (Z-order): bins that are near in both axes are mostly near in the key.

    Bins beyond 2 ** 30 in size fold over; the key then orders them less well, nothing else.
    """
    def widened(step: int, mask: int):
        return lambda v: v.bitwiseOR(F.shiftleft(v, step)).bitwiseAND(F.lit(mask))

    def spread(x: Column) -> Column:
        x = (x + F.lit(1 << 30)).bitwiseAND(F.lit((1 << 31) - 1))
        for step, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                           (2, 0x3333333333333333), (1, 0x5555555555555555)):
            # A lambda evaluates its argument once; written out, each step would double the expression.
            x = F.get(F.transform(F.array(x), widened(step, mask)), F.lit(0))
        return x

    return spread(bin_0.cast("bigint")).bitwiseOR(F.shiftleft(spread(bin_1.cast("bigint")), 1))
