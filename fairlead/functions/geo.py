"""Geodesy on Columns: distances, bounding boxes, interpolation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairlead.config import EARTH_RADIUS_NM, METRES_PER_NM

# Widens search boxes so that rounding never loses a pair on the edge.
EDGE_PAD_DEG = 1e-9


def half_chord(d_lat: Column, d_lon: Column, cosines: Column) -> Column:
    """Half the angle between two points from their differences in radians.

    ``cosines`` is the product of the cosines of both latitudes.
    """
    chord = F.pow(F.sin(d_lat / 2), 2) + cosines * F.pow(F.sin(d_lon / 2), 2)
    # Rounding can push antipodal points just past 1, where asin is NaN.
    return F.nanvl(F.asin(F.sqrt(chord)), F.lit(math.pi / 2))


def great_circle_nm(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Haversine distance in nautical miles; NULL when any input is NULL."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    half_angle = half_chord(phi_b - phi_a, F.radians(lon_b - lon_a), F.cos(phi_a) * F.cos(phi_b))
    return half_angle * F.lit(2 * EARTH_RADIUS_NM)


def metres(distance_nm: Column) -> Column:
    return distance_nm * F.lit(METRES_PER_NM)


def bounding_box(lat: float, lon: float, radius_nm: float) -> tuple[float, float, float, float]:
    """(lat_min, lat_max, lon_min, lon_max) of the box around a circle.

    One degree of latitude counts 60 nm and longitude shrinks with the cosine
    of the centre. The box covers the circle for regional radii, not near the
    poles and not across the antimeridian.
    """
    half_height = radius_nm / 60.0
    half_width = radius_nm / (60.0 * math.cos(math.radians(lat)))
    return lat - half_height, lat + half_height, lon - half_width, lon + half_width


def reach_lat_deg(distance_nm: float, at_most: float) -> float:
    """Largest latitude difference two points ``distance_nm`` apart can have."""
    return min(at_most, math.degrees(distance_nm / EARTH_RADIUS_NM)) + EDGE_PAD_DEG


def reach_lon_deg(lat: Column, distance_nm: float, lat_reach: float, at_most: float) -> Column:
    """Largest longitude difference at ``lat``, never above ``at_most``.

    The other point may lie ``lat_reach`` closer to the pole, where meridians
    are closer together, so the bound is taken there.
    """
    poleward = F.radians(F.least(F.abs(lat) + F.lit(lat_reach), F.lit(90.0)))
    half_sine = F.lit(math.sin(distance_nm / EARTH_RADIUS_NM / 2))
    bound = F.degrees(2 * F.asin(half_sine / F.cos(poleward)))
    # NaN (everything is within reach near a pole) falls back to ``at_most``.
    return F.least(F.nanvl(bound, F.lit(at_most)), F.lit(at_most)) + F.lit(EDGE_PAD_DEG)


def lerp(start: Column, end: Column, fraction: Column) -> Column:
    return start + fraction * (end - start)


def leg_position(side: str, axis: str, at: Column) -> Column:
    """``axis`` (lat or lon) at a second of the leg whose columns begin with ``side``."""
    began, ended = F.col(f"{side}_start_ts"), F.col(f"{side}_end_ts")
    fraction = (at - began) / (ended - began)
    return lerp(F.col(f"{side}_start_{axis}"), F.col(f"{side}_end_{axis}"), fraction)


def bucket(value: Column, width: float | int) -> Column:
    """Index of the bucket of ``width`` that ``value`` falls into (bigint)."""
    return F.floor(value / F.lit(width))


def buckets_touched(low: Column, high: Column, width: float | int) -> Column:
    """Array with every bucket index from ``low`` to ``high``."""
    return F.sequence(bucket(low, width), bucket(high, width))
