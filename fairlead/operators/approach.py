"""When two vessels on straight legs are close, in closed form.

While two legs overlap, both vessels move linearly in degrees, so the offset
between them is linear in time and its squared length, with one fixed factor
for the longitudes, a parabola. With the least such factor the parabola lies
below the haversine measure at every second. The times at which it is
no higher than a distance that must not be exceeded are one interval, outside
which no second needs to be looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EARTH_RADIUS_NM, EncounterConfig
from fairlead.functions.frames import evaluated
from fairlead.functions.geo import great_circle_nm, leg_position

#: Keep distances on the safe side of rounding, relative and in radians (some micrometres):
#: differences of coordinates are exact to about 1e-15.
SLACK, TINY = 1e-9, 1e-12


def _offset(at: Column) -> tuple[Column, Column]:
    """Latitude and longitude of b less those of a, in radians, at a second."""
    lat, lon = (leg_position("b", axis, at) - leg_position("a", axis, at) for axis in ("lat", "lon"))
    return F.radians(lat), F.radians(lon)


def _squared(distance_nm: Column) -> Column:
    """(2 sin(angle / 2)) ** 2 for a distance and a trifle: grows with it and compares with the parabola."""
    angle = distance_nm / EARTH_RADIUS_NM * (1 + SLACK) + TINY
    return F.pow(2 * F.sin(angle / 2), 2)


def relative_motion(overlaps: DataFrame) -> DataFrame:
    """Adds offset ``x, y`` and its change per second ``u, v`` at the start of each overlap.

    ``factor`` is the least product of the cosines of both latitudes, ``flat``
    how much less than its argument a squared sine can be; ``span`` is
    the length in seconds.
    """
    start, end = F.col("overlap_start"), F.col("overlap_end")
    ends = overlaps.withColumn("span", end - start)
    for name, at in (("0", start), ("1", end)):
        x, y = _offset(at)
        ends = ends.withColumns({f"x{name}": x, f"y{name}": y})
    ends = evaluated(ends)

    def least_cosine(side: str) -> Column:
        return F.cos(F.radians(F.greatest(*(F.abs(leg_position(side, "lat", at)) for at in (start, end)))))

    widest = F.greatest(*(F.abs(c) for c in ("x0", "x1", "y0", "y1")))
    return ends.withColumns(
        {
            "u": (F.col("x1") - F.col("x0")) / F.col("span"),
            "v": (F.col("y1") - F.col("y0")) / F.col("span"),
            "factor": least_cosine("a") * least_cosine("b"),
            "flat": 1 - F.pow(widest, 2) / 12,
        }
    ).withColumnsRenamed({"x0": "x", "y0": "y"}).drop("x1", "y1")


def with_vertex(moving: DataFrame) -> DataFrame:
    """Adds the lowest point of the parabola: ``bend`` * (t - ``vertex``) ** 2 + ``lowest``.

    A parabola without bend, for vessels that keep their offset, is lowest at 0.
    """
    bend = F.pow("u", 2) + F.col("factor") * F.pow("v", 2)
    slope = F.col("x") * F.col("u") + F.col("factor") * F.col("y") * F.col("v")
    at = F.col("vertex")
    lowest = F.pow(F.col("x") + F.col("u") * at, 2) + F.col("factor") * F.pow(F.col("y") + F.col("v") * at, 2)
    bent = evaluated(moving.withColumn("bend", bend))
    turned = evaluated(bent.withColumn("vertex", F.coalesce(F.try_divide(-slope, F.col("bend")), F.lit(0.0))))
    return evaluated(turned.withColumn("lowest", lowest))


def with_interval(moving: DataFrame, highest: Column) -> DataFrame:
    """Seconds ``first`` to ``last`` of each overlap outside which the measure exceeds ``highest``.

    Overlaps without such seconds go. One more second on either side covers
    rounding; vessels so far apart that sines bend too much keep all seconds.
    """
    moving = evaluated(moving.withColumn("reach", highest / F.col("flat") - F.col("lowest")))
    reach = F.col("reach")
    half = F.when(F.col("bend") > 0, F.sqrt(F.greatest(reach, F.lit(0.0)) / F.col("bend"))).otherwise(math.inf)
    all_of_it = F.col("flat") < 0.5
    span = F.col("span").cast("double")
    # Clamped before rounding: an interval may reach far beyond the overlap.
    low = F.ceil(F.greatest(F.lit(0.0), F.least(span + 1, F.col("vertex") - half - 1)))
    high = F.floor(F.least(span, F.greatest(F.lit(-1.0), F.col("vertex") + half + 1)))
    found = moving.where(all_of_it | (reach >= 0)).withColumns(
        {
            "first": F.col("overlap_start") + F.when(all_of_it, 0).otherwise(low),
            "last": F.col("overlap_start") + F.when(all_of_it, F.col("span")).otherwise(high),
        }
    )
    return evaluated(found).where("first <= last")


def seconds_within(overlaps: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Overlaps with the interval that holds all their seconds within ``encounter_distance_m``."""
    limit = _squared(F.lit(cfg.encounter_distance_nm))
    return with_interval(with_vertex(relative_motion(overlaps)), limit).select(*overlaps.columns, "first", "last")


def seconds_of_closest(overlaps: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Overlaps with the interval that holds their closest seconds within ``encounter_distance_m``.

    The distance at the whole seconds around the vertex bounds the least one;
    the interval of what is no farther is mostly two or three seconds long,
    and long only for vessels that hardly change their offset.
    """
    moving = with_vertex(relative_motion(overlaps))
    inside = F.greatest(F.lit(0.0), F.least(F.col("span").cast("double"), F.col("vertex")))

    def distance(at: Column) -> Column:
        when = F.col("overlap_start") + at
        places = (leg_position(side, axis, when) for side in ("a", "b") for axis in ("lat", "lon"))
        return great_circle_nm(*places)

    best = F.least(distance(F.floor(inside)), distance(F.ceil(inside)), F.lit(cfg.encounter_distance_nm))
    bounded = evaluated(moving.withColumn("best", _squared(best)))
    return with_interval(bounded, F.col("best")).select(*overlaps.columns, "first", "last")
