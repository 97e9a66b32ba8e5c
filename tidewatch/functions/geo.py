"""Great-circle distance as a native column expression."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # Fixed value: mean radius used by the location rule.


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres between two points; 0.0 if any coordinate is missing (NULL or NaN).

    The clamp to 1 (rounding can push the term above it for antipodes) stays
    inside the guard: ``least(1.0, NULL)`` is 1.0, which would turn "no previous
    point" into half the circumference of the earth.
    """
    missing = reduce(or_, [c.isNull() | F.isnan(c) for c in (lat1, lon1, lat2, lon2)])
    chord = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    arc = F.asin(F.least(F.lit(1.0), F.sqrt(chord)))
    return F.when(missing, F.lit(0.0)).otherwise(F.lit(2 * EARTH_RADIUS_KM) * arc)
