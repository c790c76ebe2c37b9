"""Numeric columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles and kilometres per mile.
EARTH_MILES = 3961.0
KM_PER_MILE = 1.60934


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_add(*cols) -> Column:
    """Sum with NULL as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0)) for c in cols])


def safe_subtract(first, *rest) -> Column:
    return reduce(
        lambda a, b: a - F.coalesce(_c(b), F.lit(0)), rest, F.coalesce(_c(first), F.lit(0))
    )


def safe_divide(numerator, denominator) -> Column:
    """NULL on a zero denominator."""
    return F.try_divide(_c(numerator), _c(denominator))


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    a, b, c, d = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    miles = 2 * EARTH_MILES * F.asin(F.sqrt(h))
    return miles * KM_PER_MILE if unit == "km" else miles


def discounted_value(value, percent) -> Column:
    """Value after a percentage discount; the discount is held between 0 and 100 %."""
    p = F.least(F.greatest(F.coalesce(_c(percent), F.lit(0)), F.lit(0)), F.lit(100))
    return _c(value) * (1 - p / 100)


def weighted_ticket(value, percent, months) -> Column:
    """Mean monthly value over 12 months when a discount holds for the first ``months``."""
    held = F.least(F.greatest(F.coalesce(_c(months), F.lit(0)), F.lit(0)), F.lit(12))
    return (discounted_value(value, percent) * held + _c(value) * (12 - held)) / 12
