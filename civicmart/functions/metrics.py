"""Indicator expressions: rate per 100k, percent variation, intensity level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's intensity thresholds (rate per 100,000 inhabitants).
HIGH_THRESHOLD = 6000
MEDIUM_THRESHOLD = 5000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _numeric(c: Column | str) -> Column:
    # Exact decimal operands, like a count cast to numeric, so no integer division
    # and no binary floating point before the final rounding.
    return _col(c).cast("decimal(20,0)")


def rate_per_100k(n: Column | str, population: Column | str, scale: int = 2) -> Column:
    """ROUND((n / population) * 100000, scale) computed in decimal, returned as DOUBLE.

    A zero or NULL population gives NULL instead of a division error.
    """
    ratio = F.try_divide(_numeric(n), _numeric(population))
    return F.round(ratio * F.lit(100000), scale).cast("double")


def variation_pct(current: Column | str, previous: Column | str, scale: int = 2) -> Column:
    """ROUND((current - previous) / NULLIF(previous, 0) * 100, scale) as DOUBLE.

    NULL when there is no previous value or it is zero.
    """
    prev = _numeric(previous)
    delta = _numeric(current) - prev
    return F.round(F.try_divide(delta, F.nullif(prev, F.lit(0))) * F.lit(100), scale).cast("double")


def intensity_level(rate: Column | str, high: float = HIGH_THRESHOLD,
                    medium: float = MEDIUM_THRESHOLD) -> Column:
    """'High' if rate >= high, 'Medium' if rate >= medium, else 'Low' (NULL rate -> 'Low')."""
    r = _col(rate)
    return F.when(r >= F.lit(high), "High").when(r >= F.lit(medium), "Medium").otherwise("Low")


def exact_mean(c: Column | str) -> Column:
    """Mean of a DOUBLE column (an aggregate) that doesn't depend on the order of its rows.

    Values are added as decimals of 10 places, which is exact and so order-free, and divided once. If one
    isn't finite, or is 1e18 or more in size, the sum of these is the mean.
    """
    c = _col(c)
    finite = F.abs(c) < F.lit(1e18)
    odd = F.sum(F.when(~finite, c))
    return F.coalesce(odd, F.sum(F.when(finite, c).cast("decimal(28,10)")).cast("double") / F.count(c))
