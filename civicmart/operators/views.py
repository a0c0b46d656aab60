"""The mart's views (V1-V6), aggregate-first.

Every per-area view counts the fact by ``location_id`` first (map-side partial
aggregation, so a hot area costs nothing extra and only one row per area and
task is shuffled) and only then meets the location dimension, which is small
and left to the planner's size-checked broadcast. Where the reference groups by
the area *name*, the per-id counts are summed again by name after the join, so
ids sharing a name merge exactly as in a join-then-group plan, and a dimension
key listed twice multiplies counts exactly as the join would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.functions.metrics import exact_mean, rate_per_100k

TOTAL = "total_crimes"


def count_by(df: DataFrame, *keys: str, alias: str = TOTAL) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def sum_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Re-sum per-id counts by ``keys`` (ids sharing a name merge)."""
    return df.groupBy(*keys).agg(F.sum(TOTAL).cast("bigint").alias(TOTAL))


def counts_with_area(fact: DataFrame, dim_location: DataFrame, *keys: str,
                     dim_cols: Sequence[str] = ("area_name",)) -> DataFrame:
    """Per-location counts (plus ``keys``) decorated with dimension columns; inner join."""
    per_id = count_by(fact.where(F.col("location_id").isNotNull()), "location_id", *keys)
    dim = dim_location.select("location_id", *[c for c in dim_cols if c != "location_id"])
    return per_id.join(dim, "location_id")


def yearly_kpi_view(fact: DataFrame, population: DataFrame, unemployment: DataFrame) -> DataFrame:
    """V1: year, total_crimes, population, unemployment_rate, crime_rate_per_100k.

    The fact is reduced to one row per year before the two joins; years absent
    from population or unemployment drop out, as with the reference's inner joins.
    """
    per_year = count_by(fact.where(F.col("year").isNotNull()), "year")
    kpi = per_year.join(population, "year").join(unemployment, "year")
    return kpi.select("year", TOTAL, "population", "unemployment_rate",
                      rate_per_100k(F.col(TOTAL), F.col("population")).alias("crime_rate_per_100k"))


def by_location(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """V2: location_id, area_code, area_name, total_crimes (observed areas only)."""
    keys = ("location_id", "area_code", "area_name")
    return sum_counts(counts_with_area(fact, dim_location, dim_cols=keys), *keys)


def by_type(fact: DataFrame) -> DataFrame:
    """V3: crime_code, crime_desc, total_crimes (NULL code/desc form their own group)."""
    return count_by(fact, "crime_code", "crime_desc")


def year_location(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """V4: year, area_name, total_crimes."""
    return sum_counts(counts_with_area(fact, dim_location, "year"), "year", "area_name")


def location_geo(fact: DataFrame, dim_location: DataFrame, scale: int = 4) -> DataFrame:
    """V5: location_id, area_name, avg_lat, avg_lon (AVG skips NULL coordinates).

    Averaged per location first (partial aggregation), then decorated. A mean
    is unchanged by the row duplication a join could introduce, so this equals
    averaging after the join, grouped by (location_id, area_name). Sums are exact decimals,
    so the mean is the same however the rows are partitioned.
    """
    per_id = (fact.where(F.col("location_id").isNotNull()).groupBy("location_id")
              .agg(exact_mean("lat").alias("avg_lat"), exact_mean("lon").alias("avg_lon")))
    joined = per_id.join(dim_location.select("location_id", "area_name"), "location_id")
    return joined.select("location_id", "area_name",
                         F.round("avg_lat", scale).alias("avg_lat"),
                         F.round("avg_lon", scale).alias("avg_lon")).distinct()


def area_year_matrix(fact: DataFrame, dim_location: DataFrame, years: Sequence[int]) -> DataFrame:
    """V6: one row per area, one column per listed year (NULL where no incident).

    The year list is explicit, so the pivot needs no extra job to find its values.
    """
    years = [int(y) for y in years]
    yl = year_location(fact.where(F.col("year").isin(years)), dim_location)
    wide = yl.groupBy("area_name").pivot("year", years).agg(F.sum(TOTAL))
    return wide.select("area_name", *[F.col(str(y)).cast("bigint").alias(str(y)) for y in years])
