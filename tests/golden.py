"""Golden mart at the published scale: 1,004,894 incidents generated with spark.range.

Yearly totals, unemployment and the top-3 areas and types are the published
values; populations are chosen inside the interval each published rate allows.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from civicmart.sources.mart import Mart

# Published results (year, total, population (derived), unemployment).
YEARS = [
    (2020, 199847, 3896329, 10.17),
    (2021, 209876, 3830986, 7.34),
    (2022, 235259, 3832997, 4.27),
    (2023, 232345, 3847427, 4.72),
    (2024, 127567, 3878702, 5.32),
]
TOP_AREAS = [("Central", 69668), ("77th Street", 61756), ("Pacific", 59513)]
TOP_TYPES = [("Vehicle Stolen", 115184), ("Battery Simple Assault", 74821), ("Burglary From Vehicle", 63515)]
N_ROWS = sum(t for _, t, _, _ in YEARS)
OTHER_AREAS = 18
OTHER_TYPES = 20
STRIDE = 7919  # coprime with N_ROWS: i * STRIDE mod N is a permutation of the rows


def _bucket(i: Column, sizes: list[int], n_rest: int, rest_total: int) -> Column:
    """Index of the block of ``i``: fixed-size leading blocks, then even blocks."""
    expr = None
    start = 0
    for idx, size in enumerate(sizes):
        cond = i < F.lit(start + size)
        expr = F.when(cond, F.lit(idx)) if expr is None else expr.when(cond, F.lit(idx))
        start += size
    rest = F.lit(len(sizes)) + ((i - F.lit(start)) * F.lit(n_rest) / F.lit(rest_total)).cast("int")
    return expr.otherwise(rest)


def golden_mart(spark: SparkSession, partitions: int = 8, copies: int = 1) -> Mart:
    """The golden mart; ``copies`` > 1 repeats the published distribution with new keys."""
    ids = spark.range(0, N_ROWS * copies, numPartitions=partitions * copies)
    i = F.col("id") % F.lit(N_ROWS)
    year_expr, start = None, 0
    for y, total, _, _ in YEARS:
        cond = i < F.lit(start + total)
        year_expr = F.when(cond, F.lit(y)) if year_expr is None else year_expr.when(cond, F.lit(y))
        start += total
    area_sizes = [n for _, n in TOP_AREAS]
    type_sizes = [n for _, n in TOP_TYPES]
    area_idx = _bucket(i, area_sizes, OTHER_AREAS, N_ROWS - sum(area_sizes))
    perm = (i * F.lit(STRIDE)) % F.lit(N_ROWS)
    type_idx = _bucket(perm, type_sizes, OTHER_TYPES, N_ROWS - sum(type_sizes))
    type_names = [n for n, _ in TOP_TYPES] + [f"Type {k:02d}" for k in range(len(TOP_TYPES) + 1, len(TOP_TYPES) + 1 + OTHER_TYPES)]
    fact = ids.select(
        (F.col("id") + F.lit(200000000)).alias("crime_id"),
        year_expr.cast("int").alias("year"),
        (area_idx + 1).cast("int").alias("location_id"),
        (type_idx + 100).cast("int").alias("crime_code"),
        F.element_at(F.array(*[F.lit(n) for n in type_names]), (type_idx + 1).cast("int")).alias("crime_desc"),
        (F.lit(34.0) + (i % 1000) / 10000.0).alias("lat"),
        (F.lit(-118.0) - (i % 997) / 10000.0).alias("lon"),
    )
    area_names = [n for n, _ in TOP_AREAS] + [f"Area {k:02d}" for k in range(len(TOP_AREAS) + 1, len(TOP_AREAS) + 1 + OTHER_AREAS)]
    dim = spark.createDataFrame([(k + 1, k + 1, n) for k, n in enumerate(area_names)],
                                "location_id int, area_code int, area_name string")
    pop = spark.createDataFrame([(y, p) for y, _, p, _ in YEARS], "year int, population bigint")
    unemp = spark.createDataFrame([(y, u) for y, _, _, u in YEARS], "year int, unemployment_rate double")
    dim_time = spark.createDataFrame([(y,) for y, *_ in YEARS], "year int")
    return Mart(fact=fact, dim_location=dim, dim_time=dim_time, population=pop, unemployment=unemp)
