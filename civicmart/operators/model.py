"""Model building (M1-M6): dimensions, surrogate keys, fact load, constraint report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart import schema as S
from civicmart.operators.clean import year_window


def extract_locations(events: DataFrame) -> DataFrame:
    """Distinct (area_code, area_name) pairs; two names for one code give two rows."""
    return events.select("area_code", "area_name").distinct()


def build_dim_time(events: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """M1: distinct non-NULL years inside the window."""
    return year_window(events.select("year"), "year", lo, hi).distinct()


def build_dim_location(locations: DataFrame) -> DataFrame:
    """M2: dense 1-based ``location_id`` following area_code (then name) order.

    The unpartitioned window runs on the distinct locations only (one row per area).
    """
    order = Window.orderBy(F.asc_nulls_last("area_code"), F.asc_nulls_last("area_name"))
    return locations.select(F.row_number().over(order).cast("int").alias("location_id"),
                            F.col("area_code").cast("int").alias("area_code"), "area_name")


def merge_dim_location(stored: DataFrame, locations: DataFrame) -> DataFrame:
    """M2 over several loads: ``stored`` with the areas of ``locations`` whose code it lacks.

    Ids given before never change; new codes follow the largest id, in the order of their codes.
    ``area_code`` is unique, as the table declares: a code keeps the name it came with first
    (of several new names the smallest), and rows without a code get no key. The anti join and the
    unpartitioned row number see one row an area.
    """
    new = (locations.where(F.col("area_code").isNotNull()).groupBy(F.col("area_code").cast("int").alias("area_code"))
           .agg(F.min("area_name").alias("area_name"))
           .join(stored.select("area_code"), "area_code", "left_anti"))
    last = stored.agg(F.coalesce(F.max("location_id"), F.lit(0))).scalar()
    given = (last + F.row_number().over(Window.orderBy("area_code"))).cast("int")
    return stored.select("location_id", "area_code", "area_name").unionByName(
        new.select(given.alias("location_id"), "area_code", "area_name"))


def load_fact(staging: DataFrame, dim_location: DataFrame) -> DataFrame:
    """M3: look up ``location_id`` by area_code; unknown codes keep NULL (orphans).

    The name belongs to the key: a code with two names has two dimension rows, and a
    staging row meets one of them, so rows are never multiplied.
    """
    dim = dim_location.select(F.col("area_code").alias("_code"), F.col("area_name").alias("_name"),
                              "location_id").dropDuplicates(["_code", "_name"])
    joined = staging.join(dim, (F.col("area_code") == F.col("_code"))
                          & F.col("area_name").eqNullSafe(F.col("_name")), "left")
    return joined.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.FACT.fields])


def load_population(long: DataFrame, place: str) -> DataFrame:
    """M4: the yearly population of one place (two rows for a year fail ``pk_unique(year)``)."""
    return long.where(F.col("place") == F.lit(place)).select(
        F.col("year").cast("int").alias("year"), F.col("population").cast("bigint").alias("population"))


def load_unemployment(yearly: DataFrame) -> DataFrame:
    """M5: yearly rate with the table's types."""
    return yearly.select(F.col("year").cast("int").alias("year"),
                         F.col("unemployment_rate").cast("double").alias("unemployment_rate"))


def _row(table: str, constraint: str, violations) -> DataFrame:
    return violations.select(F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"),
                             F.col("v").cast("bigint").alias("violations"))


def _pk(df: DataFrame, table: str, key: str) -> DataFrame:
    """Uniqueness and NOT NULL of a key from one grouping: the NULL key is one group."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = groups.agg(
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("dup"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("nul"))
    return counts.select(F.explode(F.array(
        F.struct(F.lit(table).alias("table_name"), F.lit(f"pk_unique({key})").alias("constraint_name"),
                 F.col("dup").cast("bigint").alias("violations")),
        F.struct(F.lit(table).alias("table_name"), F.lit(f"pk_not_null({key})").alias("constraint_name"),
                 F.col("nul").cast("bigint").alias("violations")))).alias("r")).select("r.*")


def constraint_report(fact: DataFrame, dim_location: DataFrame, dim_time: DataFrame,
                      population: DataFrame, unemployment: DataFrame) -> DataFrame:
    """M6: ``(table_name, constraint_name, violations)`` for the DDL's PK, UNIQUE, NOT NULL, FK.

    The fact is scanned once for its NOT NULL and both foreign keys (left joins
    against distinct, marked dimension keys) and once more for the primary key,
    which needs a shuffle on ``crime_id``. A NULL foreign key is not an FK
    violation (it is counted by NOT NULL).
    """
    parts: list[DataFrame] = [
        _pk(dim_time, "dim_time", "year"),
        _pk(dim_location, "dim_location", "location_id"),
        _pk(population, "population", "year"),
        _pk(unemployment, "unemployment", "year"),
        _pk(fact, "fact", "crime_id"),
    ]
    code_dup = (dim_location.where(F.col("area_code").isNotNull()).groupBy("area_code")
                .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).agg(F.count(F.lit(1)).alias("v")))
    parts.append(_row("dim_location", "unique(area_code)", code_dup))
    dim_nulls = dim_location.agg(F.count_if(F.col("area_code").isNull()).alias("a"),
                                 F.count_if(F.col("area_name").isNull()).alias("b"))
    parts.append(_row("dim_location", "not_null(area_code)", dim_nulls.select(F.col("a").alias("v"))))
    parts.append(_row("dim_location", "not_null(area_name)", dim_nulls.select(F.col("b").alias("v"))))
    parts.append(_row("population", "not_null(population)",
                      population.agg(F.count_if(F.col("population").isNull()).alias("v"))))
    parts.append(_row("unemployment", "not_null(unemployment_rate)",
                      unemployment.agg(F.count_if(F.col("unemployment_rate").isNull()).alias("v"))))
    years = dim_time.select("year").distinct().withColumn("_y", F.lit(True))
    for table, df in (("population", population), ("unemployment", unemployment)):
        fk = (df.join(years, "year", "left")
              .agg(F.count_if(F.col("year").isNotNull() & F.col("_y").isNull()).alias("v")))
        parts.append(_row(table, "fk(year->dim_time)", fk))
    locs = dim_location.select("location_id").distinct().withColumn("_l", F.lit(True))
    scan = (fact.join(years, "year", "left").join(locs, "location_id", "left")
            .agg(F.count_if(F.col("year").isNull()).alias("ny"),
                 F.count_if(F.col("location_id").isNull()).alias("nl"),
                 F.count_if(F.col("year").isNotNull() & F.col("_y").isNull()).alias("fy"),
                 F.count_if(F.col("location_id").isNotNull() & F.col("_l").isNull()).alias("fl")))
    checks = [("not_null(year)", "ny"), ("not_null(location_id)", "nl"),
              ("fk(year->dim_time)", "fy"), ("fk(location_id->dim_location)", "fl")]
    parts.append(scan.select(F.explode(F.array(*[
        F.struct(F.lit("fact").alias("table_name"), F.lit(name).alias("constraint_name"),
                 F.col(c).cast("bigint").alias("violations")) for name, c in checks])).alias("r")
    ).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
