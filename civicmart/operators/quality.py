"""Data-quality checks (Q-NULL, Q-DIM, Q-DUP, Q-ORPH) as lazy DataFrames.

Each check is a single aggregate over its input; nothing is collected here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: Sequence[str], names: Mapping[str, str] | None = None,
                 total: str | None = "total_rows") -> DataFrame:
    """One row: ``total`` plus ``null_<col>`` (or ``names[col]``) per column, one pass."""
    names = dict(names or {})
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    aggs += [F.count_if(F.col(c).isNull()).alias(names.get(c, f"null_{c}")) for c in cols]
    return df.agg(*aggs)


def null_profile_union(entries: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows ``(table_name, null_count)``, one per ``(table_name, frame, column)``."""
    parts = [df.agg(F.count_if(F.col(col).isNull()).alias("null_count"))
             .select(F.lit(name).alias("table_name"), "null_count")
             for name, df, col in entries]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of occurrences.

    Partial aggregation combines a hot key map-side, so skew costs one row per task.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def duplicate_key_count(df: DataFrame, keys: Sequence[str], alias: str = "duplicate_keys") -> DataFrame:
    """Number of duplicated *keys* (not rows)."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias(alias))


def orphans(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Fact rows with no dimension row for ``on``; a NULL key counts (NOT EXISTS semantics)."""
    return fact.join(dim.select(on), on, "left_anti")


def orphan_count(fact: DataFrame, dim: DataFrame, on: str, alias: str = "orphan_crimes") -> DataFrame:
    return orphans(fact, dim, on).agg(F.count(F.lit(1)).alias(alias))


def fact_checks(fact: DataFrame, dim_location: DataFrame,
                null_cols: Sequence[str] = ("year", "location_id", "crime_desc")) -> DataFrame:
    """Null and orphan checks of the gate in one scan of the fact.

    The dimension keys are reduced to a distinct set with a marker first, so a
    left join cannot multiply fact rows; an unmatched or NULL key is an orphan.
    """
    keys = dim_location.select("location_id").distinct().withColumn("_known", F.lit(True))
    marked = fact.join(keys, "location_id", "left")
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_cols]
    aggs.append(F.count_if(F.col("_known").isNull()).alias("orphan_rows"))
    return marked.agg(*aggs)
