"""Audit-log refresh (R1-R4): a full refresh that keeps ``log_id`` growing.

Every refresh is a version of the log (``plans.versions``): rows go to a folder of their own, and
one marker file makes them current. Two refreshers at once can't harm each other: the slower one
finds its number taken, reads the last id that the other gave, and goes on from there, so ids of all
refreshes are disjoint and grow. A failed refresh leaves the previous run current. Old rows
disappear from view by construction (only one run is current); ``expire`` removes their files.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicmart import schema as S
from civicmart.plans import versions

log = logging.getLogger(__name__)

def audit_rows(kpi: DataFrame, prev_max_id: int = 0) -> DataFrame:
    """Audit projection of the yearly KPI; ``log_id`` continues after ``prev_max_id``.

    The unpartitioned row_number runs on the KPI frame, one row per year.
    """
    log_id = F.lit(int(prev_max_id)) + F.row_number().over(Window.orderBy("year"))
    return kpi.select(
        log_id.cast("int").alias("log_id"),
        F.current_timestamp().alias("refreshed_at"),
        F.col("year").cast("int").alias("year"),
        F.col("total_crimes").cast("bigint").alias("total_crimes"),
        F.col("crime_rate_per_100k").cast("decimal(10,2)").alias("crime_rate"),
        F.col("unemployment_rate").cast("decimal(10,4)").alias("unemployment"),
    )


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The commit log ``(run, folder, committed_at, last_id)``, empty before the first refresh."""
    return versions.history(spark, path)


def current_run(spark: SparkSession, path: str) -> int | None:
    version = versions.latest(path)
    return version.run if version else None


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The current audit log ordered by year (empty if never refreshed)."""
    version = versions.latest(path)
    if version is None:
        return spark.createDataFrame([], S.AUDIT_LOG)
    df = spark.read.schema(S.AUDIT_LOG).parquet(versions.data_path(path, version))
    return df.select(*S.AUDIT_LOG.fieldNames()).orderBy("year")


def refresh_audit(spark: SparkSession, kpi: DataFrame, path: str,
                  on_error: str = "keep_previous") -> int | None:
    """Write a new audit run from ``kpi`` (action); return the current run number.

    ``on_error='keep_previous'`` logs a failure and leaves the previous run current
    (the stand-alone job's rollback-and-continue); ``'raise'`` propagates it. A run that another
    refresher overtakes is written again with the ids that follow.
    """
    if on_error not in ("keep_previous", "raise"):
        raise ValueError(f"on_error must be 'keep_previous' or 'raise', got {on_error!r}")
    previous = versions.latest(path)

    def build(base: versions.Version | None, folder: str) -> int:
        given = base.last_id if base else 0
        audit_rows(kpi, given).coalesce(1).write.parquet(folder)
        last = spark.read.schema(S.AUDIT_LOG).parquet(folder).agg(F.max("log_id")).first()[0]
        return given if last is None else int(last)  # an empty run gives no id

    try:
        version = versions.commit(path, build)
    except Exception as exc:  # noqa: BLE001 - policy decides
        if on_error == "raise":
            raise
        log.error("audit refresh failed, keeping run %s: %s", previous.run if previous else None, exc)
        return previous.run if previous else None
    log.info("audit log refreshed: run %s, last log_id %s", version.run, version.last_id)
    return version.run
