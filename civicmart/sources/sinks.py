"""Sinks (S5, S8): overwrite a frame as parquet or header CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


# RFC 4180 quoting (a doubled quote inside a quoted field), for every reader and writer.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def write_frame(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Write ``df`` (action). ``mode='overwrite'`` is the drop-and-rebuild of the reference."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
