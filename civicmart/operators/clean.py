"""Row/column cleaners for the incident and labour-force exports.

Inputs are all-string frames (see ``sources.raw.read_raw_csv``); every
conversion is NULL-on-failure, never an error, like a coercing pandas parse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.functions.parse import (
    INCIDENT_TS_FORMAT,
    event_year,
    null_if_missing,
    parse_event_ts,
    to_integer,
    to_number,
)


def year_window(df: DataFrame, col: str = "year", lo: int | None = 2020, hi: int | None = None) -> DataFrame:
    """Keep ``lo <= col <= hi``; a NULL year fails the comparison and is dropped."""
    # Comparisons already drop NULL; IS NOT NULL is only needed without bounds.
    conds = []
    if lo is not None:
        conds.append(F.col(col) >= F.lit(lo))
    if hi is not None:
        conds.append(F.col(col) <= F.lit(hi))
    cond = F.col(col).isNotNull()
    if conds:
        cond = conds[0]
        for extra in conds[1:]:
            cond = cond & extra
    return df.where(cond)


def clean_incidents(raw: DataFrame, lo: int | None = 2020, hi: int | None = None,
                    ts_format: str = INCIDENT_TS_FORMAT) -> DataFrame:
    """Parse the occurrence timestamp, keep its year, window it, project + rename.

    Output has the staging shape: crime_id, year, area_code, area_name, crime_code,
    crime_desc, lat, lon.
    """
    # The year comes out of a generator: filters on it aren't rewritten into filters on the parse
    # above, so each timestamp is parsed once.
    year = event_year(parse_event_ts(F.col("`DATE OCC`"), ts_format))
    events = raw.select(
        to_integer(F.col("`DR_NO`")).alias("crime_id"),
        F.explode(F.array(year)).alias("year"),
        to_integer(F.col("`AREA`"), "int").alias("area_code"),
        null_if_missing(F.col("`AREA NAME`")).alias("area_name"),
        to_integer(F.col("`Crm Cd`"), "int").alias("crime_code"),
        null_if_missing(F.col("`Crm Cd Desc`")).alias("crime_desc"),
        to_number(F.col("`LAT`")).alias("lat"),
        to_number(F.col("`LON`")).alias("lon"),
    )
    return year_window(events, "year", lo, hi)


def clean_labour(raw: DataFrame, area: str, area_type: str, adjusted: str = "N",
                 lo: int | None = 2020, hi: int | None = None, scale: int | None = None) -> DataFrame:
    """Exact (case-sensitive, untrimmed) selection, numeric coercion, yearly mean.

    Non-numeric rates are skipped by the mean; rows whose year is not a number are
    dropped before grouping (a pandas group never holds a missing key); the year
    window applies to the grouped result.
    """
    picked = raw.where((F.col("`Area Name`") == F.lit(area))
                       & (F.col("`Area Type`") == F.lit(area_type))
                       & (F.col("`Seasonally Adjusted(Y/N)`") == F.lit(adjusted)))
    typed = picked.select(to_number(F.col("`Year`")).alias("year_num"),
                          to_number(F.col("`Unemployment Rate`")).alias("rate"))
    typed = typed.where(F.col("year_num").isNotNull())
    mean = F.avg("rate")
    if scale is not None:
        mean = F.round(mean, scale)
    yearly = (typed.groupBy("year_num").agg(mean.alias("unemployment_rate"))
              .select(F.col("year_num").cast("int").alias("year"), "unemployment_rate"))
    return year_window(yearly, "year", lo, hi)
