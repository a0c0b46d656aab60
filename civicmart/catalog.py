"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Analytic queries read the mart materialized once per application from the
driver tables (``mart_for``); cleaning and loading queries run their operators
on inputs rendered from the same tables. Parameters that mirror the reference's
constants are bound to this data set here (years 1995-2001, sample year 1998,
intensity thresholds 1020 / 900).

Every query reads its tables whole: no key subset, sample or row cap is used
to make a check cheaper. LIMIT appears only where it is the feature (the
10-row sample and year preview, top-5 lists).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.operators import clean as C
from civicmart.operators import grid as G
from civicmart.operators import model as M
from civicmart.operators import quality as QC
from civicmart.operators import queries as Q
from civicmart.operators import views as V
from civicmart.functions.parse import to_integer, to_number
from civicmart.plans.etl import clean_incident_files, convert_sheet_files, extend_dim_location
from civicmart.plans.job import GateError, read_ledger, run_batch
from civicmart.plans.refresh import audit_rows, read_audit, refresh_audit, run_log
from civicmart.plans.versions import expire
from civicmart.schema import INCIDENT_COLUMNS, LABOUR_COLUMNS
from civicmart.session import scratch_root
from civicmart.sources import bindings as B
from civicmart.sources.mart import Mart, keyed_dim_for, mart_for, read_staging, staging_for
from civicmart.sources.raw import head_lines, profile_raw, read_grid, read_raw_csv, read_raw_csv_lenient
from civicmart.sources.sinks import CSV_OPTIONS, write_frame
from civicmart.sources.store import listed
from civicmart.sources.tables import read_table

# Fixed values of this data binding (the reference uses 2020-2024, 2022, 6000 / 5000).
YEARS = B.BOUND_YEARS
SAMPLE_YEAR = 1998
HIGH, MEDIUM = 1020, 900
WINDOW = (1995, 2000)
PLACE = "NATION_0"
NULL_COLS = ["year", "location_id", "crime_code", "crime_desc", "lat", "lon"]

Query = Callable[[SparkSession, str], DataFrame]


def _kpi(spark: SparkSession, d: str) -> DataFrame:
    m = mart_for(spark, d)
    return V.yearly_kpi_view(m.fact, m.population, m.unemployment)


def _tables(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, d, n) for n in names]


def _staging(spark: SparkSession, d: str) -> DataFrame:
    return staging_for(spark, d)


def _incidents(spark: SparkSession, d: str) -> DataFrame:
    raw = B.render_raw_incidents(*_tables(spark, d, "orders", "customer", "nation"))
    return C.clean_incidents(raw, lo=WINDOW[0], hi=WINDOW[1])


def _grid(spark: SparkSession, d: str) -> DataFrame:
    return B.render_population_grid(*_tables(spark, d, "orders", "customer", "nation", "region"), years=YEARS)


def _keyed_dim(spark: SparkSession, d: str) -> DataFrame:
    return M.build_dim_location(M.extract_locations(_staging(spark, d)))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _csv_incidents(spark: SparkSession, d: str) -> DataFrame:
    """Raw incidents to CSV, the file job over them, and its CSV output read as staging."""
    src, dst = _folder(spark, "raw-incidents"), _folder(spark, "incidents")
    write_frame(B.render_raw_incidents(*_tables(spark, d, "orders", "customer", "nation")), src, "csv")
    clean_incident_files(spark, src, dst, *WINDOW, fmt="csv")
    return read_staging(spark, f"{dst}/events", "csv")


def _csv_labour(spark: SparkSession, d: str) -> DataFrame:
    """Raw labour rows to CSV, read back by name and cleaned."""
    src = _folder(spark, "raw-labour")
    write_frame(B.render_raw_labour(read_table(spark, d, "lineitem")), src, "csv")
    return C.clean_labour(read_raw_csv(spark, src, LABOUR_COLUMNS), B.LABOUR_AREA, B.LABOUR_AREA_TYPE,
                          "N", lo=WINDOW[0], scale=4)


def _csv_population(spark: SparkSession, d: str) -> DataFrame:
    """One headerless CSV folder per sheet, read as grids of whole width and cleaned."""
    return G.population_long(read_grid(spark, _write_sheets(spark, d)), "text", YEARS)


def _csv_profile(spark: SparkSession, d: str) -> DataFrame:
    """The raw incident files' rows and width, summed over the files Spark wrote."""
    src = _folder(spark, "raw-profile")
    write_frame(B.render_raw_incidents(*_tables(spark, d, "orders", "customer", "nation")), src, "csv")
    return profile_raw(spark, src).agg(F.sum("n_rows").alias("n_rows"), F.max("n_columns").alias("n_columns"))


def _audit_refreshes(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "audit")
    for kpi in (_kpi(spark, d), _kpi(spark, d).limit(0), _kpi(spark, d)):
        refresh_audit(spark, kpi, path, on_error="raise")
    return read_audit(spark, path).withColumn("refreshed", F.col("refreshed_at").isNotNull()).drop("refreshed_at")


def _audit_concurrent(spark: SparkSession, d: str) -> DataFrame:
    """R2: two refreshers at once; the rows of both runs, by the commit log."""
    path, kpi = _folder(spark, "audit"), _kpi(spark, d)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda _: refresh_audit(spark, kpi, path, on_error="raise"), range(2)))
    runs = [spark.read.parquet(f"{path}/{r.folder}").withColumn("run", F.lit(r.run))
            for r in run_log(spark, path).collect()]  # two rows
    return runs[0].unionByName(runs[1]).select("run", "log_id", "year", "total_crimes")


def _audit_expired(spark: SparkSession, d: str) -> DataFrame:
    """Three refreshes, the older two expired; which runs' rows are still there."""
    path, kpi = _folder(spark, "audit"), _kpi(spark, d)
    for _ in range(3):
        refresh_audit(spark, kpi, path, on_error="raise")
    expire(path, keep=1)
    there = [f.base_name for f in listed(path)]
    return run_log(spark, path).select("run", F.col("folder").isin(there).alias("kept"), "last_id")


def _overwritten(spark: SparkSession, d: str) -> DataFrame:
    """A table written over another of other columns; only the new one is read back."""
    path, m = _folder(spark, "rebuilt"), mart_for(spark, d)
    write_frame(V.by_location(m.fact, m.dim_location), path)
    write_frame(V.by_type(m.fact), path)
    return spark.read.parquet(path)


def _dim_location_incremental(spark: SparkSession, d: str) -> DataFrame:
    """M2: two loads of the location dimension; the areas of the first keep their ids."""
    path, areas = _folder(spark, "dim-location"), M.extract_locations(_staging(spark, d))
    extend_dim_location(spark, path, areas.where(F.col("area_code") > 12))
    return extend_dim_location(spark, path, areas)


def _population_wide(spark: SparkSession, d: str) -> DataFrame:
    """The wide output of sheets that name their places twice, once in each of two files."""
    grid = _grid(spark, d)
    again = grid.withColumn("file", F.concat(F.lit("again_"), "file"))
    return G.population_wide(grid.unionByName(again), "two_row", YEARS)


def _write_sheets(spark: SparkSession, d: str) -> str:
    """One headerless CSV folder per sheet."""
    src, grid = _folder(spark, "sheets"), _grid(spark, d)
    width = grid.agg(F.max(F.size("cells"))).first()[0]
    (grid.repartition("file").sortWithinPartitions("file", "row_idx")
     .select("file", *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(width)])
     .write.partitionBy("file").options(**CSV_OPTIONS).option("header", False).csv(src))
    return f"{src}/*"


def _sheet_csv(spark: SparkSession, d: str) -> DataFrame:
    """The converter job, and each sheet's CSV read back by its own header."""
    dst = _folder(spark, "converted")
    convert_sheet_files(spark, _write_sheets(spark, d), dst)
    out = None
    for r in spark.read.parquet(f"{dst}/index").collect():  # one row a sheet
        sheet = spark.read.options(**CSV_OPTIONS).option("header", True).csv(f"{dst}/sheets/sheet={r.sheet}")
        part = sheet.select(F.col("Geographic Area").alias("place"), F.col("Estimates Base").alias("base"),
                            *[F.col(c).alias(f"y{y}") for y, c in zip(YEARS, sheet.columns[2:], strict=True)])
        out = part if out is None else out.unionByName(part)
    return out


def _unlike_files(spark: SparkSession, d: str) -> str:
    """Incident files that differ: columns in another order, rows with a field less or more, other tables."""
    src = _folder(spark, "unlike")
    raw = B.render_raw_incidents(*_tables(spark, d, "orders", "customer", "nation"))
    status, priority = F.substring(F.col("`Crm Cd Desc`"), -1, 1), F.substring(F.col("`Crm Cd Desc`"), 1, 1)
    write_frame(raw.where(status == "F"), f"{src}/plain", "csv")
    write_frame(raw.where(status == "O").select(*[f"`{c}`" for c in reversed(raw.columns)]), f"{src}/turned", "csv")
    write_frame(read_table(spark, d, "nation").coalesce(1), f"{src}/other", "csv")
    fields = F.transform(F.array(*[F.coalesce(f"`{c}`", F.lit("")) for c in raw.columns]), lambda c: F.when(
        c.contains(","), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c))
    uneven = (F.when(priority == "1", F.slice(fields, 1, 7)).when(priority == "2", F.concat(fields, F.array(F.lit("z"))))
              .otherwise(fields))
    lines = raw.where(status == "P").select(F.col("AREA").alias("area"), F.lit(1).alias("at"),
                                            F.array_join(uneven, ",").alias("line"))
    heads = lines.select("area").distinct().select("area", F.lit(0).alias("at"), F.lit(",".join(raw.columns)).alias("line"))
    (lines.unionByName(heads).repartition("area").sortWithinPartitions("area", "at").select("area", "line")
     .write.partitionBy("area").text(f"{src}/uneven"))
    return f"{src}/{{plain,turned,other,uneven/*}}"


def _csv_lenient(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = read_raw_csv_lenient(spark, _unlike_files(spark, d), INCIDENT_COLUMNS)
    return rows.select(to_integer(F.col("DR_NO")).alias("crime_id"), to_number(F.col("LAT")).alias("lat"),
                       to_number(F.col("LON")).alias("lon"))


def _csv_rejects(spark: SparkSession, d: str) -> DataFrame:
    _, rejects = read_raw_csv_lenient(spark, _unlike_files(spark, d), INCIDENT_COLUMNS)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _csv_head(spark: SparkSession, d: str) -> DataFrame:
    """The first three lines of each file; a file holds the incidents of a year by number."""
    src = _folder(spark, "by-year")
    rows = mart_for(spark, d).fact.select("year", "crime_id", "crime_desc", "lat")
    (rows.repartition("year").sortWithinPartitions("year", "crime_id")
     .write.partitionBy("year").options(**CSV_OPTIONS).option("header", True).csv(src))
    heads = head_lines(spark, f"{src}/*", 3)
    year = F.regexp_extract("file", r"year=(\d+)", 1).cast("int")
    return heads.select(year.alias("year"), "line_no", "line")


def _line_mart(spark: SparkSession, d: str) -> Mart:
    """A mart whose fact has a row per order line, so its keys repeat."""
    line, supplier = _tables(spark, d, "lineitem", "supplier")
    fact = line.join(supplier, line["l_suppkey"] == supplier["s_suppkey"], "left").select(
        F.col("l_orderkey").alias("crime_id"), F.year("l_shipdate").alias("year"),
        F.col("s_nationkey").cast("int").alias("location_id"), F.col("l_linenumber").cast("int").alias("crime_code"),
        F.col("l_returnflag").alias("crime_desc"), F.col("l_quantity").cast("double").alias("lat"),
        F.col("l_discount").cast("double").alias("lon"))
    return mart_for(spark, d)._replace(fact=fact)


def _gate_ledger(spark: SparkSession, d: str, policy: str) -> DataFrame:
    """Q-WARN, Q-FAIL, R5: a batch job on a fact with repeated keys, and what its ledger says."""
    path = _folder(spark, "gated")
    try:
        run_batch(spark, _line_mart(spark, d), path, policy)
    except GateError:
        pass
    return read_ledger(spark, path).drop("job")


def _refresh_ledger(spark: SparkSession, d: str) -> DataFrame:
    """A batch job, and one whose refresh fails while it writes; the first run stays current."""
    path, mart = _folder(spark, "failing"), mart_for(spark, d)
    run_batch(spark, mart, path, "warn", job="first")
    broken = F.when(F.col("population") >= 0, F.raise_error(F.lit("write fails")).cast("bigint"))
    run_batch(spark, mart._replace(population=mart.population.withColumn("population", broken)), path, job="second")
    audit = read_audit(spark, path)
    return read_ledger(spark, path).where(F.col("name") == "refresh").select(
        "job", "violations", "action", audit.agg(F.count(F.lit(1))).scalar().alias("audit_rows"),
        audit.agg(F.max("log_id")).scalar().alias("last_id"))


def queries() -> dict[str, Query]:
    mf = mart_for
    return {
        # N1-N13
        "sample_rows": lambda s, d: Q.sample_rows(mf(s, d).fact),
        "rows_of_year": lambda s, d: Q.rows_of_year(mf(s, d).fact, SAMPLE_YEAR),
        "by_year": lambda s, d: Q.by_year(mf(s, d).fact),
        "by_area": lambda s, d: Q.by_area(mf(s, d).fact, mf(s, d).dim_location),
        "rate_by_year": lambda s, d: Q.rate_by_year(mf(s, d).fact, mf(s, d).population),
        "yearly_kpi": lambda s, d: Q.yearly_kpi(mf(s, d).fact, mf(s, d).population, mf(s, d).unemployment),
        "top_areas": lambda s, d: Q.top_areas(mf(s, d).fact, mf(s, d).dim_location),
        "top_types": lambda s, d: Q.top_types(mf(s, d).fact),
        "areas_above_avg_having": lambda s, d: Q.areas_above_average(mf(s, d).fact, mf(s, d).dim_location, "name"),
        "areas_above_avg_theta": lambda s, d: Q.areas_above_average(mf(s, d).fact, mf(s, d).dim_location, "id"),
        "intensity_level": lambda s, d: Q.intensity_by_year(_kpi(s, d), HIGH, MEDIUM),
        "annual_variation_inline": lambda s, d: Q.annual_variation_inline(_kpi(s, d)),
        "annual_variation_cte": lambda s, d: Q.annual_variation(_kpi(s, d)),
        "area_by_year": lambda s, d: Q.area_by_year(mf(s, d).fact, mf(s, d).dim_location),
        "top_type_per_area": lambda s, d: Q.top_type_per_area(mf(s, d).fact, mf(s, d).dim_location),
        # V2-V6
        "by_location": lambda s, d: V.by_location(mf(s, d).fact, mf(s, d).dim_location),
        "by_type": lambda s, d: V.by_type(mf(s, d).fact),
        "location_geo": lambda s, d: V.location_geo(mf(s, d).fact, mf(s, d).dim_location),
        "area_year_matrix": lambda s, d: V.area_year_matrix(mf(s, d).fact, mf(s, d).dim_location, YEARS),
        # Quality gates, constraint report, audit projection
        "null_profile": lambda s, d: QC.null_profile(mf(s, d).fact, NULL_COLS),
        "dim_null_profile": lambda s, d: QC.null_profile_union([
            ("population", mf(s, d).population, "population"),
            ("unemployment", mf(s, d).unemployment, "unemployment_rate"),
            ("dim_location", mf(s, d).dim_location, "area_name")]),
        "duplicate_keys": lambda s, d: QC.duplicate_keys(read_table(s, d, "lineitem"),
                                                         ["l_orderkey", "l_linenumber"]),
        "duplicate_key_count": lambda s, d: QC.duplicate_key_count(read_table(s, d, "lineitem"),
                                                                   ["l_orderkey", "l_linenumber"]),
        "fact_duplicate_keys": lambda s, d: QC.duplicate_keys(mf(s, d).fact, ["crime_id"]),
        "orphan_count": lambda s, d: QC.orphan_count(*_tables(s, d, "documents", "labels"), "doc_id",
                                                     alias="orphan_documents"),
        "fact_orphan_count": lambda s, d: QC.orphan_count(mf(s, d).fact, mf(s, d).dim_location, "location_id"),
        "gate_checks": lambda s, d: QC.fact_checks(mf(s, d).fact, mf(s, d).dim_location),
        "constraint_report": lambda s, d: M.constraint_report(*mf(s, d)),
        "audit_log": lambda s, d: audit_rows(_kpi(s, d), 0).drop("refreshed_at"),
        # Cleaning (C1-C9) on rendered raw rows
        "clean_incidents": _incidents,
        "dim_location_extract": lambda s, d: M.extract_locations(_incidents(s, d)),
        "clean_labour": lambda s, d: C.clean_labour(B.render_raw_labour(read_table(s, d, "lineitem")),
                                                    B.LABOUR_AREA, B.LABOUR_AREA_TYPE, "N",
                                                    lo=WINDOW[0], scale=4),
        # Sheet cleaning (C10-C25) on rendered population sheets
        "grid_header_rows": lambda s, d: G.find_header(_grid(s, d), "text"),
        "grid_to_long": lambda s, d: G.population_long(_grid(s, d), "text", YEARS),
        "population_long": lambda s, d: G.population_long(_grid(s, d), "years", YEARS),
        "population_long_two_row": lambda s, d: G.population_long(_grid(s, d), "two_row", YEARS),
        "sheet_cells": lambda s, d: G.sheet_cells(_grid(s, d)),
        # Model building (M1-M3)
        "dim_time": lambda s, d: M.build_dim_time(mf(s, d).fact, *WINDOW),
        "dim_location_keyed": _keyed_dim,
        "fact_load": lambda s, d: M.load_fact(_staging(s, d), keyed_dim_for(s, d)),
        # M4, M5: the yearly measures with their tables' types
        "load_population": lambda s, d: M.load_population(
            G.population_long(_grid(s, d), "years", YEARS), PLACE),
        "load_unemployment": lambda s, d: M.load_unemployment(mf(s, d).unemployment),
        # Two refreshes, an empty one in between; ids go on
        "audit_refreshes": _audit_refreshes,
        # File to file: rendered tables written as CSV, read by the file readers, cleaned
        "csv_incidents": _csv_incidents,
        "csv_labour": _csv_labour,
        "csv_population": _csv_population,
        "csv_profile": _csv_profile,
        "csv_head": _csv_head,
        "csv_lenient": _csv_lenient,
        "csv_rejects": _csv_rejects,
        "sheet_csv": _sheet_csv,
        "population_wide": _population_wide,
        # M2, R2, R3, R5, S8, Q-WARN, Q-FAIL: keys and logs over several loads, gates and their ledger
        "dim_location_incremental": _dim_location_incremental,
        "audit_concurrent": _audit_concurrent,
        "audit_expired": _audit_expired,
        "overwritten_table": _overwritten,
        "gate_ledger_warn": lambda s, d: _gate_ledger(s, d, "warn"),
        "gate_ledger_fail": lambda s, d: _gate_ledger(s, d, "fail"),
        "refresh_ledger": _refresh_ledger,
    }
