"""File-to-file cleaning jobs and the mart loader (entry point raw file -> mart).

Each job reads a folder, runs the lazy operators and writes with ``write_frame``
(actions). Outputs are parquet by default; pass ``fmt='csv'`` for header CSV.

    python -m civicmart.plans.etl incidents --src raw/incidents --dst out --lo 2020
    spark-submit --py-files civicmart.zip civicmart/plans/etl.py incidents --src ... --dst ...
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.operators import clean as C
from civicmart.operators import grid as G
from civicmart import schema as S
from civicmart.operators import model as M
from civicmart.plans import versions
from civicmart.schema import INCIDENT_COLUMNS, LABOUR_COLUMNS
from civicmart.sources.mart import Mart, materialize_mart, read_staging
from civicmart.sources.raw import read_grid, read_raw_csv
from civicmart.session import shared_dir
from civicmart.sources.sinks import write_frame


def clean_incident_files(spark: SparkSession, src: str, dst: str, lo: int | None = 2020,
                         hi: int | None = None, fmt: str = "parquet",
                         multi_line: bool = False) -> tuple[str, str]:
    """Raw incident CSVs -> ``dst/events`` (by year) and ``dst/locations``.

    ``multi_line``: fields may hold quoted line breaks (files are then not split).
    """
    events = C.clean_incidents(read_raw_csv(spark, src, INCIDENT_COLUMNS, multi_line), lo, hi)
    write_frame(events.hint("rebalance", "year"), f"{dst}/events", fmt, partition_by=["year"])
    events = read_staging(spark, f"{dst}/events", fmt)
    # the distinct pairs come from the written events (two columns), not a second parse
    locations = M.extract_locations(events).orderBy(F.asc_nulls_last("area_code"), "area_name")
    write_frame(locations.coalesce(1), f"{dst}/locations", fmt)
    return f"{dst}/events", f"{dst}/locations"


def clean_labour_files(spark: SparkSession, src: str, dst: str, area: str, area_type: str,
                       adjusted: str = "N", lo: int | None = 2020, hi: int | None = None,
                       fmt: str = "parquet", multi_line: bool = False) -> str:
    """Monthly labour CSVs -> yearly mean unemployment rate."""
    yearly = C.clean_labour(read_raw_csv(spark, src, LABOUR_COLUMNS, multi_line), area, area_type, adjusted, lo, hi)
    write_frame(yearly.coalesce(1), dst, fmt)
    return dst


def clean_population_files(spark: SparkSession, src: str, dst: str, mode: str, years: Sequence[int],
                           glob: str = "*.csv", fmt: str = "parquet",
                           header_row: int | None = None) -> DataFrame:
    """Population sheet exports -> ``dst/long``, ``dst/wide`` and ``dst/rejected``; returns the latter.

    A file is not used when it has no header row, no place column or no year
    column (see ``grid_rejects``); all of them are listed. The sheets are read once:
    the grid is stored in the shared folder for the passes over it.
    """
    shared_dir(spark)
    grid = read_grid(spark, src, glob=glob).checkpoint(eager=True)
    long = G.population_long(grid, mode, years, checkpoint=False, header_row=header_row)
    write_frame(long, f"{dst}/long", fmt)
    wide = G.population_wide(grid, mode, years, checkpoint=False, header_row=header_row)
    write_frame(wide.sortWithinPartitions("file", "row_idx").drop("file", "row_idx"), f"{dst}/wide", fmt)
    write_frame(G.grid_rejects(grid, mode, years, header_row), f"{dst}/rejected")
    return spark.read.schema("file string").parquet(f"{dst}/rejected")


def convert_sheet_files(spark: SparkSession, src: str, dst: str, glob: str = "*.csv") -> DataFrame:
    """The sheet converter over a folder of exported sheets; returns the files without a header.

    ``dst/sheets/sheet=<id>/`` holds the clean CSV of a sheet with its own header line and columns, one file
    a sheet (as its source is). ``dst/index`` tells the path, id, rows and columns of every sheet,
    ``dst/cells`` has all cells in long form, by the same id, and ``dst/rejected`` the files returned.
    """
    shared_dir(spark)
    grid = read_grid(spark, src, glob=glob).checkpoint(eager=True)
    lines = G.sheet_lines(grid, checkpoint=False).withColumn("sheet", G.sheet_id(F.col("file")))
    (lines.repartition("sheet").sortWithinPartitions("sheet", "row_idx").select("sheet", "line")
     .write.mode("overwrite").partitionBy("sheet").text(f"{dst}/sheets"))
    cells = G.sheet_cells(grid, checkpoint=False).withColumn("sheet", G.sheet_id(F.col("file")))
    write_frame(cells, f"{dst}/cells", partition_by=["sheet"])
    written = spark.read.parquet(f"{dst}/cells").groupBy("file", "sheet").agg(
        F.count_distinct("row_idx").alias("n_rows"), F.count_distinct("col_idx").alias("n_columns"))
    write_frame(written, f"{dst}/index")
    rejected = G.rejected_files(grid, G.find_header(grid, "text", scan_rows=G.CONVERTER_SCAN_ROWS))
    write_frame(rejected, f"{dst}/rejected")
    return spark.read.schema("file string").parquet(f"{dst}/rejected")


def build_mart(events: DataFrame, population_long: DataFrame, unemployment: DataFrame, place: str,
               lo: int | None = None, hi: int | None = None, dim_location: DataFrame | None = None) -> Mart:
    """The loader (M1-M5): events in the staging shape -> dimensions, fact, yearly measures."""
    if dim_location is None:
        dim_location = M.build_dim_location(M.extract_locations(events))
    return Mart(
        fact=M.load_fact(events, dim_location),
        dim_location=dim_location,
        dim_time=M.build_dim_time(events, lo, hi),
        population=M.load_population(population_long, place),
        unemployment=M.load_unemployment(unemployment),
    )


def extend_dim_location(spark: SparkSession, path: str, locations: DataFrame) -> DataFrame:
    """Add new areas to the dimension stored at ``path`` and return it; loads may run at once.

    Every load commits a version on top of the newest one, so two loads that meet the same new
    code give it one id.
    """
    locations = locations.select("area_code", "area_name")

    def build(base: versions.Version | None, folder: str) -> int:
        stored = (spark.createDataFrame([], S.DIM_LOCATION) if base is None
                  else spark.read.schema(S.DIM_LOCATION).parquet(versions.data_path(path, base)))
        M.merge_dim_location(stored, locations).repartition(1).write.parquet(folder)
        last = spark.read.schema(S.DIM_LOCATION).parquet(folder).agg(F.max("location_id")).first()[0]
        return int(last or 0)

    return spark.read.schema(S.DIM_LOCATION).parquet(versions.data_path(path, versions.commit(path, build)))


def load_mart_files(spark: SparkSession, events: str, population_long: str, unemployment: str,
                    place: str, dst: str, lo: int | None = None, hi: int | None = None,
                    keys: str | None = None) -> Mart:
    """Read cleaned outputs, build, write and check the mart; returns the mart read back.

    The location dimension is written and checked first, then the fact load joins the
    written table, whose true size the planner knows. Keys that the tables declare
    unique are refused when they repeat. ``keys``: a stored dimension that this load extends
    (``extend_dim_location``), so areas keep their ids over loads.
    """
    rows = spark.read.parquet(events)
    if keys is None:
        dim_path = f"{dst.rstrip('/')}/_load/dim_location"
        dim = M.build_dim_location(M.extract_locations(rows).where("area_code IS NOT NULL"))
        write_frame(dim.repartition(1), dim_path)
        dim = spark.read.schema(S.DIM_LOCATION).parquet(dim_path)
    else:
        dim = extend_dim_location(spark, keys, M.extract_locations(rows))
    repeated = [r.area_code for r in dim.groupBy("area_code").count().where("count > 1").orderBy("area_code")
                .select("area_code").collect()]  # at most the areas
    if repeated:
        raise ValueError(f"area codes with more than one name: {repeated}")
    mart = build_mart(rows, spark.read.parquet(population_long), spark.read.parquet(unemployment),
                      place, lo, hi, dim)
    written = materialize_mart(mart, dst)
    broken = [r for r in M.constraint_report(*written).where("violations > 0").collect()
              if r.constraint_name.startswith(("pk_", "unique"))]  # one row a constraint
    if broken:
        raise ValueError("constraints violated: " + ", ".join(
            f"{r.table_name}.{r.constraint_name} ({r.violations})" for r in broken))
    return written


def main(argv: list[str] | None = None) -> int:
    from civicmart.session import build_session

    ap = argparse.ArgumentParser(description="cleaning jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("incidents")
    a.add_argument("--src", required=True)
    a.add_argument("--dst", required=True)
    a.add_argument("--lo", type=int, default=2020)
    a.add_argument("--hi", type=int)
    a.add_argument("--multi-line", action="store_true", help="fields hold quoted line breaks")
    b = sub.add_parser("labour")
    for name in ("--src", "--dst", "--area", "--area-type"):
        b.add_argument(name, required=True)
    b.add_argument("--adjusted", default="N")
    b.add_argument("--lo", type=int, default=2020)
    b.add_argument("--hi", type=int)
    b.add_argument("--multi-line", action="store_true", help="fields hold quoted line breaks")
    c = sub.add_parser("population")
    c.add_argument("--src", required=True)
    c.add_argument("--dst", required=True)
    c.add_argument("--mode", default="text", choices=["text", "years", "two_row"])
    c.add_argument("--years", required=True, help="comma-separated, e.g. 2020,2021,2022,2023,2024")
    c.add_argument("--header-row", type=int, help="row index of the header in every sheet")
    d = sub.add_parser("sheets")
    d.add_argument("--src", required=True)
    d.add_argument("--dst", required=True)
    e = sub.add_parser("load")
    for name in ("--events", "--population", "--unemployment", "--place", "--dst"):
        e.add_argument(name, required=True)
    e.add_argument("--lo", type=int)
    e.add_argument("--hi", type=int)
    e.add_argument("--keys", help="folder of the stored location dimension that loads extend")
    args = ap.parse_args(argv)
    spark = build_session("civicmart-etl")
    if args.cmd == "incidents":
        clean_incident_files(spark, args.src, args.dst, args.lo, args.hi,
                             multi_line=args.multi_line)
    elif args.cmd == "labour":
        clean_labour_files(spark, args.src, args.dst, args.area, args.area_type, args.adjusted, args.lo, args.hi,
                           multi_line=args.multi_line)
    elif args.cmd == "population":
        years = [int(y) for y in args.years.split(",")]
        rejected = clean_population_files(spark, args.src, args.dst, args.mode, years,
                                          header_row=args.header_row)
        if n := rejected.count():
            raise SystemExit(f"{n} files not used (no header, place or year column), "
                             f"listed in {args.dst}/rejected")
    elif args.cmd == "sheets":
        rejected = convert_sheet_files(spark, args.src, args.dst)
        if n := rejected.count():
            raise SystemExit(f"{n} files without a header, listed in {args.dst}/rejected")
    elif args.cmd == "load":
        load_mart_files(spark, args.events, args.population, args.unemployment, args.place, args.dst,
                        args.lo, args.hi, args.keys)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
