"""Raw files -> cleaned outputs -> mart -> KPI, end to end through files."""

import os

from pyspark.sql import functions as F

from civicmart.operators import queries as Q
from civicmart.plans import etl
from civicmart.schema import INCIDENT_COLUMNS
from civicmart.sources import bindings as B
from civicmart.sources.mart import mart_from_tables
from civicmart.sources.sinks import write_frame
from civicmart.sources.tables import read_table
from paths import SF001


def _write_grid_files(grid_df, folder):
    os.makedirs(folder, exist_ok=True)
    for r in grid_df.select("file").distinct().collect():
        rows = grid_df.where(F.col("file") == r["file"]).orderBy("row_idx").collect()
        with open(os.path.join(folder, r["file"]), "w") as fh:
            for row in rows:
                fh.write(",".join(f'"{c}"' if c else "" for c in row["cells"]) + "\n")


def test_raw_files_to_mart_matches_bound_mart(spark, scratch):
    t = {n: read_table(spark, SF001, n) for n in ("orders", "customer", "nation", "region", "lineitem")}
    write_frame(B.render_raw_incidents(t["orders"], t["customer"], t["nation"]).coalesce(2),
                f"{scratch}/raw/incidents", "csv")
    write_frame(B.render_raw_labour(t["lineitem"]), f"{scratch}/raw/labour", "csv")
    _write_grid_files(B.render_population_grid(t["orders"], t["customer"], t["nation"], t["region"]),
                      f"{scratch}/raw/sheets")

    events, locations = etl.clean_incident_files(spark, f"{scratch}/raw/incidents", f"{scratch}/clean", lo=1995)
    etl.clean_labour_files(spark, f"{scratch}/raw/labour", f"{scratch}/clean/unemployment",
                           "N", "O", "N", lo=1995)
    rejected = etl.clean_population_files(spark, f"{scratch}/raw/sheets", f"{scratch}/clean/population",
                                          "two_row", B.BOUND_YEARS)
    assert rejected.count() == 0
    assert spark.read.parquet(locations).count() == 25
    wide = spark.read.parquet(f"{scratch}/clean/population/wide")
    assert wide.columns == ["place"] + [str(y) for y in B.BOUND_YEARS] and wide.count() == 25

    mart = etl.load_mart_files(spark, events, f"{scratch}/clean/population/long", f"{scratch}/clean/unemployment",
                               "NATION_7", f"{scratch}/mart")
    # incidents of status 'P' carry an unparseable timestamp and are dropped by the window
    bound = mart_from_tables(spark, SF001)
    kept = t["orders"].where(F.col("o_orderstatus") != "P").count()
    assert mart.fact.count() == kept
    got = {r["year"]: r["total_crimes"] for r in Q.by_year(mart.fact).collect()}
    want = {r["year"]: r["n"] for r in bound.fact.join(t["orders"].select(
        F.col("o_orderkey").alias("crime_id"), "o_orderstatus"), "crime_id")
        .where(F.col("o_orderstatus") != "P").groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want
    kpi = Q.yearly_kpi(mart.fact, mart.population, mart.unemployment).collect()
    assert len(kpi) == 7 and all(r["crime_rate_per_100k"] > 0 for r in kpi)


def test_sheet_converter_job(spark, scratch):
    os.makedirs(f"{scratch}/sheets")
    with open(f"{scratch}/sheets/a.csv", "w") as fh:
        fh.write('title,,\n"Geographic Area",,2020\nAlpha,,5\n')
    with open(f"{scratch}/sheets/bad.csv", "w") as fh:
        fh.write("no header here\n1,2\n")
    rejected = [r[0] for r in etl.convert_sheet_files(spark, f"{scratch}/sheets", f"{scratch}/out").collect()]
    assert [r.rsplit("/", 1)[1] for r in rejected] == ["bad.csv"]
    out = spark.read.parquet(f"{scratch}/out/cells")
    assert sorted((r["name"], r["value"]) for r in out.collect()) == [("2020", "5"), ("Geographic Area", "Alpha")]


def test_sheet_converter_writes_a_csv_per_sheet_that_reads_back(spark, scratch):
    """Sheets of one name in two folders, of different columns, with quotes, newlines and repeated headers."""
    for folder, text in (("x", 'title,,\n"Geographic Area",,2020\n"Al, pha",,5\n,,7\nBeta,,\n'),
                         ("y", '"Geographic Area",Base,Base,,"Two\nlines"\n"say ""hi""",1,2,3,"a\nb"\n')):
        os.makedirs(f"{scratch}/in/{folder}")
        with open(f"{scratch}/in/{folder}/a.csv", "w") as fh:
            fh.write(text)
    assert etl.convert_sheet_files(spark, f"{scratch}/in/*", f"{scratch}/out").count() == 0
    index = {r["file"].split("/")[-2]: r for r in spark.read.parquet(f"{scratch}/out/index").collect()}
    assert {k: (r["n_rows"], r["n_columns"]) for k, r in index.items()} == {"x": (2, 2), "y": (1, 5)}
    got = {k: spark.read.options(header=True, multiLine=True, escape='"').csv(f"{scratch}/out/sheets/sheet={r['sheet']}")
           for k, r in index.items()}
    assert got["x"].columns == ["Geographic Area", "2020"]
    assert [tuple(r) for r in got["x"].collect()] == [("Al, pha", "5"), ("Beta", None)]
    assert got["y"].columns == ["Geographic Area", "Base", "Base.1", "Unnamed: 3", "Two lines"]
    assert [tuple(r) for r in got["y"].collect()] == [('say "hi"', "1", "2", "3", "a\nb")]


def test_wide_output_keeps_rows_of_one_place_apart(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for name, rows in (("a", "A,1,5,6\nA,1,7,n/a\n"), ("b", "A,1,8,9.5\n")):
        with open(f"{scratch}/in/{name}.csv", "w") as fh:
            fh.write("place,base,2020,2021\n" + rows)
    etl.clean_population_files(spark, f"{scratch}/in", f"{scratch}/out", "years", [2020, 2021])
    wide = spark.read.parquet(f"{scratch}/out/wide")
    assert wide.columns == ["place", "2020", "2021"]
    assert sorted(map(tuple, wide.collect()), key=str) == [("A", 5.0, 6.0), ("A", 7.0, None), ("A", 8.0, 9.5)]


def test_location_ids_are_stable_over_loads(spark, scratch):
    schema = "area_code int, area_name string"
    first = etl.extend_dim_location(spark, f"{scratch}/dim", spark.createDataFrame([(7, "G"), (5, "E")], schema))
    assert sorted(map(tuple, first.collect())) == [(1, 5, "E"), (2, 7, "G")]
    more = spark.createDataFrame([(1, "A"), (7, "renamed"), (6, "F"), (6, "F2"), (None, "?")], schema)
    second = etl.extend_dim_location(spark, f"{scratch}/dim", more)
    assert sorted(map(tuple, second.collect())) == [(1, 5, "E"), (2, 7, "G"), (3, 1, "A"), (4, 6, "F")]
    assert sorted(map(tuple, etl.extend_dim_location(spark, f"{scratch}/dim", more).collect())) == \
        sorted(map(tuple, second.collect()))


def test_loads_at_once_give_a_code_one_id(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    schema = "area_code int, area_name string"
    loads = [spark.createDataFrame([(c, f"n{c}") for c in range(k, k + 4)], schema) for k in (0, 2, 4)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda d: etl.extend_dim_location(spark, f"{scratch}/dim", d).count(), loads))
    rows = etl.extend_dim_location(spark, f"{scratch}/dim", loads[0].limit(0)).collect()
    assert sorted(r["area_code"] for r in rows) == list(range(8))
    assert sorted(r["location_id"] for r in rows) == list(range(1, 9))


def test_etl_cli_incidents(spark, scratch):
    raw = spark.createDataFrame([("1", "01/08/2021 02:05:00 PM", "3", "Pacific", "510", "STOLEN", "34.0", "-118.0")],
                                ", ".join(f"`{c}` string" for c in INCIDENT_COLUMNS))
    write_frame(raw, f"{scratch}/in", "csv")
    assert etl.main(["incidents", "--src", f"{scratch}/in", "--dst", f"{scratch}/o", "--lo", "2020"]) == 0
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/o/locations").collect()] == [(3, "Pacific")]


def test_csv_outputs_read_back_typed(spark, scratch):
    raw = spark.createDataFrame([("1", "01/08/2021 02:05:00 PM", "3", "Pacific", "510", "STOLEN", "34.0", "-118.0")],
                                ", ".join(f"`{c}` string" for c in INCIDENT_COLUMNS))
    write_frame(raw, f"{scratch}/in", "csv")
    events, locations = etl.clean_incident_files(spark, f"{scratch}/in", f"{scratch}/o", fmt="csv")
    from civicmart.sources.mart import read_staging
    row = read_staging(spark, events, "csv").first()
    assert row["crime_id"] == 1 and row["year"] == 2021 and row["lat"] == 34.0
    os.makedirs(f"{scratch}/sheets")
    with open(f"{scratch}/sheets/a.csv", "w") as fh:
        fh.write('"Geographic Area",Base,2020,2021\nAlpha,1,5,6\n')
    etl.clean_population_files(spark, f"{scratch}/sheets", f"{scratch}/pop", "text", [2020, 2021], fmt="csv")
    wide = spark.read.option("header", True).csv(f"{scratch}/pop/wide").collect()
    assert [tuple(r) for r in wide] == [("Alpha", "5.0", "6.0")]


def test_etl_cli_all_subcommands(spark, scratch):
    from civicmart.schema import LABOUR_COLUMNS
    inc = spark.createDataFrame(
        [("1", "01/08/2021 02:05:00 PM", "3", "Pacific", "510", "STOLEN", "34.0", "-118.0"),
         ("2", "02/09/2021 03:05:00 AM", "3", "Pacific", "510", "STOLEN", "34.1", "-118.1")],
        ", ".join(f"`{c}` string" for c in INCIDENT_COLUMNS))
    write_frame(inc, f"{scratch}/inc", "csv")
    lab = spark.createDataFrame([("W", "State", "N", "2021", "4.5"), ("W", "State", "N", "2021", "5.5")],
                                ", ".join(f"`{c}` string" for c in LABOUR_COLUMNS))
    write_frame(lab, f"{scratch}/lab", "csv")
    os.makedirs(f"{scratch}/sheets")
    with open(f"{scratch}/sheets/a.csv", "w") as fh:
        fh.write('"Geographic Area",Base,2021\nTown,1,"1000"\n')
    assert etl.main(["incidents", "--src", f"{scratch}/inc", "--dst", f"{scratch}/o", "--lo", "2021"]) == 0
    assert etl.main(["labour", "--src", f"{scratch}/lab", "--dst", f"{scratch}/o/unemployment",
                     "--area", "W", "--area-type", "State", "--lo", "2021"]) == 0
    assert etl.main(["population", "--src", f"{scratch}/sheets", "--dst", f"{scratch}/o/pop",
                     "--mode", "text", "--years", "2021"]) == 0
    assert etl.main(["sheets", "--src", f"{scratch}/sheets", "--dst", f"{scratch}/o/sheets"]) == 0
    assert etl.main(["load", "--events", f"{scratch}/o/events", "--population", f"{scratch}/o/pop/long",
                     "--unemployment", f"{scratch}/o/unemployment", "--place", "Town",
                     "--dst", f"{scratch}/mart"]) == 0
    from civicmart.sources.mart import read_mart
    mart = read_mart(spark, f"{scratch}/mart")
    kpi = Q.yearly_kpi(mart.fact, mart.population, mart.unemployment).collect()
    assert [(r["year"], r["total_crimes"], r["population"], r["unemployment_rate"], r["crime_rate_per_100k"])
            for r in kpi] == [(2021, 2, 1000, 5.0, 200.0)]
