"""Hand-written edge frames: NULLs, ties, orphans, gaps, zero denominators, bad headers."""

from pyspark.sql import functions as F

from civicmart import schema as S
from civicmart.operators import clean as C
from civicmart.operators import grid as G
from civicmart.operators import model as M
from civicmart.operators import quality as QC
from civicmart.operators import queries as Q
from civicmart.operators import views as V


def _fact(spark, rows):
    return spark.createDataFrame(rows, S.FACT)


def _dim(spark, rows):
    return spark.createDataFrame(rows, S.DIM_LOCATION)


def _grid(spark, files):
    rows = [(f, i, cells) for f, lines in files.items() for i, cells in enumerate(lines)]
    return spark.createDataFrame(rows, S.GRID)


def test_unparseable_timestamp_dropped_by_window(spark):
    raw = spark.createDataFrame([
        ("1", "01/08/2020 02:05:00 PM", "1", "Central", "510", "VEHICLE - STOLEN", "34.1", "-118.2"),
        ("2", "garbage", "1", "Central", "510", "VEHICLE - STOLEN", "34.1", "-118.2"),
        ("3", None, "1", "Central", "510", "VEHICLE - STOLEN", "34.1", "-118.2"),
        ("4", "12/31/2019 11:00:00 PM", "1", "Central", "510", "VEHICLE - STOLEN", "NA", ""),
    ], S.RAW_INCIDENT)
    out = C.clean_incidents(raw, lo=2020).collect()
    assert [r["crime_id"] for r in out] == [1]
    assert out[0]["year"] == 2020 and out[0]["lat"] == 34.1


def test_non_numeric_rate_skipped_in_mean(spark):
    raw = spark.createDataFrame([
        ("Westland", "State", "N", "2020", "10.0"),
        ("Westland", "State", "N", "2020", "n/a"),
        ("Westland", "State", "N", "2020", "12.0"),
        ("Westland", "State", "Y", "2020", "99.0"),
        ("westland", "State", "N", "2020", "99.0"),
        ("Westland", "State", "N", "x", "99.0"),
        ("Westland", "State", "N", "2019", "5.0"),
    ], S.RAW_LABOUR)
    out = C.clean_labour(raw, "Westland", "State", "N", lo=2020).collect()
    assert [(r["year"], r["unemployment_rate"]) for r in out] == [(2020, 11.0)]


def test_orphan_null_location_semantics(spark):
    fact = _fact(spark, [(1, 2020, 1, 1, "a", 1.0, 1.0), (2, 2020, 1, 1, "a", 1.0, 1.0),
                         (3, 2020, 2, 1, "b", 1.0, 1.0), (4, 2020, None, 1, "b", 1.0, 1.0),
                         (5, 2020, 9, 1, "b", 1.0, 1.0)])
    dim = _dim(spark, [(1, 10, "A"), (2, 20, "B")])
    assert QC.orphan_count(fact, dim, "location_id").first()[0] == 2       # NULL and 9
    areas = {r["area_name"]: r["total_crimes"] for r in Q.by_area(fact, dim).collect()}
    assert areas == {"A": 2, "B": 1}                                         # orphans absent
    # average over per-location counts includes the NULL and orphan groups: (2+1+1+1)/4 = 1.25
    above = [r["area_name"] for r in Q.areas_above_average(fact, dim, "id").collect()]
    assert above == ["A"]
    sql_form = [r["area_name"] for r in Q.areas_above_average(fact, dim, "name").collect()]
    assert sql_form == ["A"]
    checks = QC.fact_checks(fact, dim).first()
    assert checks["orphan_rows"] == 2 and checks["null_location_id"] == 1


def test_year_missing_in_measures_absent_from_kpi(spark):
    fact = _fact(spark, [(1, 2020, 1, 1, "a", 0.0, 0.0), (2, 2021, 1, 1, "a", 0.0, 0.0),
                         (3, 2022, 1, 1, "a", 0.0, 0.0)])
    pop = spark.createDataFrame([(2020, 100), (2021, 100)], S.POPULATION)
    une = spark.createDataFrame([(2020, 1.0), (2022, 1.0)], S.UNEMPLOYMENT)
    assert [r["year"] for r in Q.yearly_kpi(fact, pop, une).collect()] == [2020]


def test_lag_is_previous_row_and_zero_previous_is_null(spark):
    kpi = spark.createDataFrame([(2020, 0), (2021, 5), (2023, 10)], "year int, total_crimes long")
    out = [(r["year"], r["prev_year_crimes"], r["annual_variation_percent"])
           for r in Q.annual_variation(kpi).collect()]
    assert out == [(2020, None, None), (2021, 0, None), (2023, 5, 100.0)]


def test_tied_top_type_keeps_all_rows(spark):
    fact = _fact(spark, [(1, 2020, 1, 1, "x", 0.0, 0.0), (2, 2020, 1, 2, "y", 0.0, 0.0),
                         (3, 2020, 2, 1, "x", 0.0, 0.0), (4, 2020, 2, 1, "x", 0.0, 0.0),
                         (5, 2020, 2, 2, "y", 0.0, 0.0)])
    dim = _dim(spark, [(1, 10, "A"), (2, 20, "B")])
    out = sorted((r["area_name"], r["crime_desc"], r["total_crimes"])
                 for r in Q.top_type_per_area(fact, dim).collect())
    assert out == [("A", "x", 1), ("A", "y", 1), ("B", "x", 2)]


def test_ids_sharing_a_name_merge_in_name_grouping(spark):
    fact = _fact(spark, [(1, 2020, 1, 1, "x", 0.0, 0.0), (2, 2020, 2, 1, "x", 0.0, 0.0)])
    dim = _dim(spark, [(1, 10, "Same"), (2, 20, "Same")])
    assert [(r[0], r[1]) for r in Q.by_area(fact, dim).collect()] == [("Same", 2)]
    assert len(V.by_location(fact, dim).collect()) == 2


def test_duplicate_key_three_times(spark):
    df = spark.createDataFrame([(7,), (7,), (7,), (8,)], "crime_id long")
    rows = QC.duplicate_keys(df, ["crime_id"]).collect()
    assert [(r[0], r[1]) for r in rows] == [(7, 3)]
    assert QC.duplicate_key_count(df, ["crime_id"]).first()[0] == 1


def test_null_profiles(spark):
    fact = _fact(spark, [(1, None, 1, None, "a", None, 1.0), (2, 2020, None, 1, None, 1.0, None)])
    r = QC.null_profile(fact, ["year", "location_id", "crime_code", "crime_desc", "lat", "lon"]).first()
    assert r.asDict() == {"total_rows": 2, "null_year": 1, "null_location_id": 1, "null_crime_code": 1,
                          "null_crime_desc": 1, "null_lat": 1, "null_lon": 1}
    pop = spark.createDataFrame([(2020, None)], S.POPULATION)
    out = QC.null_profile_union([("population", pop, "population")]).collect()
    assert [(x[0], x[1]) for x in out] == [("population", 1)]


def test_dimension_and_constraint_report(spark):
    staging = spark.createDataFrame([
        (1, 2020, 30, "C", 1, "x", 0.0, 0.0), (2, 2021, 10, "A", 1, "x", 0.0, 0.0),
        (3, 2020, 10, "A", 1, "x", 0.0, 0.0), (4, 2020, 99, None, 1, "x", 0.0, 0.0),
        (4, 2020, 10, "A", 1, "x", 0.0, 0.0)], S.STAGING)
    locs = M.extract_locations(staging).where(F.col("area_code") != 99)
    dim = M.build_dim_location(locs)
    assert [(r[0], r[1], r[2]) for r in dim.orderBy("location_id").collect()] == [(1, 10, "A"), (2, 30, "C")]
    fact = M.load_fact(staging, dim)
    assert fact.where(F.col("location_id").isNull()).count() == 1
    dim_time = M.build_dim_time(staging, lo=2020, hi=2020)
    pop = spark.createDataFrame([(2020, 1), (2021, 2)], S.POPULATION)
    une = spark.createDataFrame([(2020, 1.0)], S.UNEMPLOYMENT)
    rep = {(r[0], r[1]): r[2] for r in M.constraint_report(fact, dim, dim_time, pop, une).collect()}
    assert rep[("fact", "pk_unique(crime_id)")] == 1
    assert rep[("fact", "not_null(location_id)")] == 1
    assert rep[("fact", "fk(year->dim_time)")] == 1
    assert rep[("population", "fk(year->dim_time)")] == 1
    assert rep[("dim_location", "unique(area_code)")] == 0
    assert sum(rep.values()) == 4


def test_grid_rejects_file_without_header_in_scan_window(spark):
    late = [["x"]] * 55 + [["Geographic Area", "2020"]]
    grid = _grid(spark, {"late.csv": late, "ok.csv": [["Geographic Area", "2020"], ["P", "1"]]})
    header = G.find_header(grid, "text", scan_rows=50)
    assert [r["file"] for r in header.collect()] == ["ok.csv"]
    assert [r["file"] for r in G.rejected_files(grid, header).collect()] == ["late.csv"]


def test_grid_empty_column_dropped_before_positional_cut_and_half_even(spark):
    sheet = [
        ["title", "", "", "", ""],
        ["Geographic Area", "", "Base", "2020", "2021"],
        ["Alpha", "", "9", "2.5", "3.5"],
        ["", "", "", "", ""],
        ["Beta", "", "7", "", "1,000"],
    ]
    grid = _grid(spark, {"s.csv": sheet})
    out = sorted((r["place"], r["year"], r["population"])
                 for r in G.population_long(grid, "text", [2020, 2021]).collect())
    assert out == [("Alpha", 2020, 2), ("Alpha", 2021, 4), ("Beta", 2020, None), ("Beta", 2021, None)]


def test_grid_year_row_and_two_row_header(spark):
    sheet = [
        ["Some title", "", "", ""],
        ["Geographic\nArea", "April 1 Base", "Population Estimate", ""],
        ["", "", "2020", "2021"],
        [".Alpha", "5", "10", "11"],
        ["nan", "", "", ""],
    ]
    grid = _grid(spark, {"s.csv": sheet})
    by_years = sorted(tuple(r) for r in G.population_long(grid, "years", [2020, 2021]).collect())
    assert by_years == [(".Alpha", 2020, 10), (".Alpha", 2021, 11)]
    # the newline inside "Geographic\nArea" keeps the text search from matching it
    assert G.find_header(grid, "text").count() == 0
    fixed = _grid(spark, {"s.csv": [sheet[0], ["Geographic Area"] + sheet[1][1:]] + sheet[2:]})
    two_row = sorted(tuple(r) for r in G.population_long(fixed, "two_row", [2020, 2021]).collect())
    assert two_row == by_years
    wide = G.population_wide(fixed, "two_row", [2020, 2021]).collect()
    assert [tuple(r) for r in wide] == [("s.csv", 3, ".Alpha", 10.0, 11.0)]


def test_sheet_cells_converter_output(spark):
    sheet = [
        ["title", "", ""],
        ["Geographic\nArea x", "", "2020"],
        ["Geographic Area", "", "2020"],
        ["Alpha", "", "1"],
        ["", "", "9"],
    ]
    grid = _grid(spark, {"s.csv": sheet})
    out = sorted((r["row_idx"], r["name"], r["value"]) for r in G.sheet_cells(grid).collect())
    assert out == [(3, "2020", "1"), (3, "Geographic Area", "Alpha")]


def test_load_population_and_unemployment(spark):
    long = spark.createDataFrame([("A", 2020, 5), ("B", 2020, 7)], "place string, year int, population long")
    assert [tuple(r) for r in M.load_population(long, "B").collect()] == [(2020, 7)]
    yearly = spark.createDataFrame([(2020.0, 4.5)], "year double, unemployment_rate double")
    assert M.load_unemployment(yearly).schema == S.UNEMPLOYMENT


def test_grid_rejects_lists_unusable_files(spark):
    good = [["Geographic Area", "", "2020"], ["", "", "2020"], ["Alpha", "", "1"]]
    # the lower cell under "Geographic Area" is a year, so no column name mentions a place
    no_geo = [["Geographic Area", "", ""], ["2020", "Base", "Total"], ["5", "1", "2"]]
    no_years = [["Geographic Area", "Base"], ["Name", "Total"], ["Alpha", "1"]]
    grid = _grid(spark, {"good.csv": good, "no_geo.csv": no_geo, "no_years.csv": no_years,
                         "none.csv": [["nothing"]]})
    rejected = sorted(r["file"] for r in G.grid_rejects(grid, "two_row", [2020]).collect())
    assert rejected == ["no_geo.csv", "no_years.csv", "none.csv"]
    assert sorted(tuple(r) for r in G.population_long(grid, "two_row", [2020]).collect()) == [("Alpha", 2020, 1)]
