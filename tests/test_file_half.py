"""Files read whole, wrong files refused: sheets, raw CSV, load and refresh."""

import os

import pytest

from civicmart import schema as S
from civicmart.operators import grid as G
from civicmart.operators import model as M
from civicmart.plans.refresh import read_audit, refresh_audit
from civicmart.sources.mart import read_staging
from civicmart.sources.raw import profile_raw, read_grid, read_raw_csv
from civicmart.sources.sinks import write_frame


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_wide_sheets_and_equal_names_are_read_whole(spark, scratch):
    put(f"{scratch}/g/x/pop.csv", ",".join(map(str, range(500))) + "\na\n")
    put(f"{scratch}/g/y/pop.csv", '"q,\nr",N/A,NaN\n')
    rows = {(r["file"][-9:], r["row_idx"]): r["cells"] for r in read_grid(spark, f"{scratch}/g/*").collect()}
    assert rows[("x/pop.csv", 0)][:500] == [str(i) for i in range(500)]
    assert rows[("x/pop.csv", 1)][0] == "a"
    assert rows[("y/pop.csv", 0)][:3] == ["q,\nr", None, None]
    wide = {r["file"][-9:]: r["n_columns"] for r in profile_raw(spark, f"{scratch}/g/x").collect()}
    assert wide == {"x/pop.csv": 500}


def test_header_far_down_unlisted_years_and_fixed_position(spark, scratch):
    put(f"{scratch}/t/a.csv", "x\n" * 55 + "Geographic Area,Base,2020\nP,9,5\n")
    put(f"{scratch}/y/a.csv", "t\nGeo,2019,2020\nP,1,2\n")
    put(f"{scratch}/p/a.csv", "t\nPlace name,Est,\n,2020,2021\nP,1,2\n")
    deep = G.population_long(read_grid(spark, f"{scratch}/t"), "text", [2020]).collect()
    assert [tuple(r) for r in deep] == [("P", 2020, 5)]
    years = G.population_long(read_grid(spark, f"{scratch}/y"), "years", [2020]).collect()
    assert sorted(tuple(r) for r in years) == [("P", 2019, 1), ("P", 2020, 2)]
    two = G.population_long(read_grid(spark, f"{scratch}/p"), "two_row", header_row=1).collect()
    assert sorted(tuple(r) for r in two) == [("P", 2020, 1), ("P", 2021, 2)]


def test_files_with_other_headers_and_broken_rows_fail(spark, scratch):
    put(f"{scratch}/h/a.csv", "DR_NO,AREA\n1,2\n")
    put(f"{scratch}/h/b.csv", "AREA,DR_NO\n20,2\n")
    with pytest.raises(Exception):  # noqa: B017 - Spark's reader names the file and both headers
        read_raw_csv(spark, f"{scratch}/h").collect()
    put(f"{scratch}/q/a.csv", 'A,B\n"Cen\ntral",2\n')
    assert [tuple(r) for r in read_raw_csv(spark, f"{scratch}/q", multi_line=True).collect()] == [("Cen\ntral", "2")]
    with pytest.raises(Exception):  # noqa: B017
        read_raw_csv(spark, f"{scratch}/q", ["A"]).collect()


def test_quotes_survive_our_own_csv(spark, scratch):
    df = spark.createDataFrame([(1, 2020, 10, 'A "b", c', 5, "x", 1.0, 2.0)], S.STAGING)
    write_frame(df, f"{scratch}/o", "csv")
    assert [tuple(r) for r in read_staging(spark, f"{scratch}/o", "csv").collect()] == [tuple(df.first())]


def test_two_names_of_a_code_multiply_no_fact_row(spark):
    staging = spark.createDataFrame([(1, 2020, 10, "A", 1, "x", 0.0, 0.0), (2, 2020, 10, "B", 1, "x", 0.0, 0.0),
                                     (3, 2020, None, None, 1, "x", 0.0, 0.0)], S.STAGING)
    fact = M.load_fact(staging, M.build_dim_location(M.extract_locations(staging)))
    got = {r["crime_id"]: r["location_id"] for r in fact.collect()}
    assert len(got) == fact.count() == 3 and got[1] != got[2] and got[3] is None


def test_ids_go_on_after_an_empty_refresh(spark, scratch):
    kpi = spark.createDataFrame([(2020, 5, 1.0, 2.0), (2021, 6, 1.0, 2.0)],
                                "year int, total_crimes long, crime_rate_per_100k double, unemployment_rate double")
    for k in (kpi, kpi.limit(0), kpi):
        refresh_audit(spark, k, f"{scratch}/audit", on_error="raise")
    assert [r["log_id"] for r in read_audit(spark, f"{scratch}/audit").collect()] == [3, 4]
