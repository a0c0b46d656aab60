"""Raw sources: header CSV, sheet grid with quoted newlines, folder profile, sinks."""

import os

from civicmart.schema import INCIDENT_COLUMNS
from civicmart.sources.raw import head_lines, profile_raw, read_grid, read_raw_csv, read_raw_csv_lenient
from civicmart.sources.sinks import write_frame


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_read_raw_csv_by_header_name_with_quotes_and_extra_columns(spark, scratch):
    header = ",".join(['"Extra"'] + [f'"{c}"' for c in reversed(INCIDENT_COLUMNS)])
    row = 'z,-118.2,34.1,"BATTERY, SIMPLE ""ASSAULT""",624,Central,1,01/08/2020 02:05:00 PM,190326475'
    _write(f"{scratch}/in/a.csv", header + "\n" + row + "\n")
    df = read_raw_csv(spark, f"{scratch}/in", INCIDENT_COLUMNS)
    r = df.first()
    assert df.columns == INCIDENT_COLUMNS
    assert r["DR_NO"] == "190326475" and r["Crm Cd Desc"] == 'BATTERY, SIMPLE "ASSAULT"'
    assert r["LAT"] == "34.1"


def test_read_raw_csv_reports_missing_columns(spark, scratch):
    _write(f"{scratch}/in/a.csv", "A,B\n1,2\n")
    try:
        read_raw_csv(spark, f"{scratch}/in", ["A", "C"])
    except ValueError as exc:
        assert "C" in str(exc)
    else:
        raise AssertionError("expected a ValueError")


def test_read_grid_keeps_quoted_newline_and_row_order(spark, scratch):
    _write(f"{scratch}/g/one.csv", 'title,,\n"Geographic\nArea",Base,2020\nAlpha,1,2\n')
    _write(f"{scratch}/g/two.csv", "x\ny\nz\n")
    _write(f"{scratch}/g/skip.txt", "ignored\n")
    grid = read_grid(spark, f"{scratch}/g")
    rows = {(os.path.basename(r["file"]), r["row_idx"]): r["cells"] for r in grid.collect()}
    assert set(f for f, _ in rows) == {"one.csv", "two.csv"}
    assert rows[("one.csv", 1)][:3] == ["Geographic\nArea", "Base", "2020"]
    assert rows[("two.csv", 2)][0] == "z"


def test_profile_raw(spark, scratch):
    _write(f"{scratch}/p/a.csv", 'h1,h2,"h,3"\n1,2,3\n4,5,6\n7,8,9\n')
    _write(f"{scratch}/p/b.csv", "only\n")
    prof = {os.path.basename(r["file"]): r for r in profile_raw(spark, f"{scratch}/p").collect()}
    assert prof["a.csv"]["n_rows"] == 3 and prof["a.csv"]["n_columns"] == 3
    assert prof["a.csv"]["sample"] == ["1,2,3", "4,5,6"]
    assert prof["b.csv"]["n_rows"] == 0 and prof["b.csv"]["sample"] is None


def test_lenient_read_pads_short_rows_and_sets_bad_ones_aside(spark, scratch):
    _write(f"{scratch}/in/a.csv", 'A,B,C\n1,2,3\n4,5\n6\n7,8,9,10\n"x, y",,"q""q"\n')
    _write(f"{scratch}/in/b.csv", "C,X,A,B\n3,z,1,2\n")
    _write(f"{scratch}/in/c.csv", "A,B\n1,2\n")
    _write(f"{scratch}/in/d.csv", "A,B,C\n10,11,12\n")
    rows, rejects = read_raw_csv_lenient(spark, f"{scratch}/in", ["A", "C"])
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [("1", "3"), ("4", None), ("6", None), ("x, y", 'q"q'), ("1", "3"), ("10", "12")], key=str)
    got = sorted((os.path.basename(r["file"]), r["reason"], r["line"]) for r in rejects.collect())
    assert got == [("a.csv", "more than 3 fields", "7,8,9,10"), ("c.csv", "missing columns ['C']", None)]


def test_head_lines_of_a_file_in_many_splits(spark, scratch):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(4000)]
    _write(f"{scratch}/h/long.csv", "\n".join(lines) + "\n")
    _write(f"{scratch}/h/short.csv", "one\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {(os.path.basename(r["file"]), r["line_no"]): r["line"]
               for r in head_lines(spark, f"{scratch}/h", 3).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {("long.csv", 1): lines[0], ("long.csv", 2): lines[1], ("long.csv", 3): lines[2],
                   ("short.csv", 1): "one"}


def test_write_frame_roundtrip(spark, scratch):
    df = spark.createDataFrame([(2020, "a,b"), (2021, None)], "year int, s string")
    write_frame(df, f"{scratch}/o_csv", fmt="csv")
    back = read_raw_csv(spark, f"{scratch}/o_csv")
    assert sorted((r["year"], r["s"]) for r in back.collect()) == [("2020", "a,b"), ("2021", None)]
    write_frame(df, f"{scratch}/o_pq", partition_by=["year"])
    assert os.path.isdir(f"{scratch}/o_pq/year=2020")


def test_read_staging_csv_and_parquet(spark, scratch):
    from civicmart import schema as S
    from civicmart.sources.mart import read_staging
    df = spark.createDataFrame([(1, 2020, 10, "A", 510, "x", 34.1, -118.2)], S.STAGING)
    write_frame(df, f"{scratch}/stg_csv", fmt="csv")
    write_frame(df, f"{scratch}/stg_pq")
    for fmt, path in (("csv", f"{scratch}/stg_csv"), ("parquet", f"{scratch}/stg_pq")):
        back = read_staging(spark, path, fmt)
        assert back.schema == S.STAGING and [tuple(r) for r in back.collect()] == [tuple(df.first())]


def test_read_grid_row_index_with_files_packed_in_one_partition(spark, scratch):
    for name in ("a", "b", "c"):
        _write(f"{scratch}/many/{name}.csv", "".join(f"{name}{i},x\n" for i in range(50)))
    grid = read_grid(spark, f"{scratch}/many")
    rows = grid.collect()
    assert len(rows) == 150
    for r in rows:
        assert r["cells"][0] == f"{os.path.basename(r['file'])[0]}{r['row_idx']}"


def test_profile_raw_orders_rows_across_splits(spark, scratch):
    lines = ["id,payload"] + [f"{i},{'x' * 200}" for i in range(3000)]
    _write(f"{scratch}/big/a.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")  # ~10 splits of one file
    try:
        prof = profile_raw(spark, f"{scratch}/big").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert prof["n_rows"] == 3000 and prof["n_columns"] == 2
    assert [x.split(",")[0] for x in prof["sample"]] == ["0", "1"]


def test_read_raw_csv_missing_values_match_pandas(spark, scratch):
    import pandas as pd
    text = ('DR_NO,Crm Cd Desc,LAT,AREA NAME\n'
            '1,"BATTERY, SIMPLE ""ASSAULT""",34.1,Central\n'
            '2,NA,N/A,"NA"\n'
            '3,,null,None\n'
            '4,#N/A,nan," padded "\n')
    _write(f"{scratch}/p/a.csv", text)
    from civicmart.functions import null_if_missing
    df = read_raw_csv(spark, f"{scratch}/p")
    got = sorted(tuple(r) for r in df.select(*[null_if_missing(f"`{c}`").alias(c) for c in df.columns]).collect())
    pdf = pd.read_csv(f"{scratch}/p/a.csv", dtype=str)
    want = sorted(tuple(None if pd.isna(v) else v for v in row) for row in pdf.itertuples(index=False))
    assert got == want
