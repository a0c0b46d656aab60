"""Population sheet cleaning (C10-C25) on a grid ``(file, row_idx, cells)``.

Sheets differ in layout from file to file, so nothing is turned into a
per-file schema: the header row is located per file, column names are derived
per ``(file, col_idx)``, and a small per-file *layout* (which cell is the place,
which cells are which year) is joined back to the data rows. Exploding the
year cells of each row is the wide-to-long step. All work is grouped by file
and column, so it spreads over any number of sheets.

Three header modes reproduce the three cleaner variants:

* ``text``    - header = first row (within ``scan_rows``) with a cell containing
                "geographic area"; columns are then taken by *position* after
                all-empty columns are dropped: place, base, then ``years``.
* ``years``   - header = first row whose cells include every year in ``years``;
                column 0 is the place, column 1 the base unless it is a year,
                year columns are the all-digit names.
* ``two_row`` - the "geographic area" row and the row below form a two-level
                header; a column is named by its lower cell if that is all
                digits, else by its upper cell, else the lower one. The place is
                the first column whose name mentions geographic/area/name/place.

Rows with an empty place are dropped. Values are coerced to numbers (non-numeric
-> NULL) and rounded half-to-even; missing cells stay NULL in the long output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.functions.parse import round_half_even_long, to_number
from civicmart.session import shared_dir

# Fixed values used by the reference cleaners.
HEADER_NEEDLE = "geographic area"
GEO_KEYWORDS = ["geographic", "area", "name", "place"]
TEXT_SCAN_ROWS = 60
CONVERTER_SCAN_ROWS = 50
YEARS_SCAN_ROWS = 80

_DIGITS = r"^[0-9]+$"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _is_empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def normalize_header(c: Column) -> Column:
    """Newline -> space, then strip."""
    return F.trim(F.regexp_replace(_text(c), "\n", " "))


def find_header(grid: DataFrame, mode: str = "text", years: Sequence[int] | None = None,
                needle: str = HEADER_NEEDLE, scan_rows: int | None = None,
                header_row: int | None = None) -> DataFrame:
    """``(file, header_row)`` for every file with a header inside ``scan_rows``.

    ``header_row`` states the position instead, for sheets whose header is at a fixed place.
    """
    if header_row is not None:
        return (grid.where(F.col("row_idx") == header_row).select("file").distinct()
                .withColumn("header_row", F.lit(int(header_row))))
    if mode in ("text", "two_row"):
        limit = TEXT_SCAN_ROWS if scan_rows is None else scan_rows
        hit = F.exists("cells", lambda c: F.contains(F.lower(F.trim(_text(c))), F.lit(needle.lower())))
    elif mode == "years":
        if not years:
            raise ValueError("mode 'years' needs the list of years")
        limit = YEARS_SCAN_ROWS if scan_rows is None else scan_rows
        wanted = F.array(*[F.lit(str(int(y))) for y in years])
        hit = F.size(F.array_except(wanted, F.transform("cells", lambda c: F.trim(_text(c))))) == 0
    else:
        raise ValueError(f"unknown header mode {mode!r}")
    return (grid.where((F.col("row_idx") < limit) & hit)
            .groupBy("file").agg(F.min("row_idx").cast("int").alias("header_row")))


def rejected_files(grid: DataFrame, header: DataFrame) -> DataFrame:
    """Files without a detectable header (the reference raises for them)."""
    return grid.select("file").distinct().join(header, "file", "left_anti")


def _data_rows(grid: DataFrame, header: DataFrame, header_rows: int) -> DataFrame:
    last = header.select("file", (F.col("header_row") + (header_rows - 1)).alias("_last"))
    return grid.join(last, "file").where(F.col("row_idx") > F.col("_last")).drop("_last")


def _header_cells(grid: DataFrame, header: DataFrame, offset: int, alias: str) -> DataFrame:
    at = header.select("file", (F.col("header_row") + offset).alias("row_idx"))
    return (grid.join(at, ["file", "row_idx"])
            .select("file", F.posexplode("cells").alias("col_idx", alias)))


def kept_columns(data: DataFrame) -> DataFrame:
    """``(file, col_idx)`` of columns with at least one non-empty data cell.

    Each row is a mask with a bit a column; the masks of a file are or-ed by partial aggregation (up to
    32,768 columns, twice what a sheet can have), so a file of any length sends one mask a task.
    """
    per_file = data.where(F.size("cells") > 0).groupBy("file").agg(
        F.bitmap_or_agg(_filled_mask(F.col("cells"))).alias("mask"), F.max(F.size("cells")).alias("width"))
    digit = F.hex("mask")

    def filled(i: Column) -> Column:
        of_four = F.conv(F.substr(digit, F.floor(i / 4).cast("int") + 1, F.lit(1)), 16, 10).cast("int")
        return F.floor(of_four / F.pow(F.lit(2), 3 - i % 4)) % 2 == 1

    kept = F.filter(F.sequence(F.lit(0), F.col("width") - 1), filled)
    return per_file.select("file", F.explode(kept).alias("col_idx"))


def _filled_mask(cells: Column) -> Column:
    """A binary with the bits of the non-empty cells set, the first cell's highest."""
    bits = F.transform(cells, lambda c: F.when(_is_empty(c), 0).otherwise(1))
    bits = F.concat(bits, F.array_repeat(F.lit(0), F.pmod(-F.size(cells), F.lit(8)).cast("int")))
    digits = F.transform(F.sequence(F.lit(0), (F.size(bits) / 4).cast("int") - 1), lambda i: F.hex(
        F.get(bits, i * 4) * 8 + F.get(bits, i * 4 + 1) * 4 + F.get(bits, i * 4 + 2) * 2 + F.get(bits, i * 4 + 3)))
    return F.unhex(F.array_join(digits, ""))


def _names(grid: DataFrame, header: DataFrame, kept: DataFrame, mode: str,
           years: Sequence[int] | None) -> DataFrame:
    """``(file, col_idx, name)`` of the kept columns, by mode."""
    if mode == "text":
        pos = F.row_number().over(Window.partitionBy("file").orderBy("col_idx")) - 1
        year_names = F.array(*[F.lit(str(int(y))) for y in (years or [])])
        named = kept.withColumn("pos", pos)
        name = (F.when(F.col("pos") == 0, F.lit("place")).when(F.col("pos") == 1, F.lit("base"))
                 .otherwise(F.try_element_at(year_names, (F.col("pos") - 1).cast("int"))))
        return named.select("file", "col_idx", name.alias("name")).where(F.col("name").isNotNull())
    if mode == "years":
        cells = _header_cells(grid, header, 0, "raw")
        label = F.trim(_text(F.col("raw")))
        name = (F.when(F.col("col_idx") == 0, F.lit("place"))
                 .when((F.col("col_idx") == 1) & ~label.rlike(_DIGITS), F.lit("base"))
                 .otherwise(label))
        return cells.select("file", "col_idx", name.alias("name")).join(kept, ["file", "col_idx"])
    if mode == "two_row":
        upper = _header_cells(grid, header, 0, "upper")
        lower = _header_cells(grid, header, 1, "lower")
        u, lo_ = F.trim(_text(F.col("upper"))), F.trim(_text(F.col("lower")))
        flat = F.when(lo_.rlike(_DIGITS), lo_).when(u != "", u).otherwise(lo_)
        named = (upper.join(lower, ["file", "col_idx"]).join(kept, ["file", "col_idx"])
                 .select("file", "col_idx", flat.alias("name")))
        low = F.lower(F.col("name"))
        is_geo = F.lit(False)
        for k in GEO_KEYWORDS:
            is_geo = is_geo | F.contains(low, F.lit(k))
        geo_idx = F.min(F.when(is_geo, F.col("col_idx"))).over(Window.partitionBy("file"))
        named = named.withColumn("_geo", geo_idx)
        return named.select("file", "col_idx",
                            F.when(F.col("col_idx") == F.col("_geo"), F.lit("place"))
                            .otherwise(F.col("name")).alias("name"))
    raise ValueError(f"unknown header mode {mode!r}")


def grid_layout(grid: DataFrame, mode: str = "text", years: Sequence[int] | None = None,
                header: DataFrame | None = None, scan_rows: int | None = None,
                header_row: int | None = None) -> DataFrame:
    """Per file: header_row, place_idx and the sorted ``(col_idx, year)`` year cells.

    ``years`` locates the header of ``years`` mode and names the columns of ``text`` mode;
    elsewhere every all-digit column is a year column, listed or not.
    """
    if header is None:
        header = find_header(grid, mode, years, scan_rows=scan_rows, header_row=header_row)
    header_rows = 2 if mode == "two_row" else 1
    data = _data_rows(grid, header, header_rows)
    names = _names(grid, header, kept_columns(data), mode, years)
    is_year = F.col("name").rlike(_DIGITS)
    if mode == "text":
        is_year = is_year & F.col("name").isin([str(int(y)) for y in years or []])
    layout = names.groupBy("file").agg(
        F.min(F.when(F.col("name") == "place", F.col("col_idx"))).alias("place_idx"),
        F.array_sort(F.collect_list(F.when(is_year, F.struct(
            F.col("col_idx").alias("col_idx"), F.col("name").cast("int").alias("year"))))).alias("year_cols"))
    return (header.join(layout, "file")
            .where(F.col("place_idx").isNotNull())
            .withColumn("header_rows", F.lit(header_rows)))


def grid_rejects(grid: DataFrame, mode: str = "text", years: Sequence[int] | None = None,
                 header_row: int | None = None) -> DataFrame:
    """Files the cleaner cannot use: no header row, no place column or no year column.

    These are the cases where the reference cleaners stop with an error; here
    they are listed (one row per file) and the other files are cleaned.
    """
    usable = grid_layout(grid, mode, years, header_row=header_row).where(F.size("year_cols") > 0).select("file")
    return rejected_files(grid, usable)


def _placed_rows(grid: DataFrame, mode: str, years: Sequence[int] | None, drop_empty_place: bool,
                 scan_rows: int | None, header_row: int | None) -> DataFrame:
    """Data rows with their place and the layout of their file."""
    layout = grid_layout(grid, mode, years, scan_rows=scan_rows, header_row=header_row)
    data = grid.join(layout, "file").where(
        F.col("row_idx") > F.col("header_row") + F.col("header_rows") - 1)
    place = F.trim(_text(F.try_element_at("cells", (F.col("place_idx") + 1).cast("int"))))
    rows = data.withColumn("place", place)
    return rows.where((F.col("place") != "") & (F.col("place") != "nan")) if drop_empty_place else rows


def population_long(grid: DataFrame, mode: str = "text", years: Sequence[int] | None = None,
                    drop_empty_place: bool = True, with_file: bool = False,
                    checkpoint: bool = True, scan_rows: int | None = None,
                    header_row: int | None = None) -> DataFrame:
    """``(place, year, population)`` for every data row and year column.

    The grid is consumed four times (header search, column emptiness, header
    cells, values). With ``checkpoint`` it is first written once to the
    session's checkpoint folder (an action), so those passes re-read stored
    rows instead of re-running whatever produced the grid.
    """
    if checkpoint:
        shared_dir(grid.sparkSession)
        grid = grid.checkpoint(eager=True)
    data = _placed_rows(grid, mode, years, drop_empty_place, scan_rows, header_row)
    rows = data.select("file", "cells", "place", F.explode("year_cols").alias("yc"))
    value = F.try_element_at("cells", (F.col("yc.col_idx") + 1).cast("int"))
    cols = [F.col("place"), F.col("yc.year").alias("year"),
            round_half_even_long(to_number(value)).alias("population")]
    if with_file:
        cols.insert(0, F.col("file"))
    return rows.select(*cols)


def population_wide(grid: DataFrame, mode: str, years: Sequence[int], drop_empty_place: bool = True,
                    checkpoint: bool = True, scan_rows: int | None = None,
                    header_row: int | None = None) -> DataFrame:
    """The clean wide frame: ``(file, row_idx, place, <year>, ..)``, one row per data row of a sheet.

    Each row gathers its own cells by the layout of its file, so two rows of one place stay two, in
    one file or in several. Values are numbers as they stand (not rounded), NULL where a cell is
    not a number or the sheet lacks the year.
    """
    if checkpoint:
        shared_dir(grid.sparkSession)
        grid = grid.checkpoint(eager=True)
    data = _placed_rows(grid, mode, years, drop_empty_place, scan_rows, header_row)

    def of_year(y: int) -> Column:
        at = F.get(F.filter("year_cols", lambda c: c["year"] == y), F.lit(0))["col_idx"]
        return to_number(F.try_element_at("cells", (at + 1).cast("int"))).alias(str(y))

    return data.select("file", "row_idx", "place", *[of_year(int(y)) for y in years])


def sheet_cells(grid: DataFrame, scan_rows: int = CONVERTER_SCAN_ROWS,
                checkpoint: bool = True) -> DataFrame:
    """The sheet converter's clean output in long form ``(file, row_idx, name, value)``.

    Header = first row with "geographic area" (files without one are left out, see
    ``rejected_files``); all-empty data columns are dropped; names are normalised
    (newline -> space, strip); rows whose first remaining column is empty go.
    """
    if checkpoint:
        shared_dir(grid.sparkSession)
        grid = grid.checkpoint(eager=True)
    header = find_header(grid, "text", scan_rows=scan_rows)
    data = _data_rows(grid, header, 1)
    kept = kept_columns(data)
    names = (_header_cells(grid, header, 0, "raw").join(kept, ["file", "col_idx"])
             .select("file", "col_idx", normalize_header(F.col("raw")).alias("name")))
    first = names.groupBy("file").agg(F.min("col_idx").alias("first_idx"))
    rows = data.join(first, "file").where(
        ~_is_empty(F.try_element_at("cells", (F.col("first_idx") + 1).cast("int"))))
    cells = rows.select("file", "row_idx", F.posexplode("cells").alias("col_idx", "value"))
    return (cells.join(names, ["file", "col_idx"])
            .select("file", "row_idx", "col_idx", "name", "value"))


def sheet_id(file: Column) -> Column:
    """A short key that is safe as a folder name, the same for the same path: sheets of one name in
    two folders have two."""
    return F.substring(F.sha2(file, 256), 1, 16)


def _header_names(grid: DataFrame, header: DataFrame) -> DataFrame:
    """``(file, col_idx, name)`` as a data-frame reader names columns: a cell without text is
    ``Unnamed: <position>``, a repeated text gets ``.1``, ``.2``, ..; then newlines and ends are cleaned."""
    cells = _header_cells(grid, header, 0, "raw")
    named = cells.withColumn("raw", F.when(_is_empty(F.col("raw")), F.concat(F.lit("Unnamed: "), "col_idx"))
                             .otherwise(F.col("raw")))
    nth = F.row_number().over(Window.partitionBy("file", "raw").orderBy("col_idx")) - 1
    named = named.withColumn("nth", nth)
    full = F.when(F.col("nth") > 0, F.concat("raw", F.lit("."), "nth")).otherwise(F.col("raw"))
    return named.select("file", "col_idx", normalize_header(full).alias("name"))


def _csv_field(c: Column) -> Column:
    """A field of a CSV line: quoted where it must be, nothing for a missing cell."""
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.isNull(), "").when(c.rlike('[",\r\n]'), quoted).otherwise(c)


def sheet_lines(grid: DataFrame, scan_rows: int = CONVERTER_SCAN_ROWS, checkpoint: bool = True) -> DataFrame:
    """The converter's clean sheets as CSV lines: ``(file, row_idx, line)``, the header at -1.

    Sheets differ in their columns, so a sheet is rendered as text by its own list of kept columns;
    no frame has to hold the columns of all. Rows whose first kept cell is empty go, as in ``sheet_cells``.
    """
    if checkpoint:
        shared_dir(grid.sparkSession)
        grid = grid.checkpoint(eager=True)
    header = find_header(grid, "text", scan_rows=scan_rows)
    data = _data_rows(grid, header, 1)
    columns = (_header_names(grid, header).join(kept_columns(data), ["file", "col_idx"])
               .groupBy("file").agg(F.array_sort(F.collect_list(F.struct("col_idx", "name"))).alias("kept")))
    head = columns.select("file", F.lit(-1).alias("row_idx"), F.array_join(
        F.transform("kept", lambda k: _csv_field(k["name"])), ",").alias("line"))
    cells = F.transform("kept", lambda k: F.get("cells", k["col_idx"]))
    rows = (data.join(columns, "file").withColumn("own", cells)
            .where(~_is_empty(F.get("own", F.lit(0))))
            .select("file", "row_idx", F.array_join(F.transform("own", _csv_field), ",").alias("line")))
    return head.unionByName(rows)
