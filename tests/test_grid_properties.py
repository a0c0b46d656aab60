"""Property test: the sheet cleaner equals a brute-force reading of the same rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from civicmart import schema as S
from civicmart.operators import grid as G

YEARS = [2020, 2021, 2022]
NUM = re.compile(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$")


def _number(v):
    s = (v or "").strip()
    return round(float(s)) if NUM.match(s) else None


def brute_force_years(rows):
    """(place, year, population) by the year-row rules, in plain Python."""
    wanted = {str(y) for y in YEARS}
    hdr = next((i for i, r in enumerate(rows[:80]) if wanted <= {(c or "").strip() for c in r}), None)
    if hdr is None:
        return []
    labels = [(c or "").strip() for c in rows[hdr]]
    names = ["place"] + [("base" if j == 1 and not lab.isdigit() else lab) for j, lab in enumerate(labels)][1:]
    data = rows[hdr + 1:]
    kept = [j for j in range(len(names)) if any((r[j] or "") != "" for r in data)]
    if 0 not in kept:
        return []
    year_cols = [j for j in kept if names[j].isdigit() and int(names[j]) in YEARS]
    out = []
    for r in data:
        place = (r[0] or "").strip()
        if place in ("", "nan"):
            continue
        out += [(place, int(names[j]), _number(r[j])) for j in year_cols]
    return sorted(out, key=repr)


def _rows_out(data, place_col, year_cols):
    out = []
    for r in data:
        place = (r[place_col] or "").strip()
        if place in ("", "nan"):
            continue
        out += [(place, year, _number(r[j])) for j, year in year_cols]
    return sorted(out, key=repr)


def brute_force_text_modes(rows, mode):
    """The 'text' (positional) and 'two_row' (flattened header) rules, in plain Python."""
    hdr = next((i for i, r in enumerate(rows[:50])
                if any("geographic area" in (c or "").strip().lower() for c in r)), None)
    if hdr is None:
        return []
    data = rows[hdr + (2 if mode == "two_row" else 1):]
    width = len(rows[hdr])
    kept = [j for j in range(width) if any((r[j] or "") != "" for r in data)]
    if mode == "text":
        names = {j: ("place" if k == 0 else "base" if k == 1 else
                     str(YEARS[k - 2]) if k - 2 < len(YEARS) else None) for k, j in enumerate(kept)}
    else:
        names = {}
        for j in kept:
            up, lo = (rows[hdr][j] or "").strip(), (rows[hdr + 1][j] or "").strip()
            names[j] = lo if lo.isdigit() else (up if up else lo)
        geo = next((j for j in kept if any(k in names[j].lower() for k in ("geographic", "area", "name", "place"))), None)
        if geo is None:
            return []
        names[geo] = "place"
    place_col = next((j for j in kept if names[j] == "place"), None)
    if place_col is None:
        return []
    year_cols = [(j, int(names[j])) for j in kept
                 if names[j] and names[j].isdigit() and int(names[j]) in YEARS]
    return _rows_out(data, place_col, year_cols)


cell = st.one_of(st.just(""), st.integers(0, 10**6).map(str), st.sampled_from(["x", "1,5", "2.5", "3.5", " 7 "]))


@st.composite
def sheets(draw):
    width = 2 + len(YEARS) + draw(st.integers(0, 2))
    spacers = draw(st.sets(st.integers(2, width - 1), max_size=2))
    year_slots = [j for j in range(2, width) if j not in spacers][:len(YEARS)]
    if len(year_slots) < len(YEARS):
        spacers, year_slots = set(), list(range(2, 2 + len(YEARS)))
        width = max(width, 2 + len(YEARS))
    top = [["Estimates", *[""] * (width - 1)]] + [[""] * width for _ in range(draw(st.integers(0, 3)))]
    upper = ["Geographic Area", "Base"] + [""] * (width - 2)
    lower = ["", ""] + [""] * (width - 2)
    for y, j in zip(YEARS, year_slots):
        lower[j] = str(y)
    body = []
    for _ in range(draw(st.integers(1, 6))):
        row = [draw(st.sampled_from(["A", "B", " C ", "", "nan"])), draw(cell)] + [""] * (width - 2)
        for j in year_slots:
            row[j] = draw(cell)
        body.append(row)
    return top + [upper, lower] + body


@settings(max_examples=12, deadline=None, derandomize=True, database=None)
@given(sheets())
def test_year_row_cleaner_matches_brute_force(spark, rows):
    grid = spark.createDataFrame([("s.csv", i, r) for i, r in enumerate(rows)], S.GRID)
    got = sorted((tuple(r) for r in G.population_long(grid, "years", YEARS, checkpoint=False).collect()), key=repr)
    assert got == brute_force_years(rows)


@settings(max_examples=8, deadline=None, derandomize=True, database=None)
@given(sheets(), st.sampled_from(["text", "two_row"]))
def test_header_text_modes_match_brute_force(spark, rows, mode):
    grid = spark.createDataFrame([("s.csv", i, r) for i, r in enumerate(rows)], S.GRID)
    got = sorted((tuple(r) for r in G.population_long(grid, mode, YEARS, checkpoint=False).collect()), key=repr)
    assert got == brute_force_text_modes(rows, mode)
