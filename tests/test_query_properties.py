"""Property test: mart queries equal a count by hand on random small marts.

Random facts mix NULL and orphan locations, NULL years and descriptions, ties,
and location ids that share an area name.
"""

from collections import Counter

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from civicmart import schema as S
from civicmart.operators import queries as Q
from civicmart.operators import views as V


def brute(fact, dim):
    """What each query should return, counted by hand over (year, location, type) rows."""
    name = {loc: n for loc, _, n in dim}
    known = [(y, loc, t) for _, y, loc, _, t, *_ in fact if loc in name]
    per_loc = Counter(loc for _, _, loc, *_ in fact)
    mean = sum(per_loc.values()) / len(per_loc)
    per_name = Counter(name[loc] for _, loc, _ in known)
    pairs = Counter((name[loc], t) for _, loc, t in known)
    best = {n: max(k for (m, _), k in pairs.items() if m == n) for n in per_name}
    return {
        "by_area": list(per_name.items()),
        "by_year": list(Counter(y for _, y, *_ in fact).items()),
        "by_location": [(loc, code, n, per_loc[loc]) for loc, code, n in dim if per_loc[loc]],
        "above_name": [x for x in per_name.items() if x[1] > mean],
        "above_id": [(name[loc], k) for loc, k in per_loc.items() if loc in name and k > mean],
        "top_type": [(n, t, k) for (n, t), k in pairs.items() if k == best[n]],
        "year_area": [(*x, k) for x, k in Counter((y, name[loc]) for y, loc, _ in known).items()],
    }


fact_rows = st.lists(st.tuples(
    st.sampled_from([2020, 2021, None]),
    st.sampled_from([1, 2, 3, 4, None, 99]),
    st.sampled_from(["a", "b", "c", None]),
), min_size=1, max_size=60)
dims = st.lists(st.sampled_from(["North", "South", "East"]), min_size=4, max_size=4)


def _norm(rows):
    return sorted((tuple(None if pd.isna(v) else (int(v) if isinstance(v, float) and v == int(v) else v)
                         for v in r) for r in rows), key=repr)


@settings(max_examples=10, deadline=None, derandomize=True, database=None)
@given(fact_rows, dims)
def test_mart_queries_equal_a_count_by_hand(spark, rows, names):
    fact_data = [(i, y, loc, 1, desc, 0.0, 0.0) for i, (y, loc, desc) in enumerate(rows)]
    dim_data = [(k + 1, 10 * (k + 1), names[k]) for k in range(4)]
    fact = spark.createDataFrame(fact_data, S.FACT)
    dim = spark.createDataFrame(dim_data, S.DIM_LOCATION)
    want_all = brute(fact_data, dim_data)
    ours = {
        "by_area": Q.by_area(fact, dim),
        "by_year": Q.by_year(fact),
        "by_location": V.by_location(fact, dim),
        "above_name": Q.areas_above_average(fact, dim, "name"),
        "above_id": Q.areas_above_average(fact, dim, "id"),
        "top_type": Q.top_type_per_area(fact, dim),
        "year_area": Q.area_by_year(fact, dim),
    }
    for key, df in ours.items():
        got = _norm([tuple(r) for r in df.collect()])
        want = _norm(want_all[key])
        assert got == want, key


@settings(max_examples=8, deadline=None, derandomize=True, database=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.sampled_from([1, 2, 3, None, 42]), st.sampled_from([2020, None])),
                min_size=1, max_size=50))
def test_quality_checks_equal_a_count_by_hand(spark, rows):
    from civicmart.operators import quality as QC
    fact_data = [(key, y, loc, 1, "x", 0.0, 0.0) for key, loc, y in rows]
    fact = spark.createDataFrame(fact_data, S.FACT)
    dim = spark.createDataFrame([(1, 10, "A"), (2, 20, "B"), (3, 30, "C")], S.DIM_LOCATION)
    repeated = {k: n for k, n in Counter(key for key, *_ in rows).items() if n > 1}
    assert {r[0]: r[1] for r in QC.duplicate_keys(fact, ["crime_id"]).collect()} == repeated
    lost = sum(loc not in (1, 2, 3) for _, loc, _ in rows)
    assert QC.orphan_count(fact, dim, "location_id").first()[0] == lost
    checks = QC.fact_checks(fact, dim).first()
    assert checks["orphan_rows"] == lost
    assert checks["null_year"] == sum(1 for *_, y in rows if y is None)
    assert checks["null_location_id"] == sum(1 for _, loc, _ in rows if loc is None)
