"""Property tests: the indicator expressions equal exact decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicmart.functions import rate_per_100k, round_half_even_long, variation_pct


def _half_up(x: Decimal, places: int = 2) -> float:
    return float(x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def _rate(n: int, pop: int) -> float | None:
    if pop == 0:
        return None
    with localcontext() as ctx:
        ctx.prec = 60
        return _half_up(Decimal(n) / Decimal(pop) * 100000)


def _variation(cur: int, prev: int | None) -> float | None:
    if prev is None or prev == 0:
        return None
    with localcontext() as ctx:
        ctx.prec = 60
        return _half_up(Decimal(cur - prev) / Decimal(prev) * 100)


counts = st.integers(min_value=0, max_value=10**12)
pops = st.integers(min_value=0, max_value=10**10)


@settings(max_examples=15, deadline=None, derandomize=True, database=None)
@given(st.lists(st.tuples(counts, pops, st.one_of(st.none(), counts)), min_size=1, max_size=40))
def test_rate_and_variation_match_exact_decimal(spark, rows):
    df = spark.createDataFrame(rows, "n long, pop long, prev long")
    out = df.select(rate_per_100k("n", "pop").alias("r"), variation_pct("n", "prev").alias("v")).collect()
    assert [r["r"] for r in out] == [_rate(n, p) for n, p, _ in rows]
    assert [r["v"] for r in out] == [_variation(n, pv) for n, _, pv in rows]


@settings(max_examples=15, deadline=None, derandomize=True, database=None)
@given(st.lists(st.one_of(st.integers(-10**6, 10**6).map(lambda i: i / 2),
                          st.floats(-1e9, 1e9, allow_nan=False)), min_size=1, max_size=40))
def test_half_even_matches_python_round(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_even_long(F.col("v"))).collect()]
    assert got == [round(v) for v in values]


@settings(max_examples=10, deadline=None, derandomize=True, database=None)
@given(st.lists(st.text(alphabet="0123456789.+-eE ,xinfINF", min_size=0, max_size=8), min_size=1, max_size=60))
def test_to_number_matches_pandas_coercion(spark, values):
    import math

    import pandas as pd

    from civicmart.functions import to_number
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(to_number(F.col("v"))).collect()]
    want = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce").tolist()
    for v, g, w in zip(values, got, want):
        if w is None or (isinstance(w, float) and math.isnan(w)):
            assert g is None, (v, g)
        else:
            assert g == float(w), (v, g, w)


@st.composite
def stamps(draw):
    def num(lo, hi, pad):
        v = draw(st.integers(lo, hi))
        return f"{v:02d}" if draw(st.booleans()) and pad else str(v)
    sep = draw(st.sampled_from([" ", "  ", "\t", ""]))
    edge = draw(st.sampled_from(["", "", " "]))
    year = draw(st.sampled_from(["2020", "2024", "1999", "20", "02020"]))
    return (f"{edge}{num(0, 13, True)}/{num(0, 32, True)}/{year}{sep}{num(0, 13, True)}:"
            f"{num(0, 61, True)}:{num(0, 59, True)} {draw(st.sampled_from(['AM', 'PM', 'am', 'Pm', 'XM']))}")
    # seconds stop at 59: leap seconds (60, 61), which strptime accepts, are
    # rejected here (a listed deviation)


@settings(max_examples=10, deadline=None, derandomize=True, database=None)
@given(st.lists(stamps(), min_size=1, max_size=60))
def test_timestamp_parse_matches_pandas(spark, values):
    import pandas as pd

    from civicmart.functions import event_year, parse_event_ts
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(event_year(parse_event_ts(F.col("v")))).collect()]
    parsed = pd.to_datetime(pd.Series(values), format="%m/%d/%Y %I:%M:%S %p", errors="coerce")
    want = [None if pd.isna(t) else t.year for t in parsed]
    assert got == want, [(v, g, w) for v, g, w in zip(values, got, want) if g != w][:5]


labour_rows = st.lists(st.tuples(
    st.sampled_from(["West", "west", "East"]), st.sampled_from(["State", "County"]), st.sampled_from(["N", "Y"]),
    st.sampled_from(["2019", "2020", "2021", "2020.0", "x", ""]),
    st.sampled_from(["4.5", "5", " 6 ", "n/a", "", "bad", "7.25", "inf"])), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, derandomize=True, database=None)
@given(labour_rows)
def test_labour_mean_matches_pandas(spark, rows):
    import math

    import pandas as pd

    from civicmart.operators.clean import clean_labour
    from civicmart.schema import LABOUR_COLUMNS
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in LABOUR_COLUMNS))
    got = {r["year"]: r["unemployment_rate"] for r in clean_labour(raw, "West", "State", "N", lo=2020).collect()}
    # brute force with pandas: exact selection, coercion, per-year mean, window on the result
    pdf = pd.DataFrame(rows, columns=LABOUR_COLUMNS).replace({"": None, "n/a": None})
    pdf = pdf[(pdf["Area Name"] == "West") & (pdf["Area Type"] == "State") & (pdf["Seasonally Adjusted(Y/N)"] == "N")]
    year = pd.to_numeric(pdf["Year"], errors="coerce")
    rate = pd.to_numeric(pdf["Unemployment Rate"], errors="coerce")
    means = rate.groupby(year).mean()
    want = {int(y): m for y, m in means.items() if y >= 2020}
    assert set(got) == set(want)
    for y, m in want.items():
        g = got[y]
        if m is None or math.isnan(m):
            assert g is None or math.isnan(g), (y, g, m)
        elif math.isinf(m):
            assert g == m, (y, g, m)
        else:  # summation order may differ in the last bit
            assert math.isclose(g, m, rel_tol=1e-12), (y, g, m)
