"""Column functions: parsing, coercion, rounding and the indicator expressions."""

import pytest
from pyspark.sql import functions as F

from civicmart.functions import (
    event_year,
    intensity_level,
    parse_event_ts,
    rate_per_100k,
    round_half_even_long,
    to_integer,
    to_number,
    variation_pct,
)


def _one_col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_timestamp_parse_padded_unpadded_and_bad(spark):
    out = _one_col(spark, ["01/08/2020 02:05:00 PM", "1/8/2020 2:05:00 PM", "12/31/2024 11:59:59 PM",
                           "14:05", "2020-01-08 00:00:00", "01/08/2020 14:05:00 PM", "13/01/2020 01:00:00 AM",
                           "", "NA", None], "string",
                   lambda c: event_year(parse_event_ts(c)))
    assert out == [2020, 2020, 2024, None, None, None, None, None, None, None]


def test_to_number_matches_coercing_parse(spark):
    vals = ["1.5", " 12 ", "-3", "1e3", ".5", "5f", "1d", "nan", "NaN", "1,234", "abc", "", "N/A", None,
            "inf", "-Infinity", " inf "]
    out = _one_col(spark, vals, "string", to_number)
    assert out == [1.5, 12.0, -3.0, 1000.0, 0.5, None, None, None, None, None, None, None, None, None,
                   float("inf"), float("-inf"), None]
    assert _one_col(spark, [float("inf"), 1e30], "double", round_half_even_long) == [None, None]


def test_to_integer(spark):
    out = _one_col(spark, ["190326475", "12.0", "12.5", "x", None], "string", to_integer)
    assert out == [190326475, 12, None, None, None]


def test_round_half_even(spark):
    out = _one_col(spark, [2.5, 3.5, -2.5, 2.4, None], "double", round_half_even_long)
    assert out == [2, 4, -2, 2, None]


# Published yearly totals, rates and variations, with populations
# chosen inside the interval each published rate allows.
GOLDEN = [
    (2020, 199847, 3896329, 5129.11, None, "Medium"),
    (2021, 209876, 3830986, 5478.38, 5.02, "Medium"),
    (2022, 235259, 3832997, 6137.73, 12.09, "High"),
    (2023, 232345, 3847427, 6038.97, -1.24, "High"),
    (2024, 127567, 3878702, 3288.91, -45.10, "Low"),
]


def test_rate_variation_level_goldens(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(y, t, p) for y, t, p, *_ in GOLDEN], "year int, total long, pop long")
    prev = F.lag("total").over(Window.orderBy("year"))
    rows = (df.select("year", rate_per_100k("total", "pop").alias("rate"),
                      variation_pct(F.col("total"), prev).alias("var"))
            .withColumn("level", intensity_level("rate")).orderBy("year").collect())
    for r, (_y, _t, _p, rate, var, level) in zip(rows, GOLDEN):
        assert r["rate"] == pytest.approx(rate, abs=1e-9)
        assert (r["var"] is None and var is None) or r["var"] == pytest.approx(var, abs=1e-9)
        assert r["level"] == level


def test_variation_zero_or_missing_previous_is_null(spark):
    df = spark.createDataFrame([(10, 0), (10, None), (15, 10)], "cur long, prev long")
    out = [r[0] for r in df.select(variation_pct("cur", "prev")).collect()]
    assert out == [None, None, 50.0]


def test_rate_zero_population_is_null_and_level_low(spark):
    df = spark.createDataFrame([(10, 0)], "n long, pop long")
    r = df.select(rate_per_100k("n", "pop").alias("r")).withColumn("l", intensity_level("r")).first()
    assert r["r"] is None and r["l"] == "Low"


def test_cluster_conf_scales_with_input():
    from civicmart.session import cluster_conf
    small = cluster_conf(10 << 30, total_cores=8)
    big = cluster_conf(100 * 10**12, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert 15000 < int(big["spark.sql.shuffle.partitions"]) < 25000
    assert big["spark.sql.autoBroadcastJoinThreshold"] == str(64 << 20)


def test_am_pm_guard_never_changes_the_parse(spark):
    values = ["01/08/2020 02:05:00 PM", "1/8/2020 2:05:00 pm", "01/08/2020 02:05:00 Pm", "01/08/2020 02:05:00 PM ",
              " 01/08/2020 02:05:00 PM", "2020-01-08 14:05:00", "01/08/2020 02:05:00", "PM", "", None, "x AM"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    guarded = [r[0] for r in df.select(parse_event_ts(F.col("v"))).collect()]
    plain = [r[0] for r in df.select(F.try_to_timestamp(F.col("v"), F.lit("M/d/yyyy h:mm:ss a"))).collect()]
    plain = [None if v in ("", "NA") else p for v, p in zip(values, plain)]
    assert guarded == plain
