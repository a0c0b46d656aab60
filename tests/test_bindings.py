"""Bindings: one-pass measures equal the separate aggregates; materializing changes nothing."""

from civicmart.operators import queries as Q
from civicmart.sources import bindings as B
from civicmart.sources.mart import mart_from_tables, materialize_mart
from civicmart.sources.tables import read_table
from paths import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_pass_measures_equal_separate_aggregates(spark):
    lineitem = read_table(spark, SF001, "lineitem")
    m = B.bind_measures(lineitem)
    assert _rows(m.select("year", "population")) == _rows(B.bind_population(lineitem))
    assert _rows(m.where("labour_rows > 0").select("year", "unemployment_rate")) == \
        _rows(B.bind_unemployment(lineitem))


def test_materialized_mart_answers_like_the_lazy_one(spark, scratch):
    lazy = mart_from_tables(spark, SF001)
    stored = materialize_mart(lazy, f"{scratch}/mart")
    for build in (lambda m: Q.by_year(m.fact),
                  lambda m: Q.yearly_kpi(m.fact, m.population, m.unemployment),
                  lambda m: Q.top_type_per_area(m.fact, m.dim_location),
                  lambda m: Q.sample_rows(m.fact)):
        assert _rows(build(lazy)) == _rows(build(stored))
