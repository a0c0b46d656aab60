"""Every registered query equals its DuckDB oracle SQL on the sf0.01 tables."""

from paths import SF001, SF01
from oracle_compare import compare

from civicmart import oracle


def test_registered_queries_match_oracle(spark):
    res = compare(spark, SF01, list(oracle.oracle_sql()), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad
    # No row may pass by being empty; a fact's key is one that doesn't repeat.
    empty = {k for k, v in res.items() if v.startswith("ok (0 rows")}
    assert empty <= {"fact_duplicate_keys"}, empty


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["year", "total_crimes", "population", "unemployment_rate", "crime_rate_per_100k"]
    assert df.count() > 0
    assert SF001 in e.SMOKE_DIR
