"""Published results reproduced on a generated mart of the published size."""

import pytest

from civicmart.operators import queries as Q
from civicmart.operators import views as V
from civicmart.sources.mart import materialize_mart
from golden import N_ROWS, TOP_AREAS, TOP_TYPES, golden_mart

# Published rates, variations, and the levels the thresholds give.
PUBLISHED = {
    2020: (5129.11, None, "Medium"),
    2021: (5478.38, 5.02, "Medium"),
    2022: (6137.73, 12.09, "High"),
    2023: (6038.97, -1.24, "High"),
    2024: (3288.91, -45.10, "Low"),
}


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    return materialize_mart(golden_mart(spark), str(tmp_path_factory.mktemp("golden")))


def test_row_count(mart):
    assert mart.fact.count() == N_ROWS == 1_004_894


def test_yearly_kpi_matches_published(mart):
    kpi = Q.yearly_kpi(mart.fact, mart.population, mart.unemployment).collect()
    assert [r["year"] for r in kpi] == sorted(PUBLISHED)
    for r in kpi:
        assert r["crime_rate_per_100k"] == pytest.approx(PUBLISHED[r["year"]][0], abs=1e-9)
    assert [r["unemployment_rate"] for r in kpi] == [10.17, 7.34, 4.27, 4.72, 5.32]


def test_variation_and_levels(mart):
    kpi = V.yearly_kpi_view(mart.fact, mart.population, mart.unemployment)
    for r in Q.annual_variation(kpi).collect():
        want = PUBLISHED[r["year"]][1]
        assert (want is None and r["annual_variation_percent"] is None) or \
            r["annual_variation_percent"] == pytest.approx(want, abs=1e-9)
    inline = {r["year"]: r["annual_variation_percent"] for r in Q.annual_variation_inline(kpi).collect()}
    assert inline == {r["year"]: r["annual_variation_percent"] for r in Q.annual_variation(kpi).collect()}
    levels = {r["year"]: r["crime_intensity_level"] for r in Q.intensity_by_year(kpi).collect()}
    assert levels == {y: v[2] for y, v in PUBLISHED.items()}


def test_top3_areas_and_types(mart):
    areas = [(r["area_name"], r["total_crimes"]) for r in Q.top_areas(mart.fact, mart.dim_location, 3).collect()]
    types = [(r["crime_desc"], r["total_crimes"]) for r in Q.top_types(mart.fact, 3).collect()]
    assert areas == TOP_AREAS
    assert types == TOP_TYPES


def test_audit_projection_types(mart):
    from civicmart.plans.refresh import audit_rows
    kpi = V.yearly_kpi_view(mart.fact, mart.population, mart.unemployment)
    rows = audit_rows(kpi, 0).orderBy("year").collect()
    assert [r["log_id"] for r in rows] == [1, 2, 3, 4, 5]
    assert str(rows[2]["crime_rate"]) == "6137.73"
    assert str(rows[0]["unemployment"]) == "10.1700"
