"""Gates, audit refresh (versioned runs, growing log_id, failure policy) and the batch job."""

import pytest
from pyspark.sql import functions as F

from civicmart import schema as S
from civicmart.operators.views import yearly_kpi_view
from civicmart.plans import versions
from civicmart.plans.job import GateError, read_ledger, run_batch, run_gates
from civicmart.plans.refresh import current_run, read_audit, refresh_audit, run_log
from civicmart.sources import store
from civicmart.sources.mart import Mart


def _mart(spark, fact_rows, dim_rows=((1, 10, "A"),)):
    fact = spark.createDataFrame(fact_rows, S.FACT)
    dim = spark.createDataFrame(list(dim_rows), S.DIM_LOCATION)
    pop = spark.createDataFrame([(2020, 1000), (2021, 1000)], S.POPULATION)
    une = spark.createDataFrame([(2020, 4.5), (2021, 5.25)], S.UNEMPLOYMENT)
    years = spark.createDataFrame([(2020,), (2021,)], S.DIM_TIME)
    return Mart(fact, dim, years, pop, une)


CLEAN = [(1, 2020, 1, 1, "x", 0.0, 0.0), (2, 2021, 1, 1, "x", 0.0, 0.0), (3, 2021, 1, 1, "x", 0.0, 0.0)]
DIRTY = CLEAN + [(3, None, 7, 1, "x", 0.0, 0.0)]


def test_gates_warn_and_fail(spark):
    ok = run_gates(_mart(spark, CLEAN), "warn")
    assert ok.passed and ok.total_rows == 3
    bad = run_gates(_mart(spark, DIRTY), "warn")
    assert bad.nulls["year"] == 1 and bad.duplicate_keys == 1 and bad.orphan_rows == 1
    assert len(bad.warnings) == 3
    with pytest.raises(GateError, match="gate null"):
        run_gates(_mart(spark, DIRTY), "fail")


def test_refresh_versions_and_log_id_continues(spark, scratch):
    mart = _mart(spark, CLEAN)
    kpi = yearly_kpi_view(mart.fact, mart.population, mart.unemployment)
    path = f"{scratch}/audit"
    assert read_audit(spark, path).count() == 0
    assert refresh_audit(spark, kpi, path) == 1
    first = read_audit(spark, path).collect()
    assert [r["log_id"] for r in first] == [1, 2]
    assert str(first[1]["unemployment"]) == "5.2500"
    assert refresh_audit(spark, kpi, path) == 2
    second = read_audit(spark, path).collect()
    assert [r["log_id"] for r in second] == [3, 4]          # old rows gone, ids continue
    assert refresh_audit(spark, kpi, path) == 3
    assert sorted(r["run"] for r in run_log(spark, path).collect()) == [1, 2, 3]


def test_refresh_failure_keeps_previous_or_raises(spark, scratch):
    mart = _mart(spark, CLEAN)
    kpi = yearly_kpi_view(mart.fact, mart.population, mart.unemployment)
    path = f"{scratch}/audit"
    refresh_audit(spark, kpi, path)
    boom = kpi.withColumn("total_crimes", F.raise_error(F.lit("boom")).cast("bigint"))
    assert refresh_audit(spark, boom, path, on_error="keep_previous") == 1
    assert current_run(spark, path) == 1
    assert [r["log_id"] for r in read_audit(spark, path).collect()] == [1, 2]
    with pytest.raises(Exception):
        refresh_audit(spark, boom, path, on_error="raise")
    assert refresh_audit(spark, kpi, path) == 2   # failed attempts take no number
    assert [r["log_id"] for r in read_audit(spark, path).collect()] == [3, 4]


def test_refreshers_at_once_give_disjoint_ids(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    mart = _mart(spark, CLEAN)
    kpi = yearly_kpi_view(mart.fact, mart.population, mart.unemployment)
    path = f"{scratch}/audit"
    with ThreadPoolExecutor(4) as pool:
        runs = sorted(pool.map(lambda _: refresh_audit(spark, kpi, path, on_error="raise"), range(4)))
    assert runs == [1, 2, 3, 4]
    log = sorted((r.run, r.folder, r.last_id) for r in run_log(spark, path).collect())
    ids = [sorted(r.log_id for r in spark.read.parquet(f"{path}/{f}").collect()) for _, f, _ in log]
    assert ids == [[1, 2], [3, 4], [5, 6], [7, 8]] and [x[2] for x in log] == [2, 4, 6, 8]
    assert sum(f.base_name.startswith("data-") for f in store.listed(path)) == 4  # beaten attempts are gone


def test_a_marker_is_created_once(scratch):
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: store.publish(f"file://{scratch}/m/1.json", str(k)), range(40)))
    assert sum(won) == 1 and store.read_text(f"{scratch}/m/1.json") == str(won.index(True))
    assert [f.base_name for f in store.listed(f"{scratch}/m")] == ["1.json"]


def test_a_writer_beaten_every_time_gives_up(scratch):
    def build(base, folder):
        n = (base.run if base else 0) + 1
        assert store.publish(f"{scratch}/t/_commits/{n:010d}.json",
                             f'{{"run": {n}, "folder": "data-x", "last_id": 0}}')
        return 0

    with pytest.raises(versions.Conflict):
        versions.commit(f"{scratch}/t", build, attempts=3)


def test_expiry_keeps_the_newest_runs_and_attempts_under_way(spark, scratch):
    mart = _mart(spark, CLEAN)
    kpi = yearly_kpi_view(mart.fact, mart.population, mart.unemployment)
    path = f"{scratch}/audit"
    for _ in range(3):
        refresh_audit(spark, kpi, path)
    kpi.write.parquet(f"{path}/data-underway")
    assert len(versions.expire(path, keep=2)) == 1
    assert read_audit(spark, path).count() == 2
    assert "data-underway" in versions.expire(path, keep=1, grace_seconds=-1)
    assert [r["log_id"] for r in read_audit(spark, path).collect()] == [5, 6]
    assert refresh_audit(spark, kpi, path) == 4 and read_audit(spark, path).first()["log_id"] == 7


def test_ledger_tells_what_gates_and_refresh_did(spark, scratch):
    path = f"{scratch}/audit"
    run_batch(spark, _mart(spark, DIRTY), path, policy="warn", job="a")
    with pytest.raises(GateError):
        run_batch(spark, _mart(spark, DIRTY), path, policy="fail", job="b")
    got = sorted(tuple(r) for r in read_ledger(spark, path).collect())
    assert got == [("a", 1, "null", 1, "year", "warned"), ("a", 2, "duplicate", 1, "crime_id 3", "warned"),
                   ("a", 3, "orphan", 1, "location_id", "warned"), ("a", 4, "refresh", 0, None, "wrote run 1"),
                   ("b", 1, "null", 1, "year", "failed"), ("b", 2, "duplicate", None, None, "skipped"),
                   ("b", 3, "orphan", None, None, "skipped"), ("b", 4, "refresh", None, None, "kept run 1")]


def test_nothing_stays_of_queries_that_write(spark):
    import os
    from civicmart import catalog
    from civicmart.session import remove_scratch, scratch_root
    from paths import SF001
    catalog.queries()["audit_refreshes"](spark, SF001).collect()
    root = store.open_store(scratch_root(spark))[1]
    assert os.listdir(root)
    remove_scratch(spark)
    assert not os.path.exists(root)
    assert catalog.queries()["by_year"](spark, SF001).count() > 0  # loaded anew


def test_run_batch_end_to_end(spark, scratch):
    report, audit = run_batch(spark, _mart(spark, CLEAN), f"{scratch}/audit", policy="fail")
    assert report.passed
    rows = audit.collect()
    assert [(r["year"], r["total_crimes"], str(r["crime_rate"])) for r in rows] == \
        [(2020, 1, "100.00"), (2021, 2, "200.00")]
    with pytest.raises(GateError):
        run_batch(spark, _mart(spark, DIRTY), f"{scratch}/audit2", policy="fail")
    assert read_audit(spark, f"{scratch}/audit2").count() == 0  # refresh did not run


def test_job_entry_point_materializes_and_refreshes(spark, scratch):
    from paths import SF001
    from civicmart.plans.job import main
    assert main(["--tables", SF001, "--mart", f"{scratch}/mart", "--audit", f"{scratch}/audit"]) == 0
    audit = read_audit(spark, f"{scratch}/audit").collect()
    assert [r["log_id"] for r in audit] == list(range(1, len(audit) + 1)) and len(audit) == 7
    assert main(["--mart", f"{scratch}/mart", "--audit", f"{scratch}/audit", "--policy", "fail"]) == 0
    assert read_audit(spark, f"{scratch}/audit").first()["log_id"] == 8


def test_check_sources(spark, scratch):
    from paths import SF001
    from civicmart.plans.job import check_sources
    check_sources(spark, SF001)  # passes
    spark.read.parquet(f"{SF001}/nation.parquet").drop("n_name").write.parquet(f"{scratch}/nation.parquet")
    with pytest.raises(ValueError, match=r"nation: missing \['n_name'\].*orders: unreadable|orders: unreadable.*nation"):
        check_sources(spark, scratch)
