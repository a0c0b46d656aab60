"""Physical-plan properties of the registered queries on the materialized mart."""

import contextlib
import io

import pytest

from paths import SF01


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def qs():
    from civicmart import catalog
    return catalog.queries()


def test_no_python_evaluation_in_any_registered_query(spark, qs):
    for key, q in qs.items():
        p = plan(q(spark, SF01), "extended")
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
            assert marker not in p, (key, marker)


def test_year_filter_prunes_partitions(spark, qs):
    p = plan(qs["rows_of_year"](spark, SF01))
    assert "PartitionFilters: [isnotnull(year" in p and "= 1998)" in p
    assert "TakeOrderedAndProject" in p


def _scan_sections(formatted: str) -> list[str]:
    """The '(n) Scan parquet' sections of a formatted plan."""
    parts = formatted.split("\n(")
    return [p for p in parts if p.split(")", 1)[-1].strip().startswith("Scan parquet")]


def test_yearly_kpi_reads_no_fact_data_column(spark, qs):
    scans = _scan_sections(plan(qs["yearly_kpi"](spark, SF01)))
    fact = [sec for sec in scans if "/fact]" in sec]
    assert len(fact) == 1
    assert "ReadSchema: struct<>" in fact[0] and "PartitionFilters: [isnotnull(year" in fact[0]


def test_area_queries_prune_columns_and_broadcast_dimension(spark, qs):
    p = plan(qs["by_area"](spark, SF01))
    assert "ReadSchema: struct<location_id:int>" in p
    assert "BroadcastHashJoin" in p


def test_rank_is_planned_as_group_limit(spark, qs):
    assert "WindowGroupLimit" in plan(qs["top_type_per_area"](spark, SF01))


def test_partial_aggregation_before_shuffle(spark, qs):
    p = plan(qs["by_type"](spark, SF01), "extended")
    assert "partial_count" in p


def test_raw_scans_push_filters_and_prune_columns(spark, qs):
    from civicmart.sources import bindings as B
    from civicmart.sources.tables import read_table
    p = plan(B.bind_unemployment(read_table(spark, SF01, "lineitem")))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_linestatus), IsNotNull(l_tax), " \
           "EqualTo(l_returnflag,N), EqualTo(l_linestatus,O), EqualTo(l_tax,0.0)]" in p
    assert "ReadSchema: struct<l_discount:double,l_tax:double,l_returnflag:string,l_linestatus:string," \
           "l_shipdate:timestamp_ntz>" in p
    dup = plan(qs["duplicate_keys"](spark, SF01))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in dup
    orphan = plan(qs["orphan_count"](spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint>" in orphan and "text" not in orphan


def test_no_cartesian_or_nested_loop_join_anywhere(spark, qs):
    for key, q in qs.items():
        p = plan(q(spark, SF01), "simple")
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


@pytest.mark.parametrize("key", ["areas_above_avg_theta", "areas_above_avg_having"])
def test_above_average_scans_the_fact_once(spark, qs, key):
    df = qs[key](spark, SF01)
    df.collect()  # the final adaptive plan
    final = plan(df, "simple").split("== Initial Plan ==")[0]
    assert len([line for line in final.splitlines() if "FileScan parquet [location_id#" in line
                and "area_name" not in line]) == 1
    assert final.count("hashpartitioning(location_id") == 1


def test_incident_timestamps_are_parsed_once(spark, qs):
    p = plan(qs["clean_incidents"](spark, SF01), "extended").split("== Physical Plan ==")[1]
    # try_to_timestamp is planned as gettimestamp
    assert p.lower().count("gettimestamp(") == 1


def test_kept_columns_are_found_without_exploding_cells(spark):
    from civicmart.operators import grid as G
    grid = spark.createDataFrame([("a", 0, ["x", ""])], "file string, row_idx int, cells array<string>")
    p = plan(G.kept_columns(grid), "extended")
    assert "bitmap_or_agg" in p and "explode(cells" not in p and "posexplode" not in p


def test_mart_measures_share_one_lineitem_pass(spark):
    from civicmart.sources.mart import mart_from_tables
    mart = mart_from_tables(spark, SF01)
    for df in (mart.population, mart.unemployment):
        p = plan(df, "simple")
        assert "InMemoryTableScan" in p and "l_quantity" in p and "l_discount" in p


def test_fact_layout_rebalances_by_year(spark):
    from civicmart import schema as S
    from civicmart.sources.mart import _conform, mart_from_tables
    fact = _conform(mart_from_tables(spark, SF01).fact, S.FACT)
    p = plan(fact.hint("rebalance", "year").sortWithinPartitions("year", "location_id", "crime_id"), "simple")
    assert "REBALANCE_PARTITIONS_BY_COL" in p  # AQE splits a hot year and joins small ones
    assert "Exchange rangepartitioning" not in p
    assert "Sort [year" in p  # local sort only


def test_read_grid_does_not_sort_or_shuffle_grid_rows(spark, tmp_path):
    from civicmart.sources.raw import read_grid
    folder = tmp_path / "g"
    folder.mkdir()
    (folder / "a.csv").write_text("x,1\ny,2\n")
    p = plan(read_grid(spark, str(folder)), "simple")
    assert "Window" not in p and "Sort [" not in p
    assert "BroadcastHashJoin" in p  # only the per-file first ids are broadcast
