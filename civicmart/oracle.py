"""DuckDB oracle SQL for every registered query, over the driver's table views.

Each expectation is worked out from the base tables by another route than the Spark
plan takes: incidents are orders, so totals come from per-customer order counts (an
order without a customer has no location); ranks come from maxima; previous years from a
lookup; shares and averages are compared by cross-multiplied counts. Means are rounded
to 4 places on both sides.
"""

from __future__ import annotations

# Orders per customer and year, with the customer's nation: all that the counts need.
_COUNTS = """
sold AS (
  SELECT o_custkey AS cust, CAST(year(o_orderdate) AS INTEGER) AS y,
         o_orderpriority || '/' || o_orderstatus AS kind,
         TRY_CAST(o_orderpriority[1] AS INTEGER) AS code, count(*) AS k
  FROM orders GROUP BY ALL),
placed AS (
  SELECT s.*, (SELECT any_value(c_nationkey) FROM customer WHERE c_custkey = s.cust) AS nat FROM sold s),
measure AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS y, CAST(sum(l_quantity) AS BIGINT) AS people,
         round(avg(l_discount * 100) FILTER (l_returnflag = 'N' AND l_linestatus = 'O' AND l_tax = 0), 4) AS jobless
  FROM lineitem GROUP BY 1),
per_year AS (
  SELECT y, CAST(sum(k) AS BIGINT) AS n FROM placed GROUP BY y),
rates AS (
  SELECT p.y, p.n, m.people, m.jobless, round(p.n::DECIMAL(20,0) / m.people::DECIMAL(20,0) * 100000, 2) AS rate
  FROM per_year p JOIN measure m ON m.y = p.y)"""

# One row per order, as the row-level outputs show it.
_ROWS = """
incident AS (
  SELECT o_orderkey AS crime_id, CAST(year(o_orderdate) AS INTEGER) AS year, nat.n_nationkey AS area,
         nat.n_name AS area_name, TRY_CAST(o_orderpriority[1] AS INTEGER) AS crime_code,
         o_orderpriority || '/' || o_orderstatus AS crime_desc, o_totalprice AS lat, c_acctbal AS lon,
         o_orderstatus AS status
  FROM orders LEFT JOIN (customer LEFT JOIN nation nat ON n_nationkey = c_nationkey) ON c_custkey = o_custkey)"""

# The dates of status P are rendered in another layout: the cleaner can't read them.
_CLEAN = "incident WHERE status IN ('F', 'O') AND year BETWEEN 1995 AND 2000"

_PER_NATION = "SELECT nat, CAST(sum(k) AS BIGINT) AS n FROM placed GROUP BY nat"
_NAMED = f"SELECT n_name AS area_name, n AS total_crimes FROM ({_PER_NATION}) JOIN nation ON n_nationkey = nat"
_ABOVE = f"n * (SELECT count(*) FROM ({_PER_NATION})) > (SELECT count(*) FROM orders)"

_PIVOT = ", ".join(f'CAST(sum(k) FILTER (y = {y}) AS BIGINT) AS "{y}"' for y in range(1995, 2002))

_PREVIOUS = "(SELECT arg_max(e.n, e.y) FROM rates e WHERE e.y < r.y)"
_VARIATION = f"""
  SELECT y AS year, n AS total_crimes, before AS {{previous}},
         round((n - before)::DECIMAL(20,0) / nullif(before, 0)::DECIMAL(20,0) * 100, 2) AS annual_variation_percent
  FROM (SELECT r.y, r.n, {_PREVIOUS} AS before FROM rates r)"""

_SHEET = """
  SELECT n_name AS place, CAST(u.y AS INTEGER) AS year,
         (SELECT CAST(sum(k) AS BIGINT) FROM placed WHERE nat = n_nationkey AND placed.y = u.y) AS population
  FROM nation, (SELECT unnest(range(1995, 2002)) AS y) u"""


def _violations() -> str:
    """No key of the test tables is broken; the counts are taken from the base tables all the same."""
    def repeated(column, source):
        return f"(SELECT count({column}) - count(DISTINCT {column}) FROM {source})"

    def missing(column, source):
        return f"(SELECT count(*) - count({column}) FROM {source})"

    def unknown(column, source, known):
        return f"(SELECT count(*) FROM {source} WHERE {column} IS NOT NULL AND {column} NOT IN ({known}))"

    years = "(SELECT DISTINCT year(o_orderdate) AS v FROM orders WHERE o_orderdate IS NOT NULL)"
    people = "(SELECT DISTINCT year(l_shipdate) AS v FROM lineitem)"
    rated = ("(SELECT DISTINCT year(l_shipdate) AS v FROM lineitem WHERE l_returnflag = 'N' "
             "AND l_linestatus = 'O' AND l_tax = 0)")
    all_years = "SELECT year(o_orderdate) FROM orders WHERE o_orderdate IS NOT NULL"
    rows = [
        ("dim_time", "pk_unique(year)", repeated("v", years)), ("dim_time", "pk_not_null(year)", missing("v", years)),
        ("dim_location", "pk_unique(location_id)", repeated("n_nationkey", "nation")),
        ("dim_location", "pk_not_null(location_id)", missing("n_nationkey", "nation")),
        ("population", "pk_unique(year)", repeated("v", people)),
        ("population", "pk_not_null(year)", missing("v", people)),
        ("unemployment", "pk_unique(year)", repeated("v", rated)),
        ("unemployment", "pk_not_null(year)", missing("v", rated)),
        ("fact", "pk_unique(crime_id)", repeated("o_orderkey", "orders")),
        ("fact", "pk_not_null(crime_id)", missing("o_orderkey", "orders")),
        ("dim_location", "unique(area_code)", repeated("n_nationkey", "nation")),
        ("dim_location", "not_null(area_code)", missing("n_nationkey", "nation")),
        ("dim_location", "not_null(area_name)", missing("n_name", "nation")),
        ("population", "not_null(population)", "(SELECT count(*) FROM measure WHERE people IS NULL)"),
        ("unemployment", "not_null(unemployment_rate)", f"(SELECT count(*) FROM measure WHERE jobless IS NULL "
                                                        f"AND y IN (SELECT v FROM {rated}))"),
        ("population", "fk(year->dim_time)", unknown("v", people, all_years)),
        ("unemployment", "fk(year->dim_time)", unknown("v", rated, all_years)),
        ("fact", "not_null(year)", missing("o_orderdate", "orders")),
        ("fact", "not_null(location_id)", "(SELECT count(*) FROM incident WHERE area IS NULL)"),
        ("fact", "fk(year->dim_time)", unknown("year(o_orderdate)", "orders", all_years)),
        ("fact", "fk(location_id->dim_location)",
         unknown("c_nationkey", "orders JOIN customer ON c_custkey = o_custkey", "SELECT n_nationkey FROM nation")),
    ]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{c}', {v})" for t, c, v in rows) + \
        ") v(table_name, constraint_name, violations)"


_FACT = "crime_id, year, area AS location_id, crime_code, crime_desc, lat, lon"
_STAGED = "crime_id, year, CAST(area AS INTEGER) AS area_code, area_name, crime_code, crime_desc, lat, lon"
_MISSING = ("(SELECT count(*) - count(year) FROM incident)", "(SELECT count(*) - count(area) FROM incident)",
            "(SELECT count(*) - count(crime_desc) FROM incident)")
_REPEATED_LINES = """SELECT k.o AS l_orderkey, k.l AS l_linenumber, CAST(n AS BIGINT) AS occurrences FROM (
  SELECT unnest(map_keys(m)) AS k, unnest(map_values(m)) AS n FROM (
    SELECT histogram({'o': l_orderkey, 'l': l_linenumber}) AS m FROM lineitem)) WHERE n > 1"""
_LABOUR = """
  SELECT y AS year, mean AS unemployment_rate FROM (
    SELECT CAST(year(l_shipdate) AS INTEGER) AS y, round(avg(nullif(l_discount, 0) * 100), 4) AS mean
    FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O' AND l_tax = 0 GROUP BY y)
  WHERE y >= 1995"""
_AUDIT = """
  SELECT CAST({first} + (SELECT count(*) FROM rates e WHERE e.y <= r.y) AS INTEGER) AS log_id, y AS year,
         n AS total_crimes, CAST(rate AS DECIMAL(10,2)) AS crime_rate, CAST(jobless AS DECIMAL(10,4)) AS unemployment
  FROM rates r WHERE jobless IS NOT NULL"""
_KPI = ("SELECT y AS year, n AS total_crimes, people AS population, jobless AS unemployment_rate, "
        "rate AS crime_rate_per_100k FROM rates WHERE jobless IS NOT NULL")

_CELL = "(SELECT CAST(sum(k) AS BIGINT) FROM placed WHERE nat = n_nationkey AND y = {y})"
_WIDE = ", ".join(f'CAST({_CELL.format(y=y)} AS DOUBLE) AS "{y}"' for y in range(1995, 2002))
_WIDE_TEXT = ", ".join(f"CAST({_CELL.format(y=y)} AS VARCHAR) AS y{y}" for y in range(1995, 2002))
# Order lines as facts: nothing is missing, orders of several lines repeat their key.
_LEDGER = """
  SELECT CAST(step AS INTEGER) AS step, name, CAST(violations AS BIGINT) AS violations, first_failure, action FROM (
    SELECT 1 AS step, 'null' AS name, 0 AS violations, NULL AS first_failure, 'passed' AS action UNION ALL
    SELECT 2, 'duplicate', count(*), concat('crime_id ', min(l_orderkey)), {judged}
    FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1) UNION ALL
    SELECT 3, 'orphan', {orphan} UNION ALL
    SELECT 4, 'refresh', {last})"""

_QUERIES = {
    "sample_rows": f"SELECT {_FACT} FROM incident WHERE crime_id IN (SELECT unnest(min(o_orderkey, 10)) FROM orders)",
    "rows_of_year": f"""SELECT {_FACT} FROM incident WHERE crime_id IN (
        SELECT unnest(min(o_orderkey, 10)) FROM orders WHERE year(o_orderdate) = 1998)""",
    "by_year": "SELECT y AS year, n AS total_crimes FROM per_year",
    "by_area": _NAMED,
    "rate_by_year": "SELECT y AS year, n AS total_crimes, people AS population, rate AS crime_rate_per_100k FROM rates",
    "yearly_kpi": _KPI,
    "top_areas": f"SELECT unnest(list(t ORDER BY t.total_crimes DESC, t.area_name)[:5], recursive := true) FROM ({_NAMED}) t",
    "top_types": """SELECT unnest(list(t ORDER BY t.total_crimes DESC, t.crime_desc)[:5], recursive := true)
        FROM (SELECT kind AS crime_desc, CAST(sum(k) AS BIGINT) AS total_crimes FROM placed GROUP BY kind) t""",
    "areas_above_avg_having": f"SELECT n_name AS area_name, n AS total_crimes FROM ({_PER_NATION}) JOIN nation ON n_nationkey = nat WHERE {_ABOVE}",
    "areas_above_avg_theta": f"SELECT n_name AS area_name, n AS total_crimes FROM ({_PER_NATION}) JOIN nation ON n_nationkey = nat WHERE {_ABOVE}",
    "intensity_level": """SELECT y AS year, n AS total_crimes, rate AS crime_rate_per_100k,
        ['Low', 'Medium', 'High'][1 + (rate >= 900)::INT + (rate >= 1020)::INT] AS crime_intensity_level
        FROM rates WHERE jobless IS NOT NULL""",
    "annual_variation_inline": _VARIATION.format(previous="previous_year_crimes"),
    "annual_variation_cte": _VARIATION.format(previous="prev_year_crimes"),
    "area_by_year": """SELECT y AS year, n_name AS area_name, CAST(sum(k) AS BIGINT) AS total_crimes
        FROM nation, placed WHERE nat = n_nationkey GROUP BY ALL""",
    "top_type_per_area": """SELECT n_name AS area_name, kind AS crime_desc, total AS total_crimes FROM (
          SELECT nat, kind, CAST(sum(k) AS BIGINT) AS total, max(sum(k)) OVER (PARTITION BY nat) AS most
          FROM placed GROUP BY nat, kind) JOIN nation ON n_nationkey = nat WHERE total = most""",
    "by_location": f"""SELECT n_nationkey AS location_id, n_nationkey AS area_code, n_name AS area_name,
        n AS total_crimes FROM ({_PER_NATION}) JOIN nation ON n_nationkey = nat""",
    "by_type": "SELECT code AS crime_code, kind AS crime_desc, CAST(sum(k) AS BIGINT) AS total_crimes FROM placed GROUP BY ALL",
    "location_geo": """SELECT area AS location_id, area_name, round(sum(lat::DECIMAL(28,10))::DOUBLE / count(lat), 4) AS avg_lat,
        round(sum(lon::DECIMAL(28,10))::DOUBLE / count(lon), 4) AS avg_lon FROM incident WHERE area IS NOT NULL GROUP BY ALL""",
    "area_year_matrix": f"""SELECT n_name AS area_name, {_PIVOT}
        FROM placed JOIN nation ON n_nationkey = nat WHERE y BETWEEN 1995 AND 2001 GROUP BY n_name""",
    "null_profile": f"""SELECT (SELECT count(*) FROM orders) AS total_rows, {_MISSING[0]} AS null_year,
        {_MISSING[1]} AS null_location_id, (SELECT count(*) - count(crime_code) FROM incident) AS null_crime_code,
        {_MISSING[2]} AS null_crime_desc, (SELECT count(*) - count(lat) FROM incident) AS null_lat,
        (SELECT count(*) - count(lon) FROM incident) AS null_lon""",
    "dim_null_profile": """SELECT unnest(['population', 'unemployment', 'dim_location']) AS table_name, unnest([
        (SELECT count(*) - count(people) FROM measure),
        (SELECT count(*) FROM (SELECT avg(l_discount) AS a FROM lineitem WHERE l_returnflag = 'N'
           AND l_linestatus = 'O' AND l_tax = 0 GROUP BY year(l_shipdate)) WHERE a IS NULL),
        (SELECT count(*) - count(n_name) FROM nation)]) AS null_count""",
    "duplicate_keys": _REPEATED_LINES,
    "duplicate_key_count": f"SELECT count(*) AS duplicate_keys FROM ({_REPEATED_LINES})",
    "fact_duplicate_keys": """SELECT crime_id, occurrences FROM (
        SELECT o_orderkey AS crime_id, count(*) AS occurrences FROM orders GROUP BY o_orderkey) WHERE occurrences > 1""",
    "orphan_count": """SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)) AS orphan_documents""",
    "fact_orphan_count": "SELECT count(*) - count(area) AS orphan_crimes FROM incident",
    "gate_checks": f"""SELECT (SELECT count(*) FROM orders) AS total_rows, {_MISSING[0]} AS null_year,
        {_MISSING[1]} AS null_location_id, {_MISSING[2]} AS null_crime_desc,
        (SELECT count(*) - count(area) FROM incident) AS orphan_rows""",
    "constraint_report": _violations(),
    "audit_log": _AUDIT.format(first=0),
    "audit_refreshes": f"SELECT *, true AS refreshed FROM ({_AUDIT.format(first='(SELECT count(jobless) FROM rates)')})",
    "clean_incidents": f"SELECT {_STAGED} FROM {_CLEAN}",
    "csv_incidents": f"SELECT {_STAGED} FROM {_CLEAN}",
    "csv_profile": "SELECT count(*) AS n_rows, 8 AS n_columns FROM orders",
    "dim_location_extract": f"SELECT DISTINCT CAST(area AS INTEGER) AS area_code, area_name FROM {_CLEAN}",
    "clean_labour": _LABOUR,
    "csv_labour": _LABOUR,
    "load_unemployment": "SELECT y AS year, jobless AS unemployment_rate FROM measure WHERE jobless IS NOT NULL",
    "load_population": f"SELECT year, population FROM ({_SHEET}) WHERE place = 'NATION_0'",
    "grid_header_rows": """SELECT concat('population_', lower(r_name), '.csv') AS file,
        CAST(1 + r_regionkey AS INTEGER) AS header_row FROM region""",
    "grid_to_long": _SHEET,
    "csv_population": _SHEET,
    "population_long": _SHEET,
    "population_long_two_row": _SHEET,
    "sheet_cells": """
      SELECT concat('population_', lower(r_name), '.csv') AS file, row_at AS row_idx, col AS col_idx,
             CASE col WHEN 0 THEN 'Geographic Area' WHEN 2 THEN 'Estimates Base'
                      WHEN 3 THEN 'Population Estimate (as of July 1)' ELSE '' END AS name,
             coalesce(CASE col WHEN 0 THEN n_name
               WHEN 2 THEN (SELECT nullif(count(*), 0)::VARCHAR FROM customer WHERE c_nationkey = n_nationkey)
               ELSE (SELECT sum(k)::BIGINT::VARCHAR FROM placed WHERE nat = n_nationkey AND y = 1992 + col) END, '') AS value
      FROM (SELECT *, CAST(r_regionkey + 3 + (SELECT count(*) FROM nation o
              WHERE o.n_regionkey = r_regionkey AND o.n_name < nation.n_name) AS INTEGER) AS row_at
            FROM nation JOIN region ON r_regionkey = n_regionkey),
           (SELECT CAST(unnest([0, 2, 3, 4, 5, 6, 7, 8, 9]) AS INTEGER) AS col)""",
    "population_wide": f"""
      SELECT concat(prefix, 'population_', lower(r_name), '.csv') AS file, CAST(r_regionkey + 3 + (
               SELECT count(*) FROM nation o WHERE o.n_regionkey = n.n_regionkey AND o.n_name < n.n_name) AS INTEGER) AS row_idx,
             n_name AS place, {_WIDE}
      FROM nation n JOIN region ON r_regionkey = n_regionkey, (SELECT unnest(['', 'again_']) AS prefix)""",
    "sheet_csv": f"""
      SELECT n_name AS place, (SELECT nullif(count(*), 0)::VARCHAR FROM customer WHERE c_nationkey = n_nationkey) AS base,
             {_WIDE_TEXT}
      FROM nation""",
    "csv_lenient": """SELECT crime_id, lat, CASE WHEN status = 'P' AND crime_code = 1 THEN NULL ELSE lon END AS lon
        FROM incident WHERE NOT (status = 'P' AND crime_code = 2)""",
    "csv_rejects": """
      SELECT 'more than 8 fields' AS reason, count(*) AS n FROM incident WHERE status = 'P' AND crime_code = 2
      HAVING count(*) > 0 UNION ALL
      SELECT concat('missing columns [', string_agg(concat(chr(39), c, chr(39)), ', '), ']'), 1
      FROM (SELECT unnest(['DR_NO', 'DATE OCC', 'AREA', 'AREA NAME', 'Crm Cd', 'Crm Cd Desc', 'LAT', 'LON']) AS c)""",
    "csv_head": """
      SELECT y AS year, CAST(n AS INTEGER) AS line_no, CASE n WHEN 1 THEN 'crime_id,crime_desc,lat' ELSE concat_ws(',',
               keys[n - 1], (SELECT crime_desc FROM incident WHERE crime_id = keys[n - 1]),
               (SELECT lat FROM incident WHERE crime_id = keys[n - 1])) END AS line
      FROM (SELECT year AS y, list_sort(list(crime_id)) AS keys FROM incident WHERE year IS NOT NULL GROUP BY year),
           (SELECT unnest([1, 2, 3]) AS n) WHERE n <= len(keys) + 1""",
    "dim_location_incremental": """
      SELECT CAST(CASE WHEN a.area > 12 THEN (SELECT count(*) FROM _areas o WHERE o.area BETWEEN 13 AND a.area)
                  ELSE (SELECT count(*) FROM _areas o WHERE o.area > 12 OR o.area <= a.area) END AS INTEGER) AS location_id,
             CAST(a.area AS INTEGER) AS area_code, a.area_name FROM _areas a WHERE a.area IS NOT NULL""",
    "audit_concurrent": """
      SELECT CAST(run AS INTEGER) AS run, CAST((run - 1) * (SELECT count(jobless) FROM rates)
               + (SELECT count(jobless) FROM rates e WHERE e.y <= r.y) AS INTEGER) AS log_id, y AS year, n AS total_crimes
      FROM rates r, (SELECT unnest([1, 2]) AS run) WHERE jobless IS NOT NULL""",
    "audit_expired": """SELECT CAST(run AS INTEGER) AS run, run = 3 AS kept,
        CAST(run * (SELECT count(jobless) FROM rates) AS INTEGER) AS last_id FROM (SELECT unnest([1, 2, 3]) AS run)""",
    "overwritten_table": "SELECT code AS crime_code, kind AS crime_desc, CAST(sum(k) AS BIGINT) AS total_crimes FROM placed GROUP BY ALL",
    "gate_ledger_warn": _LEDGER.format(judged="'warned'", orphan="0, NULL, 'passed'", last="0, NULL, 'wrote run 1'"),
    "gate_ledger_fail": _LEDGER.format(judged="'failed'", orphan="NULL, NULL, 'skipped'", last="NULL, NULL, 'no run'"),
    "refresh_ledger": """
      SELECT job, CAST(bad AS BIGINT) AS violations, said AS action, (SELECT count(jobless) FROM rates) AS audit_rows,
             CAST((SELECT count(jobless) FROM rates) AS INTEGER) AS last_id
      FROM (VALUES ('first', 0, 'wrote run 1'), ('second', 1, 'kept run 1')) v(job, bad, said)""",
    "dim_time": "SELECT y AS year FROM per_year WHERE y IN (1995, 1996, 1997, 1998, 1999, 2000)",
    "dim_location_keyed": """SELECT CAST((SELECT count(*) FROM _areas o WHERE o.area < a.area) + 1 AS INTEGER) AS location_id,
        CAST(a.area AS INTEGER) AS area_code, a.area_name FROM _areas a""",
    "fact_load": """SELECT crime_id, year,
        CAST((SELECT count(*) FROM _areas o WHERE o.area < i.area) + 1 AS INTEGER) AS location_id,
        crime_code, crime_desc, lat, lon FROM incident i""",
}

_AREAS = "_areas AS (SELECT DISTINCT area, area_name FROM incident)"


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {_COUNTS},\n{_ROWS},\n{_AREAS}\n{body.strip()}" for name, body in _QUERIES.items()}
