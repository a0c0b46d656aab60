"""The batch job (R5): quality gates, audit refresh, verification.

    python -m civicmart.plans.job --tables <folder> --audit <path> [--policy warn|fail]
    spark-submit --py-files civicmart.zip civicmart/plans/job.py --mart <folder> --audit <path>

Gates collect one small row each (never fact rows). Policy ``warn`` logs and
goes on, ``fail`` raises at the first violated gate (null -> duplicate -> orphan)
and the refresh does not run.
"""

from __future__ import annotations

import argparse
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.operators import quality as Q
from civicmart.operators.views import yearly_kpi_view
from civicmart.plans.refresh import current_run, read_audit, refresh_audit
from civicmart.sources.mart import Mart

log = logging.getLogger(__name__)


class GateError(ValueError):
    """A quality gate failed under the ``fail`` policy."""


LEDGER = "job string, step int, name string, violations bigint, first_failure string, action string"


@dataclass
class GateReport:
    total_rows: int = 0
    nulls: dict[str, int] = field(default_factory=dict)
    duplicate_keys: int = 0
    orphan_rows: int = 0
    warnings: list[str] = field(default_factory=list)
    ledger: list[tuple] = field(default_factory=list)  # (step, name, violations, first_failure, action)

    @property
    def passed(self) -> bool:
        return not self.warnings


# Fixed values of the binding: the columns each bound table must provide.
REQUIRED_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_nationkey", "c_acctbal"],
    "nation": ["n_nationkey", "n_name"],
    "lineitem": ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
}


def check_sources(spark: SparkSession, tables_dir: str) -> None:
    """Fail fast before any gate: every bound table is readable and has its columns.

    Only schemas are read (file footers), no job runs over the data.
    """
    from civicmart.sources.tables import read_table
    problems = []
    for table, cols in REQUIRED_COLUMNS.items():
        try:
            present = set(read_table(spark, tables_dir, table).columns)
        except Exception as exc:  # noqa: BLE001 - reported below
            problems.append(f"{table}: unreadable ({type(exc).__name__})")
            continue
        missing = [c for c in cols if c not in present]
        if missing:
            problems.append(f"{table}: missing {missing}")
    if problems:
        raise ValueError("source check failed: " + "; ".join(problems))


def check_mart(spark: SparkSession, path: str) -> None:
    """Fail fast before any gate: every table of a materialized mart is there."""
    missing = []
    for table in Mart._fields:
        try:
            spark.read.parquet(f"{path.rstrip('/')}/{table}")
        except AnalysisException:
            missing.append(table)
    if missing:
        raise ValueError(f"mart check failed: no readable {', '.join(missing)} below {path}")


GATES = ("null", "duplicate", "orphan")  # in the order they are judged


def run_gates(mart: Mart, policy: str = "warn",
              null_cols: tuple[str, ...] = ("year", "location_id", "crime_desc"),
              report: GateReport | None = None) -> GateReport:
    """Null, duplicate and orphan gates on the fact (actions on one-row results).

    ``report`` is filled as the gates go, so that its ledger tells what happened also when a gate
    raises: each gate's violations and what was done (``passed``, ``warned``, ``failed``, ``skipped``).
    """
    if policy not in ("warn", "fail"):
        raise ValueError(f"policy must be 'warn' or 'fail', got {policy!r}")
    report = report if report is not None else GateReport()
    row = Q.fact_checks(mart.fact, mart.dim_location, null_cols).first()
    report.total_rows = int(row["total_rows"])
    report.nulls = {c: int(row[f"null_{c}"]) for c in null_cols}

    def judged(gate: str, violations: int, first: str | None, message: str) -> None:
        step = GATES.index(gate) + 1
        if not violations:
            report.ledger.append((step, gate, 0, None, "passed"))
            return
        message = f"gate {gate}: {message}"
        report.warnings.append(message)
        report.ledger.append((step, gate, violations, first, "failed" if policy == "fail" else "warned"))
        if policy == "fail":
            report.ledger += [(k + 1, g, None, None, "skipped") for k, g in enumerate(GATES) if k + 1 > step]
            raise GateError(message)
        log.warning(message)

    lacking = [c for c, n in report.nulls.items() if n]
    judged("null", sum(report.nulls.values()), lacking[0] if lacking else None,
           ", ".join(f"{report.nulls[c]} rows lack {c}" for c in lacking))
    keys = Q.duplicate_keys(mart.fact, ["crime_id"]).agg(F.count(F.lit(1)).alias("n"), F.min("crime_id").alias("first"))
    found = keys.first()
    report.duplicate_keys = int(found["n"])
    judged("duplicate", report.duplicate_keys, None if found["first"] is None else f"crime_id {found['first']}",
           f"{report.duplicate_keys} keys are used by several rows")
    report.orphan_rows = int(row["orphan_rows"])
    judged("orphan", report.orphan_rows, "location_id" if report.orphan_rows else None,
           f"{report.orphan_rows} rows point at no known location")
    return report


def write_ledger(spark: SparkSession, path: str, job: str, report: GateReport) -> None:
    """Append a job's steps to the ledger beside the audit log (a few rows)."""
    rows = [(job, *step) for step in report.ledger]
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_ledger")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All steps of all jobs: job, step, name, violations, first_failure, action."""
    return spark.read.schema(LEDGER).parquet(f"{path.rstrip('/')}/_ledger")


def run_batch(spark: SparkSession, mart: Mart, audit_path: str, policy: str = "warn",
              on_error: str = "keep_previous", job: str | None = None) -> tuple[GateReport, DataFrame]:
    """Gates -> refresh -> verify. Returns the gate report and the current audit log.

    Every step is written to the ledger with the run, whatever its end: a gate that stopped the job, the
    gates and the refresh it kept from running, a refresh that failed and which run stayed current.
    """
    report, step = GateReport(), len(GATES) + 1
    before = current_run(spark, audit_path)
    stays = f"kept run {before}" if before else "no run"
    try:
        run_gates(mart, policy, report=report)
        kpi = yearly_kpi_view(mart.fact, mart.population, mart.unemployment)
        try:
            run = refresh_audit(spark, kpi, audit_path, on_error="raise")
            report.ledger.append((step, "refresh", 0, None, f"wrote run {run}"))
        except Exception as exc:  # noqa: BLE001 - policy decides
            report.ledger.append((step, "refresh", 1, type(exc).__name__, stays))
            if on_error == "raise":
                raise
            log.error("audit refresh failed, %s: %s", stays, exc)
    except GateError:
        report.ledger.append((step, "refresh", None, None, stays))
        raise
    finally:
        if report.ledger:
            write_ledger(spark, audit_path, job or uuid.uuid4().hex, report)
    audit = read_audit(spark, audit_path)
    for r in audit.collect():  # one row per year
        log.info("year=%s total=%s rate=%s unemployment=%s", r["year"], r["total_crimes"],
                 r["crime_rate"], r["unemployment"])
    return report, audit


def main(argv: list[str] | None = None) -> int:
    from civicmart.session import build_session
    from civicmart.sources.mart import mart_from_tables, materialize_mart, read_mart

    ap = argparse.ArgumentParser(description="gates -> audit refresh -> verify")
    ap.add_argument("--tables", help="folder of the bound source tables")
    ap.add_argument("--mart", help="folder of a materialized mart (written from --tables if both given)")
    ap.add_argument("--audit", required=True)
    ap.add_argument("--policy", default="warn", choices=["warn", "fail"])
    ap.add_argument("--on-error", default="keep_previous", choices=["keep_previous", "raise"])
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    spark = build_session("civicmart-batch")
    if args.tables:
        check_sources(spark, args.tables)
    if args.tables and args.mart:
        mart = materialize_mart(mart_from_tables(spark, args.tables), args.mart)
    elif args.mart:
        check_mart(spark, args.mart)
        mart = read_mart(spark, args.mart)
    elif args.tables:
        mart = mart_from_tables(spark, args.tables)
    else:
        ap.error("give --tables and/or --mart")
    report, _ = run_batch(spark, mart, args.audit, args.policy, args.on_error)
    log.info("gates passed: %s", report.passed)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
