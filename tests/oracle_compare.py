"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def spark_type(t) -> str:
    name = t.simpleString()
    for prefix, fam in (("bigint", "int64"), ("int", "int32"), ("double", "float64"), ("string", "str")):
        if name.startswith(prefix):
            return fam
    return name


def duck_type(t) -> str:
    name = str(t)
    if name.startswith("DECIMAL"):
        return name.lower().replace(" ", "")
    return {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "boolean"}.get(name, name)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    vals = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, vals


def compare(spark, sf_dir: str, keys=None, verbose=True) -> dict[str, str]:
    import __spark_entry__ as entry
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[key](spark, sf_dir)
            s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
            s_types = {f.name: spark_type(f.dataType) for f in df.schema.fields}
            rel = con.sql(sql[key])
            d_types = {n: duck_type(t) for n, t in zip(rel.columns, rel.types)}
            res = con.execute(sql[key])
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
            sc, sv = canon(s_cols, s_rows)
            dc, dv = canon(d_cols, d_rows)
            if sc != dc:
                status = f"COLUMNS spark={sc} duck={dc}"
            elif s_types != d_types:
                status = f"TYPES spark={s_types} duck={d_types}"
            elif len(sv) != len(dv):
                status = f"ROWS spark={len(sv)} duck={len(dv)}"
            elif sv != dv:
                diff = [(a, b) for a, b in zip(sv, dv) if a != b][:3]
                status = f"VALUES {diff}"
            else:
                status = f"ok ({len(sv)} rows)"
        except Exception as exc:  # noqa: BLE001
            status = f"ERROR {type(exc).__name__}: {str(exc)[:300]}"
        results[key] = status
        if verbose:
            print(f"{key:28s} {time.time() - t0:6.2f}s {status}", flush=True)
    return results


if __name__ == "__main__":
    from civicmart.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session("oracle-compare", master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, keys)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    print(f"{len(res) - len(bad)}/{len(res)} match")
    sys.exit(1 if bad else 0)
