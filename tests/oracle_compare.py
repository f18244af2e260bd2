"""Run registered queries in Spark and their oracle SQL in DuckDB; compare row count, column
names, column kinds and an order-insensitive value hash (floats rounded to 6 places)."""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from wordloom.session import TABLES  # noqa: E402


def _kind_spark(t: str) -> str:
    t = t.lower()
    if t in ("bigint", "int", "integer", "smallint", "tinyint", "long", "short", "byte"):
        return "int"
    if t in ("double", "float", "real") or t.startswith("decimal"):
        return "float"
    if t in ("string",):
        return "str"
    if t == "boolean":
        return "bool"
    if t.startswith("array"):
        return "list"
    return t


def _kind_duck(t: str) -> str:
    t = t.upper()
    if t in ("BIGINT", "INTEGER", "SMALLINT", "TINYINT", "HUGEINT", "UBIGINT", "UINTEGER"):
        return "int"
    if t in ("DOUBLE", "FLOAT", "REAL") or t.startswith("DECIMAL"):
        return "float"
    if t == "VARCHAR":
        return "str"
    if t == "BOOLEAN":
        return "bool"
    if t.endswith("[]"):
        return "list"
    return t.lower()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def _digest(rows):
    lines = sorted(json.dumps(r, sort_keys=False, default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name: str, fn, sql: str, sf_dir: str, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = [(f.name, _kind_spark(f.dataType.simpleString())) for f in sdf.schema.fields]
    s_rows = [list(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [(d[0], _kind_duck(str(d[1]))) for d in rel.description]
    d_rows = [list(r) for r in rel.fetchall()]
    t2 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "duck_sec": round(t2 - t1, 2)}
    s_order = sorted(range(len(s_cols)), key=lambda i: s_cols[i][0])
    d_order = sorted(range(len(d_cols)), key=lambda i: d_cols[i][0])
    res["names_match"] = [s_cols[i][0] for i in s_order] == [d_cols[i][0] for i in d_order]
    res["kinds_match"] = [s_cols[i][1] for i in s_order] == [d_cols[i][1] for i in d_order]
    if not res["kinds_match"]:
        res["kinds"] = {"spark": [s_cols[i] for i in s_order], "duck": [d_cols[i] for i in d_order]}
    sh, sl = _digest([[_norm(r[i]) for i in s_order] for r in s_rows])
    dh, dl = _digest([[_norm(r[i]) for i in d_order] for r in d_rows])
    res["values_match"] = sh == dh
    if sh != dh:
        only_s = sorted(set(sl) - set(dl))[:3]
        only_d = sorted(set(dl) - set(sl))[:3]
        res["diff"] = {"spark_only": [x[:300] for x in only_s], "duck_only": [x[:300] for x in only_d]}
    res["ok"] = res["names_match"] and res["kinds_match"] and res["values_match"] and len(s_rows) == len(d_rows)
    return res


def main(argv):
    import argparse
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from wordloom.plans.catalog import oracle_sql, queries
    from wordloom.session import get_session
    spark = get_session("local[8]", 8)
    qs, sqls = queries(), oracle_sql()
    names = a.names or sorted(sqls)
    con = duck_connect(a.sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, qs[n], sqls[n], a.sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "ok": False, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        bad += not r["ok"]
        print(json.dumps(r), flush=True)
    print(f"# {len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
