"""Run a catalog query in Spark and its oracle SQL in DuckDB; compare results.

Comparison: same column names, same row count, same multiset of rows with
exact values (doubles compared bit for bit), columns sorted by name.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import __spark_entry__ as entry  # noqa: E402

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, repr(v))


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, name: str, sf_dir: str, verbose: bool = True) -> dict:
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    out = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    type_issues = {
        c: (s_types[c], d_types[c])
        for c in s_types
        if c in d_types and SPARK_TO_DUCK.get(s_types[c], s_types[c].upper()) != d_types[c]
    }
    if type_issues:
        out["type_issues"] = type_issues
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = "schema"
        out["detail"] = {
            "spark_only": sorted(set(s_cols) - set(d_cols)),
            "oracle_only": sorted(set(d_cols) - set(s_cols)),
        }
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        out["status"] = "match" if not type_issues else "types"
        return out
    out["status"] = "values"
    names = sorted(s_cols)
    diffs = []
    for ra, rb in zip(a, b):
        if ra != rb:
            diffs.append(
                {names[i]: (ra[i][1], rb[i][1]) for i in range(len(names)) if ra[i] != rb[i]}
            )
            if len(diffs) >= 3:
                break
    out["detail"] = diffs
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    from churnlab.session import build_session

    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            res = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and continue
            res = {"query": name, "status": "error", "detail": str(error)[:600]}
        if res["status"] not in ("match", "rows-only"):
            bad += 1
        print(res, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
