"""Run queries() against oracle_sql() the way the driver does (row count,
column names, order-insensitive values), reporting exact and approximate
(float-tolerant) matches.
Usage: python tests/compare.py [--json report.json] [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "smallint": "SMALLINT",
    "float": "FLOAT",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def rows_of(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir, names=None):
    from __spark_entry__ import oracle_sql, queries

    qs, oq = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e)[:300])
            continue
        dt = time.time() - t
        if name not in oq:
            results[name] = ("NO_ORACLE", f"{len(s_rows)} rows {dt:.2f}s")
            continue
        try:
            rel = con.sql(oq[name])
            d_cols = rel.columns
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("ORACLE_ERROR", str(e)[:300])
            continue
        if sorted(s_cols) != sorted(d_cols):
            results[name] = ("COLS", f"{sorted(s_cols)} vs {sorted(d_cols)}")
            continue
        s_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
        d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
        bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
        if bad_types:
            results[name] = ("TYPES", str(bad_types))
            continue
        if len(s_rows) != len(d_rows):
            results[name] = ("ROWCOUNT", f"{len(s_rows)} vs {len(d_rows)}")
            continue
        exact = rows_of(s_cols, s_rows, None) == rows_of(d_cols, d_rows, None)
        approx = rows_of(s_cols, s_rows, 6) == rows_of(d_cols, d_rows, 6)
        status = "EXACT" if exact else ("APPROX" if approx else "MISMATCH")
        detail = f"{len(s_rows)} rows {dt:.2f}s"
        if not approx:
            a, b = rows_of(s_cols, s_rows, 6), rows_of(d_cols, d_rows, 6)
            diffs = [(x, y) for x, y in zip(a, b) if x != y][:2]
            detail += f" cols={sorted(s_cols)} first diffs={diffs}"
        results[name] = (status, detail)
    return results


if __name__ == "__main__":
    import json

    from pacelake.session import build_session

    args = sys.argv[1:]
    out_json = None
    if "--json" in args:
        i = args.index("--json")
        out_json = args[i + 1]
        del args[i : i + 2]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or None
    spark = build_session("local[8]")
    res = compare(spark, sf, names)
    if out_json:
        with open(out_json, "w") as fh:
            json.dump({k: {"status": s, "detail": d} for k, (s, d) in res.items()}, fh, indent=1)
    for k, (s, d) in res.items():
        print(f"{s:12s} {k:36s} {d}")
    print({s: sum(1 for v in res.values() if v[0] == s) for s in sorted({v[0] for v in res.values()})})
    sys.exit(0 if all(v[0] in ("EXACT", "APPROX", "NO_ORACLE") for v in res.values()) else 1)
