"""Side-by-side check of a registered query against its DuckDB statement.

Used by the tests and by ``python -m vistasieve.plans.check [sf_dir] [names...]``.
Rows are compared as multisets after sorting columns by name; floats are
compared exactly unless ``float_digits`` is given.
"""

from __future__ import annotations

import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, float_digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, float_digits) if float_digits is not None else v
    if hasattr(v, "item"):
        return _norm(v.item(), float_digits)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, float_digits) for x in v)
    return v


def rows_of(columns, records, float_digits=None):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], float_digits) for i in order) for r in records]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, sf_dir: str, name: str, con=None, float_digits=None):
    from vistasieve.plans.queries import ORACLE, QUERIES

    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    con = con or duck(sf_dir)
    res = con.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    sc, sr = rows_of(s_cols, s_rows, float_digits)
    dc, dr = rows_of(d_cols, d_rows, float_digits)
    ok = sc == dc and sr == dr
    info = {"name": name, "ok": ok, "spark_rows": len(sr), "duck_rows": len(dr), "spark_s": round(t1 - t0, 2),
            "duck_s": round(t2 - t1, 2)}
    if not ok:
        info["spark_cols"], info["duck_cols"] = sc, dc
        ss, ds = set(sr), set(dr)
        info["only_spark"] = sorted(ss - ds, key=repr)[:5]
        info["only_duck"] = sorted(ds - ss, key=repr)[:5]
    return info


def main(argv):
    from vistasieve.plans.queries import ORACLE
    from vistasieve.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(ORACLE)
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            info = compare(spark, sf_dir, n, con)
        except Exception as exc:  # report and continue with the others
            info = {"name": n, "ok": False, "error": repr(exc)[:500]}
        bad += not info["ok"]
        print(info, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
