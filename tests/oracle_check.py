"""Run a registered query in Spark and its SQL in DuckDB; compare the results.

Rows are compared as multisets after sorting; doubles are rounded to 9
significant digits (``ORACLE_EXACT=1``: compared bit for bit), everything
else must be equal.  Also usable as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    return v


def _key(row):
    return tuple((v is None, "" if v is None else str(type(v).__name__), v if v is not None else 0)
                 for v in row)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def compare(spark, con, name: str, sf_dir: str, sql: str, query) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    ok = sc == dc and sr == dr
    info = {"name": name, "ok": ok, "rows": (len(sr), len(dr)), "spark_s": round(t1 - t0, 2),
            "duck_s": round(t2 - t1, 2)}
    if not ok:
        info["cols"] = (sc, dc)
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        info["only_spark"] = diff_s
        info["only_duck"] = diff_d
    return info


def main(argv):
    import __spark_entry__ as ent
    from tokenledger.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(ent.queries())
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = ent.queries(), ent.oracle_sql()
    bad = 0
    for n in names:
        try:
            info = compare(spark, con, n, sf_dir, sqls[n], qs[n])
        except Exception as e:  # report and continue
            info = {"name": n, "ok": False, "error": repr(e)[:400]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
