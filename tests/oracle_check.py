"""Local stand-in for the driver's correctness gate.

Runs every ``queries()`` entry on Spark and the matching ``oracle_sql()``
on DuckDB over the same parquet directory and compares row count, column
names and an order-insensitive hash of the rounded values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "is_integer") and not isinstance(v, int):  # Decimal
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def table_hash(rows) -> str:
    lines = sorted(repr(tuple(_norm(x) for x in r)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    same_cols = sorted(s_cols) == sorted(d_cols)
    hs = table_hash([[r[i] for i in order_s] for r in s_rows])
    hd = table_hash([[r[i] for i in order_d] for r in d_rows])
    res["cols_match"] = same_cols
    res["hash_match"] = hs == hd
    res["status"] = "ok" if (same_cols and hs == hd and len(s_rows) == len(d_rows)) else "MISMATCH"
    if res["status"] != "ok":
        res["spark_cols"] = s_cols
        res["duck_cols"] = d_cols
        ss = sorted(repr(tuple(_norm(x) for x in [r[i] for i in order_s])) for r in s_rows)
        dd = sorted(repr(tuple(_norm(x) for x in [r[i] for i in order_d])) for r in d_rows)
        res["only_spark"] = [x for x in ss if x not in set(dd)][:3]
        res["only_duck"] = [x for x in dd if x not in set(ss)][:3]
    return res


def main(argv):
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from lendspark.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            res = compare(spark, con, name, fn, os_.get(name), sf_dir)
        except Exception as e:  # report and continue
            res = {"name": name, "status": "ERROR", "error": str(e)[:800]}
        if res["status"] not in ("ok", "rows-only"):
            bad += 1
        print(res, flush=True)
    print(f"done: {bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
