import os

import duckdb
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def crowd(df):
    """Extra columns named like the operators' own."""
    for name in ("c", "label", "score", "h", "rank", "size", "n", "key", "__index"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(name))
    return df


def same_as_sql(spark, query, sql):
    """The query's rows on SF equal DuckDB's."""
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = query(spark, SF)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    key = lambda r: tuple((x is not None, x) for x in r)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=key)
    want = sorted(cur.fetchall(), key=key)
    got, want = [[tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows] for rows in (got, want)]
    assert got == want
    return got
