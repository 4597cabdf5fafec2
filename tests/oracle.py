"""Compare a query with its DuckDB SQL on one folder of tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def duck(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def compare(spark, query, sql, folder="/root/testdata/sf0.01"):
    con = duck(folder)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    df = query(spark, folder)
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = sorted((tuple(norm(v) for _, v in sorted(zip(names, r))) for r in cur.fetchall()), key=key)
    got = sorted((tuple(norm(r[c]) for c in sorted(names)) for r in df.collect()), key=key)
    assert len(got) == len(want), (len(got), len(want))
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    assert not bad, (len(bad), bad[:3])
    return len(got)
