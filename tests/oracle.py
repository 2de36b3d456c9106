"""Order-insensitive comparison of a Spark result with DuckDB over the same Parquet files."""

import datetime
import decimal
import os

import duckdb


def norm(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            p = os.path.join(sf_dir, f)
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def compare(df, sql, sf_dir):
    con = duck(sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns), (names, df.columns)
    order = sorted(names)
    key = lambda r: tuple((x is None, str(type(x)), x) for x in r)
    want = sorted((tuple(norm(r[names.index(c)]) for c in order) for r in cur.fetchall()), key=key)
    got = sorted((tuple(norm(r[c]) for c in order) for r in df.select(*order).collect()), key=key)
    assert len(got) == len(want), (len(got), len(want))
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, bad[:3]
