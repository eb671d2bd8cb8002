"""Run a query beside its SQL."""

import datetime
import os

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str = SMALL):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def sides(df, con, sql: str):
    cursor = con.execute(sql)
    names = sorted(c[0] for c in cursor.description)
    at = [[c[0] for c in cursor.description].index(n) for n in names]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
    assert sorted(df.columns) == names
    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr), theirs
