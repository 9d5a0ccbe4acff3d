"""Runs a query and its SQL twin over one folder of tables."""

import glob
import os
from collections import Counter

import duckdb

FOLDER = "/root/testdata/sf0.001"


def same(spark, query, sql, folder=FOLDER):
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = Counter(repr(tuple(r)) for r in df.select(*columns).collect())
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(folder + "/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    want = Counter(repr(r) for r in con.execute(f"select {', '.join(columns)} from ({sql})").fetchall())
    assert got == want
