"""Run a query and its SQL twin and compare them as multisets."""

import glob
import os
from collections import Counter

import duckdb


def oracle_rows(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    return names, result.fetchall()


def as_multiset(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, sql, sf_dir):
    """Column names of both sides, and the rows only one side has."""
    names, expected = oracle_rows(sql, sf_dir)
    ours = as_multiset(df.columns, [tuple(r) for r in df.collect()])
    theirs = as_multiset(names, expected)
    return sorted(df.columns), sorted(names), ours - theirs, theirs - ours
