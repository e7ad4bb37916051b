"""Run a Spark DataFrame and a DuckDB SQL twin over the same parquet tables and
compare them order-insensitively (column names, row count, values)."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def _key(row):
    return tuple((x is None, str(type(x) in (int, float)), x if x is not None else 0) if not isinstance(x, str)
                 else (False, "s", x) for x in row)


def compare(spark_df, sql: str, sf_dir: str, digits: int = 9, con=None):
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: spark={scols} duck={dcols}")
        return problems
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    if len(srows) != len(drows):
        problems.append(f"row count spark={len(srows)} duck={len(drows)}")
    s = sorted([tuple(_norm(x, digits) for x in r) for r in srows], key=lambda r: tuple(map(str, r)))
    d = sorted([tuple(_norm(x, digits) for x in r) for r in drows], key=lambda r: tuple(map(str, r)))
    bad = [(a, b) for a, b in zip(s, d) if a != b]
    if bad:
        problems.append(f"{len(bad)} differing rows, first: spark={bad[0][0]} duck={bad[0][1]}")
    return problems
