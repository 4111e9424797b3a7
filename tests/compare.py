"""Queries against their SQL on DuckDB: the same rows, whatever their order."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def engine(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    show = lambda x: f"{x:.6f}" if isinstance(x, float) else str(x)
    return [names[i] for i in order], sorted(tuple(show(r[i]) for i in order) for r in rows)


def both(spark, name, sf_dir, queries, sql):
    df = queries[name](spark, sf_dir)
    got = canon([tuple(r) for r in df.collect()], df.columns)
    other = engine(sf_dir).sql(sql[name])
    return got, canon(other.fetchall(), other.columns)


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
