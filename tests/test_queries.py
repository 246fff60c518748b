"""Every query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from textkiln import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def against_duckdb(spark, query, sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = query(spark, sf)
    names = sorted(got.columns)
    rows = sorted((tuple(norm(r[c]) for c in names) for r in got.collect()), key=repr)
    found = con.execute(sql)
    have = [d[0] for d in found.description]
    assert sorted(have) == names
    at = [have.index(c) for c in names]
    assert rows == sorted((tuple(norm(r[i]) for i in at) for r in found.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_its_sql(spark, name):
    against_duckdb(spark, plans.QUERIES[name], plans.SQL[name])


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_query_without_sql_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0
