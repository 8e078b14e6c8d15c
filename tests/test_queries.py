"""Every registered query of the library against its SQL, on the driver's smallest tables."""

import math
import os

import duckdb
import pytest

from geoloom.plans import queries as q
from geoloom.plans import queries_more, queries_sources, queries_tables  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_query_equals_sql(spark, duck, name):
    out = q.QUERIES[name](spark, SF)
    found = rows_of(out.columns, [tuple(r) for r in out.collect()])
    cur = duck.execute(q.ORACLES[name])
    wanted = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert found == wanted


def test_name_similarity(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    assert q.name_similarity_udf(spark, SF).where("alike").count() > 0
