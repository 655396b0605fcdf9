"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from shelfscope.checks import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(rows):
    return sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else repr(v) for v in r) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert canonical(got) == canonical(want)
