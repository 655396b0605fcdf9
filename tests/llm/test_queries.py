"""Every query of the subpackage on the smallest tables, against its SQL where there is one; the pipeline's stages."""

import math
import os

import duckdb
import pytest

import corpus_pipeline
from shelfscope.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def canonical(rows):
    return sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    assert got
    if name in ORACLES:
        con = duckdb.connect()
        for table in ("documents", "embeddings", "benchmark"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        result = con.execute(ORACLES[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert canonical(got) == canonical(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.select("doc_id", "lang", "source", "text", "n_chars").collect()
        kept = {r.doc_id for r in rows}
        assert len(kept) == len(rows) and kept <= ids and all(r.n_chars == len(r.text) for r in rows)
        docs, ids = spark.createDataFrame([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows], docs.schema), kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == ids
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == ids
