"""Registered training-data queries: SQL on the smallest data, the pipeline, round trips."""

import hashlib
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from brute import hits  # noqa: E402
from check_oracle import TABLES, normal  # noqa: E402

from riskframe.llm.oracle import llm_sql  # noqa: E402
from riskframe.llm.queries import llm_queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_equals_sql(spark, con, name):
    got = llm_queries()[name](spark, FOLDER)
    want = con.execute(llm_sql()[name]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, want))


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(llm_sql()) <= set(entry.oracle_sql())


def test_pieces_query_round_trip(spark, con):
    texts = dict(con.execute("select doc_id, coalesce(text, '') from documents").fetchall())
    rows = llm_queries()["op4_sentencepiece"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)


def test_pipeline_stages(spark, con):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    toxic = dict(con.execute("select doc_id, toxic from labels").fetchall())
    sizes = [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, FOLDER)
        assert docs.columns == spark.read.parquet(f"{FOLDER}/documents.parquet").columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] == sizes[2] >= sizes[3] >= sizes[4] > 0.6 * sizes[0]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = con.execute("select item_id, text from benchmark").fetchall()
    assert not any(v[2] for v in hits(rows, items).values())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert out.count() == len(rows)
    assert sum(toxic.get(i, 0) for i, _ in rows) <= 2


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100


def test_values_are_comparable():
    import pandas as pd

    assert normal(pd.DataFrame({"a": [1], "b": [None]})) == [("1", "null")]
