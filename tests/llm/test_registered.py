"""The registered queries on the smallest test tables, against SQL where it can say it."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from riskweave.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"create view {file.split('.')[0]} as select * from '{SMALL}/{file}'")
    made = QUERIES[name](spark, SMALL)
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    want = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
    key = lambda r: str(sorted(r.items()))
    assert sorted((r.asDict() for r in made.collect()), key=key) == sorted(want, key=key)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL).cache()
        counts.append(docs.count())
        assert (docs.columns == names) == (k + 1 < len(corpus_pipeline.STAGES))
    assert counts == sorted(counts, reverse=True)
    run = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert run == {r.doc_id: r.ids_sha256 for r in docs.collect()}


def test_nothing_else_imports_the_package():
    root = os.path.dirname(entry_module.__file__)
    for folder, _, files in os.walk(os.path.join(root, "riskweave")):
        if os.path.basename(folder) != "llm":
            for file in files:
                if file.endswith(".py"):
                    with open(os.path.join(folder, file)) as source:
                        assert "riskweave.llm" not in source.read(), file
    assert "riskweave.llm" in sys.modules
