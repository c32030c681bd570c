"""Registered queries, the corpus pipeline, and the SQL of the operators that have one."""

import os

import pytest
from compare import check, connect

from __spark_entry__ import oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
OPERATORS = [n for n in queries() if n.startswith("op")]


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in OPERATORS) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n in OPERATORS if n in oracle_sql()])
def test_agrees_with_sql(spark, name):
    assert check(spark, connect(SF_DIR), name, queries()[name], oracle_sql()[name], SF_DIR) == ""


def test_stages_follow_each_other(spark):
    import corpus_pipeline as c

    from lumitrace.workspace import materialize

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in c.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    pieces = materialize(c.STAGES[-1][1](spark, docs, SF_DIR), "stage")
    assert pieces.select("doc_id").distinct().count() == sizes[-1]
    # Neither copies nor contaminated documents are left.
    from lumitrace.llm import decontamination, near_duplicates

    assert near_duplicates.components(docs).filter("NOT kept").count() == 0
    assert decontamination.contamination(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).filter("contaminated").count() == 0
    assert [n for n, _ in c.STAGES] == ["language id", "line dedup", "near duplicates", "decontamination", "packing"]


def test_run_gives_the_last_stage(spark):
    out = queries()["pipeline"](spark, SF_DIR)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
