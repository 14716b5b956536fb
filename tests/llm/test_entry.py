"""Registered queries: their SQL twins, and the pipeline stage by stage."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_points  # noqa: E402
import corpus_pipeline  # noqa: E402
import pytest  # noqa: E402
from compare import connect, duck_rows, spark_rows  # noqa: E402

from tidelog.llm import licenses, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_all_are_registered():
    names = set(entry_points.queries())
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_sql_twins(spark, name):
    found = spark_rows(queries.registered()[name](spark, SF_DIR))
    assert found == duck_rows(connect(SF_DIR), queries.oracle()[name])


def test_license_twin_knows_short_notices(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = licenses.license_matches(docs, licenses.TEMPLATES)
    assert spark_rows(found) == duck_rows(connect(SF_DIR), licenses.oracle(licenses.TEMPLATES))
    short = queries.registered()["op5_license_scans"](spark, SF_DIR).where("license = 'All-rights-reserved'")
    have = docs.where("lower(text) rlike 'all\\\\W+rights\\\\W+reserved'")
    assert {r.doc_id for r in short.collect()} == {r.doc_id for r in have.collect()} != set()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written_table(stage(spark, docs, SF_DIR), name)
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and left <= ids and docs.count() == len(left)
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == ids


def test_pipeline_takes_odd_and_empty_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = corpus_pipeline.written_table(stage(spark, docs, SF_DIR), name)
            assert found.columns == docs.columns
            assert found.count() <= docs.count()
            docs = found
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()
