"""The pipeline's stages on odd rows and on the smallest documents."""
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortqc.llm.common import written
from tests.compare import connect, duck_rows, normal, spark_rows
from tests.llm.fixture import counter, rows, table

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op4_secret_scan", "op10_pfair_mixing"])
def test_sql(spark, name):
    con = connect(SF)
    columns, got = spark_rows(entry.queries()[name](spark, SF))
    sql_columns, want = duck_rows(con, entry.oracle_sql()[name])
    assert normal(columns, got) == normal(sql_columns, want) and sorted(columns) == sorted(sql_columns)


def test_stages_only_drop_or_reorder_rows(spark):
    docs = table(spark)
    before = counter((r.doc_id, r.text) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == table(spark).columns
        after = counter((r.doc_id, r.text) for r in docs.collect())
        assert not after - before
        if name == "source_mixing":
            assert after == before
        before = after
    assert sum(before.values()) < len(rows())


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    kept = {r.doc_id for r in got.collect()}
    assert 0 < len(kept) < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]


def test_empty_documents(spark):
    docs = table(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SF), f"empty-{name}")
    assert docs.count() == 0
