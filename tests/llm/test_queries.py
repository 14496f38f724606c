"""The registered queries over the given tables, and the pipeline against brute force."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks import compare
from classmap.llm import exact_dedup, quality
from classmap.llm.queries import ORACLES, QUERIES
from tests.llm import test_decontaminate, test_exact_dedup, test_near_copies, test_packing, test_simhash
from tests.llm.tables import SF_DIR


def test_registered():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
    assert [sum(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert compare.compare(QUERIES[name](spark, SF_DIR), compare.connect(SF_DIR), ORACLES[name]) == []


def test_simhash_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op3_simhash_near_dedup"](spark, SF_DIR).collect()
    assert sorted(map(tuple, found)) == sorted(test_simhash.brute(rows))


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    good = {r["doc_id"] for r in quality.score(docs, model).where("predicted = 1").collect()}
    rows = {i: t for i, t in rows.items() if i in good}
    rows = {i: rows[i] for i, _, _, kept, _ in test_exact_dedup.brute(list(rows.items())) if kept}
    rows = {i: rows[i] for i in test_near_copies.brute(list(rows.items()))}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _, _ in test_decontaminate.brute(list(rows.items()), items)}
    rows = {i: t for i, t in rows.items() if i not in bad}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    tokens = {}
    for r in found:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
    assert tokens == {i: len(test_packing.token_ids(t)) for i, t in rows.items()}


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    assert exact_dedup.SALTS > 1
