"""Registered queries over the given tables, and the pipeline against its parts."""

import pytest

import corpus_pipeline
from crawlweave.llm import queries
from crawlweave.llm.common import table
from tools.compare import canonical, connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(name, spark, sf):
    df = queries.QUERIES[name](spark, sf)
    result = connect(sf).execute(queries.ORACLES[name])
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), [d[0] for d in result.description])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_one_row_each(name, spark, sf):
    assert queries.QUERIES[name](spark, sf).count() == table(spark, sf, "pages" if name.startswith("op8") else "documents").count()


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    quality = {r.doc_id for r in queries.op10_quality_rules(spark, sf).where("kept").collect()}
    first = docs.where(docs.doc_id.isin(sorted(quality)))
    kept = {r.doc_id for r in queries.minhash.near_duplicates(first).where("kept").collect()}
    clean = {r.doc_id for r in queries.op9_decontamination(spark, sf).where("not contaminated").collect()}
    tokens = {r.doc_id: tuple(r) for r in queries.op3_bpe_roundtrip(spark, sf).collect()}
    got = {r.doc_id: tuple(r) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {k: tokens[k] for k in kept & clean}


def test_stages_keep_columns_and_gaps(spark, sf):
    docs = table(spark, sf, "documents").limit(20).selectExpr("*", "1 as n_words", "2 as kept", "3 as row", "4 as a", "5 as text_key")
    gaps = docs.limit(2).selectExpr("cast(null as bigint) doc_id", "cast(null as string) text", "lang", "source", "n_chars", "n_words", "kept", "row", "a", "text_key")
    docs = docs.unionByName(gaps).unionByName(docs.limit(3))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert out.count() <= docs.count()
    assert corpus_pipeline.near_duplicates(spark, docs, sf).where("doc_id is null").count() == 2


def test_near_duplicates_without_or_with_repeated_identifiers(spark, sf):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(None, a), (None, a + " z"), (None, b), (5, b), (7, c), (7, a + " y"), (9, c), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()]
    assert sorted(got, key=str) == sorted([(7, a + " y"), (5, b), (7, c), (None, None), (None, None)], key=str)
