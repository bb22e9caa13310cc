"""The pipeline and the registered queries on the supplied tables."""

import pytest

import corpus_pipeline
from sigweave.llm import langid, queries, toxicity
from tests.conftest import rows_of
from tests.llm.test_nearcopies import brute_roots


def test_sql_of_registered_queries(spark, duck, sf_dir):
    for name, sql in queries.CHECKS.items():
        expected = duck.execute(sql)
        columns = [c[0] for c in expected.description]
        found = queries.QUERIES[name](spark, sf_dir)
        assert rows_of(found, *columns) == sorted(map(tuple, expected.fetchall()), key=repr)


def test_stages_keep_what_their_operators_keep(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r.doc_id: r for r in docs.collect()}
    scores = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    expected = {r.doc_id for r in scores if r.score < 0.5}
    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "language", "near_copies", "mixing"):
        docs = spark.createDataFrame(stages[name](spark, docs, sf_dir).collect(), docs.schema)
        rows = docs.collect()
        if name == "language":
            model = langid.fit(spark.createDataFrame([kept[i] for i in expected], docs.schema))
            expected = {i for i in expected if not langid.predict(kept[i].text, model)[2]}
        if name == "near_copies":
            smallest = brute_roots([(i, kept[i].text) for i in sorted(expected)])
            expected = {i for i in expected if smallest[i] == i}
        assert docs.columns == list(kept[0].asDict())
        assert {r.doc_id for r in rows} == expected
        assert sorted(rows) == sorted(kept[i] for i in expected)
    pieces = stages["packing"](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == expected


def test_near_copies_of_odd_rows(spark, sf_dir):
    rows = [(1, "a b c d e", "en", "s", 9), (2, "a b c d e", "en", "s", 9), (1, "a b c d e", "en", "s", 9)]
    rows += [(None, "a b c d e", "en", "s", 9), (3, None, None, None, None), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_copies_out(spark, docs, sf_dir)
    assert rows_of(kept, "doc_id") == [(1,), (3,), (None,)]


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_an_empty_table(spark, sf_dir, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id IS NULL")
    assert corpus_pipeline.STAGES[stage][1](spark, docs, sf_dir).count() == 0
