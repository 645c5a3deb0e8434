import pytest

import __spark_entry__ as contract

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_every_query_is_registered():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(contract.oracle_sql()) <= names


def test_stages_in_order(spark, data):
    from strata.session import save_and_read

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = save_and_read(stage(spark, docs, data), name)
        sizes.append(docs.count())
        if name != "encoding":
            assert docs.columns == columns
        if name == "near_duplicates":
            assert docs.groupBy("text").count().where("count > 1").count() == 0
        if name == "personal_data":
            assert docs.where("text rlike '[a-z0-9]@[a-z0-9]+[.]com'").count() == 0
            assert docs.where("n_chars <> length(text)").count() == 0
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.7 * sizes[0]
    again = corpus_pipeline.run(spark, data)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_odd_documents_pass(spark, odd, data):
    from strata.session import save_and_read

    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = save_and_read(stage(spark, docs, data), name)
    assert {r.doc_id for r in docs.collect()} <= {1, 5, 6, 7, None}
