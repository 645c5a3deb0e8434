import numpy as np

import strata.llm.language as L


def test_subwords_do_not_depend_on_blocks(monkeypatch):
    text = " Añb, the wörd 日本 x" * 40
    whole = L.subwords(text)
    for step in (5, 7, 64):
        monkeypatch.setattr(L, "_STEP", step)
        assert (L.subwords(text) == whole).all()
    assert not L.subwords("12 !? \n").any()


def test_subwords_by_definition():
    # one word of two letters: edges and letters give a, b; <a, ab, b>; <ab, ab>; <ab>
    assert L.subwords("ab").sum() == 2 + 3 + 2 + 1


def test_held_out_accuracy(spark, data):
    docs = spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/documents.parquet")
    found = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = [r for r in found.collect() if r.held_out]
    assert len(held) > 150
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in held) <= 0.01 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_gibberish_is_rejected(spark, data):
    docs = spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model = L.fit(docs)
    texts = [r.text for r in docs.where(L.held_out() & (L.F.length("text") > 200)).select("text").collect()]
    assert len(texts) > 100
    assert sum(model(L.gibberish(t))[2] for t in texts) >= 0.95 * len(texts)
    assert sum(model(t)[2] for t in texts) <= 0.005 * len(texts)
    for text in ("xq zvw kjh bnm pqrt wlkj zzxc qwrt", "нжщ ъфы эюб лмд ркт "):
        found = model(text * 30)
        assert found[0] in model.languages and 0 < found[1] <= 1 and found[2]


def test_short_texts_are_kept(spark, data):
    docs = spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/documents.parquet")
    found = L.identify(docs.where("text rlike '[a-z]'").withColumn("text", L.F.substring("text", 1, 12)), L.fit(docs))
    assert found.where("rejected").count() <= 0.002 * found.count()


def test_gibberish_keeps_all_but_letters():
    text = "Añb 12, x\n日本! " * 9
    for words in (text, text + "?"):
        made = L.gibberish(words)
        assert len(made) == len(words) and made == L.gibberish(words) != words
        assert all(a == b if not a.isalpha() else b.isalpha() for a, b in zip(words, made))
    assert L.gibberish("") == "" and L.gibberish("12 !") == "12 !"


def test_held_out_rows_are_never_learned(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    wrong = docs.withColumn("lang", L.F.when(L.held_out(), "zz").otherwise(L.F.col("lang")))
    assert "zz" not in L.fit(wrong).languages
    one, two = L.fit(docs), L.fit(wrong)
    assert np.allclose(one.table, two.table)


def test_odd_rows(spark, odd, none, make_docs):
    found = L.identify(odd).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == 9
    for at in (2, 3, 4):
        assert (by_id[at].lang_pred, by_id[at].score, by_id[at].rejected) == ("und", 0.0, True)
    assert L.identify(none).count() == 0
    unlabelled = make_docs([(1, "some words", None), (2, "others", None)])
    assert {(r.lang_pred, r.score) for r in L.identify(unlabelled).collect()} == {("und", 0.0)}
    assert L.accepted(unlabelled).count() == 2
    assert L.accepted(make_docs([(1, "some", None), (2, "12 !", None), (3, None, None)])).count() == 1


def test_filter_keeps_the_rows(spark, odd):
    kept = L.accepted(odd)
    assert kept.columns == odd.columns
    assert not {2, 3, 4} & {r.doc_id for r in kept.collect()}
