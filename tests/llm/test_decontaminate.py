from twin import connect, differences

from strata.llm import decontaminate as D

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def bench(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, win string")


def test_equals_its_twin(spark, data):
    big = data.replace("sf0.001", "sf0.01")
    docs, items = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "benchmark"))
    assert differences(D.contamination(docs, items), connect(big), D.SQL) == []


def test_windows_short_items_and_case(spark, make_docs):
    docs = make_docs([
        (1, "start " + ITEM.upper() + " end"), (2, " ".join(ITEM.split()[:9])), (3, "Two-words here"),
        (4, "two, words"), (5, "nothing " + " ".join(ITEM.split()[1:11]) + " else"), (6, "solo"), (6, "solo"),
        (7, ITEM + " " + ITEM), (8, None), (9, ""), (None, ITEM),
    ])
    items = bench(spark, [(10, ITEM), (11, "two words"), (12, "Solo!"), (13, None), (14, "..."), (15, ITEM), (None, "end")])
    found = D.contamination(docs, items).collect()
    by_id = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found}
    assert len(found) == 11
    assert by_id[1] == (14, 13, 2, True)  # "end" is an item without an id
    assert by_id[2] == (9, 0, 0, False)
    assert by_id[3][:3] == (3, 2, 1) and by_id[4][:3] == (2, 2, 1)
    assert by_id[5] == (12, 10, 2, True)
    assert by_id[6] == (1, 1, 1, True) and by_id[7][1] == 24
    assert by_id[8] == by_id[9] == (0, 0, 0, False)
    assert by_id[None][1] == 12


def test_random_shared_spans_against_the_twin(spark, tmp_path):
    import random

    draw = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))) for i in range(120)]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([1, 3, 5, 9, 10, 11, 30])))) for i in range(40)]
    # parts of documents become items
    items += [(100 + i, " ".join(t.split()[5:25])) for i, t in docs[:20]]
    for name, rows, kind in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        spark.createDataFrame(rows, f"{kind} long, text string").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    frames = [spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in ("documents", "benchmark")]
    assert differences(D.contamination(*frames), con, D.SQL) == []


def test_empty_tables_and_filter(spark, odd, none):
    items = bench(spark, [(1, "one")])
    assert D.contamination(none, items).count() == 0
    clean = D.contamination(odd, bench(spark, []))
    assert clean.count() == 9 and clean.where("contaminated").count() == 0
    kept = D.uncontaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == 8 and kept.where("doc_id = 6").count() == 0


def test_no_python_runs(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = D.contamination(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
