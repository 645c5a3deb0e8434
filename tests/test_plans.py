"""What the plans must and must not contain."""

import pytest

from strata.queries import all_queries

# a single task sees one row per rule, per run input or per file here
ONE_TASK_WINDOW = {"metrics_top_violations", "extract_parse"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_pairs_no_python_no_single_task(spark, data, name):
    text = plan(all_queries()[name](spark, data))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text
    if name not in ONE_TASK_WINDOW:
        lines = text.splitlines()
        for at, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # only the end of a global aggregate may meet in one task
                assert any(end in lines[at + 1] for end in ("Aggregate(keys=[]", "Aggregate(key=[]"))


def test_filters_and_columns_reach_the_scan(spark, data):
    from strata.operators.quality import Rule, assess, clean_rows
    from strata.queries.tables import table

    rules = [Rule("QUARANTINE", "l_discount = 0")]
    clean = clean_rows(assess(table(spark, data, "lineitem"), rules)).filter("l_quantity > 10")
    text = plan(clean.select("l_orderkey"))
    assert "GreaterThan(l_quantity,10.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_discount:double>" in text


def test_gold_moves_the_marks_once(spark, data):
    """Slices, alignment, islands and trimming share one shuffle by key."""
    from strata.queries.validity import counts, entities, states
    from strata.operators.temporal import islands, timeline, trim
    from strata.session import save_and_read

    session = spark.newSession()
    hist, count = states(session, data), counts(session, data)
    hist = type(hist)(save_and_read(hist.frame, "h"), hist.keys, hist.start, hist.end)
    count = type(count)(save_and_read(count.frame, "c"), count.keys, count.start, count.end)
    rows = timeline([(hist, ["status"]), (count, ["n"])]).join(entities(session, data), "k")
    attributes = ["group_name", "type_code", "status", "n"]
    merged = islands(rows, ["k"], attributes, "slice_start", "slice_end")
    text = plan(trim(merged, ["k"], "slice_start", "slice_end"))
    assert text.count("Exchange hashpartitioning") == 1


def test_gold_is_dealt_out_by_its_size(spark, data, monkeypatch):
    """A task of the wide steps holds a number of rows, not a share of the table."""
    from strata.plans import group_dimension as dim
    from strata.queries.validity import gold_group

    want = sorted(map(str, gold_group(spark, data).collect()))
    monkeypatch.setattr(dim, "ROWS_OF_A_TASK", 100)
    found = gold_group(spark, data)
    dealt = [x for x in plan(found).splitlines() if "REPARTITION_BY_NUM" in x]
    assert len(dealt) >= 3 and all(int(x.split("), REPARTITION")[0].rsplit(" ", 1)[1]) > 20 for x in dealt)
    assert sorted(map(str, found.collect())) == want
