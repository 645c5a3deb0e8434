from twin import connect, differences

from strata.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string, lines string, turns string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_equals_its_twin(spark, data):
    frame = spark.read.parquet(f"{data}/conversations.parquet")
    assert differences(chat.perspectives(frame), connect(data), chat.SQL) == []


def test_every_participant_once_as_the_assistant(spark):
    rows = [(1, 0, "system", "be nice"), (1, 1, "ann", "hi"), (1, 2, "bob b", "h<|im_end|>o"), (1, 3, "ann", None)]
    found = {r.speaker: r for r in chat.perspectives(turns(spark, rows)).collect()}
    assert set(found) == {"ann", "bob b"}
    ann = found["ann"]
    assert ann.text.count("<|im_start|>") == 4 and ann.text.count("<|im_end|>") == 4
    assert "user name=bob_b\n" in ann.text and "system\nbe nice" in ann.text
    covered = [ann.text[int(a) : int(b)] for a, b in (x.split(":") for x in ann.masks.split(","))]
    assert covered == ["hi<|im_end|>", "<|im_end|>"]
    assert (ann.n_turns, ann.n_own, found["bob b"].n_own) == (4, 2, 1)


def test_odd_rows(spark):
    rows = [
        (None, 1, "ann", "x"), (2, 1, None, "x"), (3, None, "ann", "late"), (3, 1, "ann", "tie b"),
        (3, 1, "ann", "tie a"), (3, 1, "ann", "tie a"), (4, 1, "system", "alone"),
    ]
    found = {(r.conv_id, r.part): r for r in chat.perspectives(turns(spark, rows)).collect()}
    assert set(found) == {(3, 0), (3, None)}
    assert found[3, 0].n_turns == 3
    assert found[3, 0].text.index("tie a") < found[3, 0].text.index("tie b")
    assert chat.perspectives(turns(spark, [])).count() == 0


def test_a_long_conversation_comes_in_parts(spark):
    rows = [(9, i, ("ann", "bob")[i % 2], f"t{i}") for i in range(100)]
    found = chat.perspectives(turns(spark, rows), part_turns=16).collect()
    assert len(found) == 2 * 7 and max(r.n_turns for r in found) == 16
    assert sum(r.n_own for r in found) == 100


def test_no_python_runs(spark, data):
    frame = spark.read.parquet(f"{data}/conversations.parquet")
    plan = chat.perspectives(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
