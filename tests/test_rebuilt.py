"""Derived tables refreshed by key against the same build over everything."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from strata.sources import maintained as m
from strata.sources import rebuilt as r

SCHEMA = "k string, line string, business_date date, processing_time long, v string"


def frame(spark, rows):
    made = [(k, line, date(2025, 1, 1) + timedelta(d), p, v) for k, line, d, p, v in rows]
    return spark.createDataFrame(made, SCHEMA)


def inputs(root):
    return {
        "names": m.Maintained(f"{root}/names", ["k"], "business_date", many=3, fold=1.5),
        "states": m.Maintained(f"{root}/states", ["k", "line"], "business_date", history=True, many=3, fold=1.5),
    }


def build(names, states):
    """Versions of the keys whose name does not say that they are gone."""
    kept = names.filter("v <> 'gone'").select("k", F.col("v").alias("name"))
    same = kept["k"].eqNullSafe(states["k"])
    return states.join(kept, same).select(states["k"], "line", "name", "v", "start_at", "end_at")


def bag(df):
    return sorted(str(tuple(x)) for x in df.select(sorted(df.columns)).collect())


def same(spark, table, kept):
    want = build(*(m.current(spark, t) for t in kept.values()))
    assert bag(r.shown(spark, table)) == bag(want)


def draw(rng, count):
    keys = ["a", "b", "c", "d", None, "hot", "hot"]
    return [
        (rng.choice(keys), rng.choice("xy"), rng.randint(0, 12), rng.randint(0, 3), rng.choice(["p", "q", "gone"]))
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_refreshes_equal_the_whole_build(spark, tmp_path, seed):
    rng, kept = random.Random(seed), inputs(tmp_path)
    table = r.Rebuilt(str(tmp_path / "gold"), ["k"], many=2, fold=1.0)
    for batch in range(6):
        for name, count in (("names", rng.choice([0, 2])), ("states", rng.choice([1, 6]))):
            if batch == 0 or count:
                m.apply_changes(kept[name], frame(spark, draw(rng, count if batch else 8)), "feed", batch)
        r.refresh(spark, table, kept, build)
        same(spark, table, kept)
    r.compact(spark, table)
    same(spark, table, kept)


def fed(spark, tmp_path):
    kept = inputs(tmp_path)
    table = r.Rebuilt(str(tmp_path / "gold"), ["k"], fold=10.0)
    for name in kept:
        m.apply_changes(kept[name], frame(spark, [(k, "x", 0, 1, "p") for k in "abcdef"]), "feed", 0)
    return kept, table


def test_only_touched_keys_are_built(spark, tmp_path):
    kept, table = fed(spark, tmp_path)
    first = r.refresh(spark, table, kept, build)
    assert r.refresh(spark, table, kept, build) == first  # nothing new
    m.apply_changes(kept["states"], frame(spark, [("b", "x", 5, 1, "q")]), "feed", 1)
    seen = []

    def watched(names, states):
        seen.append(({x.k for x in names.collect()}, {x.k for x in states.collect()}))
        return build(names, states)

    second = r.refresh(spark, table, kept, watched)
    assert seen == [({"b"}, {"b"})]
    assert second.base == first.base and second.delta_rows == 2
    same(spark, table, kept)


def test_a_key_without_rows_goes(spark, tmp_path):
    kept, table = fed(spark, tmp_path)
    r.refresh(spark, table, kept, build)
    m.apply_changes(kept["names"], frame(spark, [("c", "x", 5, 1, "gone")]), "feed", 1)
    state = r.refresh(spark, table, kept, build)
    assert state.delta_rows == 0
    assert {x.k for x in r.shown(spark, table).collect()} == set("abdef")
    assert {x.k for x in r.shown(spark, table, state.number - 1).collect()} == set("abcdef")


def test_compacted_inputs_do_not_touch_keys_again(spark, tmp_path):
    kept, table = fed(spark, tmp_path)
    r.refresh(spark, table, kept, build)
    for name in kept:
        m.compact(spark, kept[name])
    state = r.refresh(spark, table, kept, build)
    assert state.deltas == [] and state.inputs == {n: m.read_commit(spark, t).number for n, t in kept.items()}
    same(spark, table, kept)


def test_added_columns_and_whole_builds(spark, tmp_path):
    kept, table = fed(spark, tmp_path)
    r.refresh(spark, table, kept, build)
    wider = frame(spark, [("a", "x", 5, 1, "q")]).withColumn("more", F.lit(1))
    m.apply_changes(kept["states"], wider, "feed", 1)

    def wide(names, states):
        return build(names, states).withColumn("size", F.length("v"))

    r.refresh(spark, table, kept, wide)
    sizes = {(x.k, x.size) for x in r.shown(spark, table).collect()}
    assert ("a", 1) in sizes and ("b", None) in sizes  # keys that were not touched
    r.refresh(spark, table, kept, wide, whole=True)
    assert {x.size for x in r.shown(spark, table).collect()} == {1}
    with pytest.raises(TypeError):
        m.apply_changes(kept["states"], frame(spark, [("a", "x", 6, 1, "q")]), "feed", 2)
        r.refresh(spark, table, kept, lambda n, s: wide(n, s).withColumn("size", F.lit("text")))


def test_plans_read_little(spark, tmp_path):
    kept, table = fed(spark, tmp_path)
    first = r.refresh(spark, table, kept, build)
    m.apply_changes(kept["states"], frame(spark, [("b", "x", 5, 1, "q")]), "feed", 1)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    # later commits only, and of their rows the later ones
    keys = m.changed_keys(spark, kept["states"], first.inputs["states"], ["k"])
    assert "GreaterThan(__commit," in plan(keys) and "base-" not in keys.inputFiles()[0]
    # other keys go before rows are brought together: below every window of the plan
    lines = plan(m.current(spark, kept["states"], only=keys)).splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*")) for x in lines]
    windows = [i for i, x in enumerate(lines) if x.lstrip(" :+-*").startswith("Window")]
    assert windows
    for i in windows:
        end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        assert any("LeftSemi" in x for x in lines[i:end])


def test_expired_states_go(spark, tmp_path):
    kept, table = fed(spark, tmp_path)
    for batch in range(1, 5):
        r.refresh(spark, table, kept, build)
        m.apply_changes(kept["states"], frame(spark, [("a", "x", batch, 1, "q")]), "feed", batch)
    r.compact(spark, table)
    r.refresh(spark, table, kept, build)
    assert r.expire(spark, table, keep=1)
    same(spark, table, kept)
    assert len(r.states(spark, table)) == 1


def test_errors(spark, tmp_path):
    kept = inputs(tmp_path)
    table = r.Rebuilt(str(tmp_path / "gold"), ["k"])
    with pytest.raises(LookupError):
        r.shown(spark, table)
    with pytest.raises(LookupError):
        r.refresh(spark, table, kept, build)
    kept, table = fed(spark, tmp_path / "other")
    r.refresh(spark, table, kept, build)
    with pytest.raises(ValueError):
        r.refresh(spark, table, {"states": kept["states"]}, build)
    with pytest.raises(ValueError):
        m.changed_keys(spark, kept["names"], 0, ["line"])
