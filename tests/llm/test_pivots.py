"""Exact top-k against all pairs, on spread, clustered and repeated vectors."""

import random
from math import floor, inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F
from twin import connect, differences

from strata.llm import pivots
from strata.llm.queries import op11_pivot_top_products, scaled

SCHEMA = "vec_id long, embedding array<long>, label int, row string, block string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "row", "block", "rank") for i, v in rows], SCHEMA)


def all_pairs(rows, k, step):
    whole = [(i, v) for i, v in rows if i is not None and v is not None and None not in v]
    out = []
    for a, (i, v) in enumerate(whole):
        if i % step == 0:
            others = [(-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(whole) if a != b]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(others)[:k])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_bounds_hold_and_best_are_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-30, 30, (400, 8))
    most = float(np.sqrt((x * x).sum(axis=1).max()))
    lift = pivots.lifted(x, most)
    spots = pivots.fit_pivots(lift, 6)
    far = pivots.distances(lift, spots)
    q = x[:50].astype(float)
    d = pivots.distances(np.concatenate([q, np.zeros((50, 1))], axis=1), spots)
    for p in range(len(spots)):
        low, high = np.array([far[:, p].min()]), np.array([np.median(far[:, p])])
        inside = x[far[:, p] <= high[0]]
        upper = pivots.bounds(d[:, [p]], low, high, (q * q).sum(axis=1), most)
        assert (pivots.products(x[:50], inside) <= upper).all()


@pytest.mark.parametrize("ring, block, askers", [(512, 4096, 256), (4, 8, 8)])
def test_against_all_pairs(spark, monkeypatch, ring, block, askers):
    monkeypatch.setattr(pivots, "RING", ring)
    monkeypatch.setattr(pivots, "BLOCK", block)
    monkeypatch.setattr(pivots, "ASKERS", askers)
    rng = random.Random(ring)
    rows = [(i, [rng.randint(-9, 9) + 40 * (j == i % 5) for j in range(6)]) for i in range(240)]
    rows += [(1000 + i, [5, 5, 5, 0, 0, 0]) for i in range(80)]  # one vector many times
    got = found(pivots.top_products(frame(spark, rows), F.col("vec_id") % 8 == 0, k=7))
    assert got == all_pairs(rows, 7, 8)


def test_queries_travel_once_for_a_group_of_rings(spark, monkeypatch):
    """What a round's requests hold follows the number of groups, not that of the rings asked for."""
    seen, made = [], pivots._Index.requests

    def requests(self, askers, order, k):
        out = made(self, askers, order, k)
        lengths = [F.coalesce(F.length(c), F.lit(0)) for c, t in out.dtypes if t == "binary"]
        seen.append(out.agg(F.sum(sum(lengths, F.lit(0)))).first()[0] or 0)
        return out

    monkeypatch.setattr(pivots._Index, "requests", requests)
    monkeypatch.setattr(pivots, "RING", 1)
    monkeypatch.setattr(pivots, "BLOCK", 64)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.integers(-30, 30, (2000, 8)))]
    got = found(pivots.top_products(frame(spark, rows), F.col("vec_id") % 5 == 0, k=20))
    assert got == all_pairs(rows, 20, 5)
    # 32 groups, eight components and four numbers besides a bit for a ring of some 320
    assert max(seen) <= 400 * 32 * (8 * 8 + 4 * 8 + 8)


@pytest.mark.parametrize("most", [100, 30_000, 2**29])
def test_components_of_any_width(spark, monkeypatch, most):
    monkeypatch.setattr(pivots, "RING", 8)
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rng = np.random.default_rng(most)
    high = [int(m) for m in rng.choice([3, 100, most], 200)]
    rows = [(i, rng.integers(-h, h, rng.integers(0, 6)).tolist()) for i, h in enumerate(high)]
    got = found(pivots.top_products(frame(spark, rows), F.col("vec_id") % 4 == 0, k=5))
    assert got == all_pairs(rows, 5, 4)


def test_vectors_without_components(spark):
    rows = [(i, []) for i in range(6)]
    got = found(pivots.top_products(frame(spark, rows), F.col("vec_id") % 3 == 0, k=4))
    assert got == all_pairs(rows, 4, 3)


@pytest.mark.parametrize("held, tile", [(1 << 16, (1024, 1024)), (0, (3, 5))])
def test_answer_of_a_group(monkeypatch, held, tile):
    """Against all pairs of the rings asked for, with many equal scores, queries among the vectors and floors."""
    monkeypatch.setattr(pivots, "HELD", held)
    monkeypatch.setattr(pivots, "TILE", tile)
    rng, k, blocks = np.random.default_rng(9), 3, []
    for ring in (4, 4, 5, 7):
        ids = np.sort(rng.integers(0, 40, 30))
        blocks.append((ring, rng.permutation(30) + 100 * len(blocks), ids, rng.integers(-2, 2, (30, 4)).astype(np.int8)))
    names = np.concatenate([blocks[0][1][:10], np.arange(1000, 1010)])
    q = np.concatenate([blocks[0][3][:10], rng.integers(-2, 2, (10, 4)).astype(np.int8)])
    mask = rng.integers(0, 2, (20, 4)).astype(bool)
    floors, ties = np.full(20, pivots.LEAST), np.full(20, pivots.MOST)
    floors[::3], ties[::3] = 4, 20
    spots = np.arange(20) + 7
    columns = {"rows": names, "ids": ties, "m": q, "spots": spots, "floors": floors, "mask": np.packbits(mask, axis=1)}
    got = pivots.answer({c: v.tobytes() for c, v in columns.items()}, blocks, 4, 4, 8.0, k)
    got = [tuple(map(int, r)) for r in zip(*got)]
    for i in range(20):
        pairs = [
            (-int(q[i].astype(int) @ v.astype(int)), int(d), int(r))
            for ring, rows, ids, m in blocks if mask[i, ring - 4]
            for r, d, v in zip(rows, ids, m) if r != names[i]
        ]
        need = [p for p in sorted(pairs)[:k] if (p[0], p[1]) <= (-int(floors[i]), ties[i])]
        mine = [(-s, d, r) for at, s, d, r in got if at == i + 7]
        assert mine[: len(need)] == need and len(mine) <= k


def test_odd_rows(spark):
    rows = [(0, [1, 2]), (0, [1, 2]), (1, None), (2, [3, None]), (None, [9, 9]), (3, []), (4, [5]), (6, [-1, 0, 7])]
    got = found(pivots.top_products(frame(spark, rows), F.col("vec_id") % 2 == 0, k=20))
    assert got == all_pairs(rows, 20, 2)
    assert pivots.top_products(frame(spark, []), F.lit(True)).count() == 0
    assert pivots.top_products(frame(spark, [(1, [1])]), F.lit(True)).count() == 0
    assert pivots.top_products(frame(spark, [(1, [1]), (3, [2])]), F.col("vec_id") % 2 == 0).count() == 0


def test_large_numbers():
    big = np.array([[2**30, -(2**30)]])
    assert pivots.products(big, big).tolist() == [[2**61]]
    with pytest.raises(OverflowError):
        pivots.products(big * 4, big * 4)


def test_scaled_components(spark):
    rows = [(1, [0.5, -0.01]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [None, 1.0]), (6, [])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")
    want = {1: [32, floor(64 * -0.01)], 2: None, 3: None, 4: None, 5: None, 6: []}
    assert {r.vec_id: r.embedding for r in scaled(df).collect()} == want


def test_query_equals_twin(spark, data):
    assert differences(op11_pivot_top_products(spark, data), connect(data), pivots.SQL) == []
