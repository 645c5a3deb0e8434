import random

import numpy as np
import pytest

import strata.llm.jaccard as J
from strata.llm.components import components
from strata.llm.jaccard import Bands, one_of_each, shingles, similarity_components


def brute(rows, size, percent):
    """component by doc_id, from all pairs."""
    sets = [(i, set(shingles(None if t is None else t.encode(), size).tolist())) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if i == j or a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in root}


def variants(draw, groups, copies, most):
    rows = []
    for _ in range(groups):
        words = [f"w{draw.randint(0, 400)}" for _ in range(draw.randint(1, most))]
        for _ in range(draw.randint(1, copies)):
            changed = list(words)
            for _ in range(draw.randint(0, max(1, len(words) // 25))):
                at = draw.randrange(len(changed))
                changed[at : at + draw.randint(0, 1)] = [f"v{draw.randint(0, 400)}"] * draw.randint(0, 2)
            rows.append((len(rows), " ".join(changed)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, percent, most", [(4, 85, 150), (5, 80, 60), (4, 85, 12)])
def test_random_documents_against_all_pairs(make_docs, monkeypatch, size, percent, most):
    monkeypatch.setattr(J, "BUCKET", 200)
    rows = variants(random.Random(most), 60, 8, most)
    found = {r.doc_id: r.component_id for r in similarity_components(make_docs(rows), size, percent).collect()}
    assert found == brute(rows, size, percent)


def test_similar_sets_share_a_signature():
    draw = np.random.default_rng(3)
    for percent in (80, 85, 95):
        for _ in range(400):
            n = int(draw.integers(1, 120))
            a = draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            # as different as the threshold allows
            drop = int(draw.integers(0, n * (100 - percent) // 100 + 1))
            add = max(0, ((n - drop) * 100 // percent) - n)
            b = np.concatenate([a[drop:], draw.integers(0, 1 << 63, add, dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            if J.similar(a, b, percent):
                one, two = Bands(percent).signatures(a), Bands(percent).signatures(b)
                assert len(np.intersect1d(one, two)), (percent, n, drop, add)


def test_documents_of_the_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = {r.doc_id: r.component_id for r in similarity_components(docs, 4, 85).collect()}
    assert found == brute(rows, 4, 85)


def test_odd_rows(odd, none, make_docs):
    found = similarity_components(odd, 4, 85).collect()
    assert len(found) == 9
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id in (1, 2, 3, 4, 6)} == {
        (1, 11, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (6, 1, 6)}
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    assert similarity_components(none).count() == 0
    assert similarity_components(make_docs([(1, None), (2, "")])).count() == 2
    # rows of one doc_id are one document
    same = make_docs([(1, "a b c d e f"), (2, "a b c d e f"), (2, "k l m n o p"), (3, "K l m n o P")])
    assert {r.doc_id: r.component_id for r in similarity_components(same).collect()} == {1: 1, 2: 1, 3: 1}


def test_one_of_each_stays(odd, make_docs):
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "7", "None"]
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (1, text + " end"), (2, "other " + text), (4, "something else here now then again")]
    assert sorted(r.doc_id for r in one_of_each(make_docs(rows)).collect()) == [1, 4]


def test_components(spark):
    draw = random.Random(12)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)]
    links += [(1000, i) for i in range(1001, 1400)] + [(i, i + 1) for i in range(2000, 2060)] + [(None, 5), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
