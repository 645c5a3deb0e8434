import hashlib
import random
from collections import Counter

import pytest

import strata.llm.substring as S
from strata.llm.substring import Automaton, deduplicated, spans


def brute(rows, span=35):
    listed = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[s : s + span]) for _, w in listed for s in range(len(w) - span + 1))
    out = []
    for i, w in listed:
        gone = set()
        for s in range(len(w) - span + 1):
            if seen[tuple(w[s : s + span])] > 1:
                gone.update(range(s, s + span))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_automaton_counts_places():
    draw = random.Random(13)
    for _ in range(100):
        texts = [[draw.choice("abc") for _ in range(draw.randint(0, 12))] for _ in range(4)]
        places = [draw.randint(1, 3) for _ in texts]
        machine = Automaton()
        for t, n in zip(texts, places):
            machine.add(t, n)
        machine.finish()
        for span in (1, 2, 4):
            seen = Counter()
            for t, n in zip(texts, places):
                for s in range(len(t) - span + 1):
                    seen[tuple(t[s : s + span])] += n
            query = [draw.choice("abcd") for _ in range(20)]
            want = [s + span for s in range(20 - span + 1) if seen[tuple(query[s : s + span])] >= 2]
            assert list(machine.ends(query, span, 2)) == want


def test_spans_join():
    assert spans([5, 6, 12, 15], 4) == [(1, 6), (8, 15)]
    assert spans([], 4) == []


@pytest.mark.parametrize("hot", [2000, 2])
def test_random_documents_against_brute_force(make_docs, monkeypatch, hot):
    monkeypatch.setattr(S, "BUCKET", 50)
    monkeypatch.setattr(S, "SHARD", 20)
    draw = random.Random(14)
    passages = [[f"p{draw.randint(0, 30)}" for _ in range(draw.randint(5, 60))] for _ in range(8)]
    rows = []
    for i in range(120):
        words = [f"w{draw.randint(0, 5000)}" for _ in range(draw.randint(0, 80))]
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(words))
            words[at:at] = draw.choice(passages)
        rows.append((i, " ".join(words)))
    rows += [rows[5], (500, rows[7][1]), (501, " ".join(["same"] * 90)), (502, " ".join(["a", "b"] * 30))]
    found = deduplicated(make_docs(rows), 35, hot=hot)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    short = deduplicated(make_docs(rows), 12, k=4, hot=hot)
    assert sorted(map(tuple, short.collect()), key=str) == brute(rows, 12)


def test_documents_of_the_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, deduplicated(docs).collect()), key=str) == brute(rows)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, deduplicated(odd).collect()), key=str) == brute(rows)
    assert deduplicated(none).count() == 0
