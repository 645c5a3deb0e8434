"""Runs against all starts and periods, and digests of the query against plain Python."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.queries import op13_periodic_runs, planted_repeats
from strata.llm.runs import find_runs, periodic_runs, run_digests


def every_run(words, least, times):
    """All stretches of equal words at each distance, those of the least period kept."""
    best = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, times * q):
                best.setdefault((start, length), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4), st.sampled_from([(6, 4), (1, 2), (5, 3)]))
def test_runs_of_random_texts(texts, size):
    assert find_runs(texts, *size) == [every_run(t, *size) for t in texts]


@pytest.mark.parametrize("period", [1, 2, 3, 7, 20, 33])
def test_long_repeats_and_multiples_of_a_period(period):
    random.seed(period)
    words = [random.randrange(4) for _ in range(50)] + [f"w{i % period}" for i in range(300)] + [9]
    assert find_runs([words, words], 6, 4) == [every_run(words, 6, 4)] * 2


def test_one_word_many_times_is_one_run():
    assert find_runs([["a"] * 20_000], 6, 4) == [[(0, 20_000, 1)]]


def test_runs_and_collapsed_texts(spark, make_docs, bag):
    docs = make_docs([(1, "x a b a b a b a b  y"), (2, "a b a b a b")])
    got = bag(periodic_runs(docs), "doc_id", "n_words", "runs", "collapsed")
    assert got == [(1, 10, [(1, 8, 2)], bytearray(b"x a b y")), (2, 6, [], bytearray(b"a b a b a b"))]


def test_defined_results_for_odd_rows(odd, none, bag):
    empty = hashlib.sha256(b"").hexdigest()
    rows = bag(run_digests(odd), "doc_id", "n_runs", "start", "runs_sha256", "collapsed_sha256")
    assert len(rows) == 9
    by_id = {r[0]: r for r in rows}
    for n in (2, 3, 4):
        assert by_id[n] == (n, 0, None, empty, empty)
    assert by_id[5][1] == 1 and sum(r[0] == 1 for r in rows) == 2 and None in by_id
    assert run_digests(none).count() == 0


def written(doc_id, text):
    """What the contract of the query makes of the words of a text."""
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_planted_repeats(spark, odd, bag):
    docs = odd.unionByName(odd.withColumn("doc_id", odd["doc_id"] + 100))
    long = spark.range(60).selectExpr("id as doc_id", "repeat(concat('w', id, ' \t v', id % 3, '\n'), int(id)) as text")
    for df in (docs, long):
        want = [(i, written(i, t)) for i, t in df.select("doc_id", "text").collect() if i is not None]
        got = [(i, (t or "").encode().split()) for i, t in planted_repeats(df).collect() if i is not None]
        assert sorted(got) == sorted(want)
        assert planted_repeats(df).count() == df.count()


def test_query_against_brute_force(spark, data):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = {r.doc_id: r for r in op13_periodic_runs(spark, data).collect()}
    texts = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    found = 0
    for doc_id, text in texts:
        words = written(doc_id, text)
        runs = every_run(words, 6, 4) if len(words) < 1500 else find_runs([words], 6, 4)[0]
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        row = rows[doc_id]
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode())
        assert row.collapsed_sha256 == sha(b" ".join(w for i, w in enumerate(words) if i not in drop))
        if runs:
            s, n, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
            found += 1
        else:
            assert row.start is row.length is row.period is row.exponent_milli is None
    assert found > 5
