"""Periodic runs of words, by maximal pairs in the tree of LCP intervals.

The suffixes of a text are sorted by doubling prefixes; only those that share their first words
with another suffix of the same text take part in a further round. Neighbours in that order and
the length of their common prefix give the tree of LCP intervals, which is walked bottom up. A
node stands for a repeated stretch of L words and lists its places in order; each place knows
the class it belongs to, the word on its left.

Places i < j of one node, from different children and of different classes, are a maximal pair:
the stretches at i and j agree for L words and for no more on either side. With q = j - i and
L >= (e - 1) * q the words from i to j + L have period q, at least e times, and no neighbouring
word extends them: the pair is a run as it stands. A place between i and j would give the same
words a smaller period, so the two places of a run's least period are neighbours in the list of
their node. Pairs of a multiple of the period cover the same words, and the least one is kept.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.rows import arrow_schema, bound_batches, id_type, to_batch

#: words of the texts that are sorted together, unless a single text has more
WORDS = 1 << 16


def suffix_order(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose first words recur, in suffix order, and the common prefix with the place before.

    ``ids`` holds one number a word; no stretch with a number that occurs once recurs. Common
    prefixes are exact from ``least`` on; shorter ones may be given as 0.
    """
    n = len(ids)
    ranks = [_dense(ids)]
    active = _shared(ranks[0])
    step = 1
    while len(active):
        rank = ranks[-1]
        follows = np.full(len(active), -1, np.int64)
        inside = active + step < n
        follows[inside] = rank[active[inside] + step]
        key = rank[active] * (n + 1) + follows + 1
        order = np.argsort(key, kind="stable")
        places, key = active[order], key[order]
        head = rank[places]
        at = np.arange(len(places))
        new_group = np.concatenate([[True], head[1:] != head[:-1]])
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        group_at = np.maximum.accumulate(np.where(new_group, at, 0))
        key_at = np.maximum.accumulate(np.where(new_key, at, 0))
        finer = rank.copy()
        finer[places] = head + key_at - group_at
        ranks.append(finer)
        last = np.concatenate([new_key[1:], [True]])
        active = places[~(new_key & last)]
        step *= 2
    # those alone after as many words as the largest power of two up to ``least`` say nothing
    level = min(max(0, least.bit_length() - 1), len(ranks) - 1)
    chosen = _shared(ranks[level])
    order = chosen[np.argsort(ranks[-1][chosen], kind="stable")]
    return order, _common(order, ranks)


def _dense(ids: np.ndarray) -> np.ndarray:
    """Rank of each value: the number of smaller ones, repeated values counted."""
    order = np.argsort(ids, kind="stable")
    values = ids[order]
    at = np.arange(len(ids))
    first = np.maximum.accumulate(np.where(np.concatenate([[True], values[1:] != values[:-1]]), at, 0))
    rank = np.empty(len(ids), np.int64)
    rank[order] = first
    return rank


def _shared(rank: np.ndarray) -> np.ndarray:
    """Places whose rank another place has too."""
    return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)


def _common(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that each place shares with the one before it in ``order``; 0 for the first."""
    if not len(order):
        return np.empty(0, np.int64)
    n = len(ranks[0])
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        rank = ranks[level]
        equal = np.zeros(len(a), bool)
        equal[inside] = rank[a[inside]] == rank[b[inside]]
        grown = equal.astype(np.int64) << level
        shared += grown
        a += grown
        b += grown
    return np.concatenate([[0], shared])


class _Tree:
    """Bottom-up walk over the LCP intervals of one table of texts."""

    def __init__(self, words: list[int], times: int, least: int) -> None:
        self.words, self.times, self.least = words, times, least
        self.found: dict[tuple[int, int], int] = {}

    def walk(self, order: list[int], common: list[int]) -> dict[tuple[int, int], int]:
        """(first word, end) -> period of the runs; the first of a text follows its end mark."""
        shallow = max(1, self.least * (self.times - 1) // self.times)
        stack: list[tuple[int, list[int]]] = []
        node = order[:1]
        for place, depth in zip([*order[1:], 0], [*common[1:], 0]):
            if depth < shallow:
                depth = 0
            while stack and stack[-1][0] > depth:
                below, places = stack.pop()
                node = self.join(places, node, below)
            if stack and stack[-1][0] == depth:
                node = self.join(stack.pop()[1], node, depth)
            if depth:
                stack.append((depth, node))
            node = [place]
        return self.found

    def join(self, one: list[int], two: list[int], depth: int) -> list[int]:
        """Places of both children; maximal pairs between them are noted."""
        if len(one) < len(two):
            one, two = two, one
        limit = depth // (self.times - 1)
        for place in two:
            at = bisect_left(one, place)
            if at < len(one) and one[at] - place <= limit:
                self.pair(place, one[at], depth)
            if at and place - one[at - 1] <= limit:
                self.pair(one[at - 1], place, depth)
        if len(two) == 1:
            one.insert(bisect_left(one, two[0]), two[0])
        else:
            one.extend(two)
            one.sort()
        return one

    def pair(self, i: int, j: int, depth: int) -> None:
        if depth + j - i < self.least or self.words[i - 1] == self.words[j - 1]:
            return
        span = (i, j + depth)
        self.found[span] = min(j - i, self.found.get(span, j - i))


def find_runs(texts: list[list], least: int, times: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start, then period.

    A run has at least ``least`` words and ``times`` (2 or more) times its least period.
    """
    number: dict = defaultdict(count().__next__)
    marks = 0
    parts: list[int] = [-1]
    starts = []
    for text in texts:
        starts.append(len(parts))
        parts.extend([number[w] for w in text])
        marks -= 1
        parts.append(marks - 1)
    ids = np.array(parts, np.int64)
    # the same word of two texts is told apart
    text_of = np.cumsum(ids < 0)
    ids = np.where(ids < 0, ids, ids * (len(texts) + 2) + text_of)
    shallow = max(1, least * (times - 1) // times)
    order, common = suffix_order(ids, shallow)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(order):
        return out
    found = _Tree(parts, times, least).walk(order.tolist(), common.tolist())
    for (start, end), period in found.items():
        text = int(text_of[start]) - 1
        out[text].append((start - starts[text], end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def strongest(runs: list[tuple[int, int, int]]) -> tuple | None:
    """The run with the greatest length / period; of equal ones the first, then of least period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats, its first period stays."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """doc_id, runs (start, length, period), collapsed for every row of ``docs``.

    Words are stretches without ASCII white space. ``runs`` holds every run, by start, then
    period; ``collapsed`` the text without what runs repeat, words joined by one space. A null
    text, or one without words, has no runs and collapses to the empty text. Rows are taken one
    by one: repeated rows and doc_ids, null ones too, give a row each. An empty table gives no
    rows; other columns are not used.
    """
    kind = id_type(docs)
    result = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return _per_texts(docs, result, least, times, lambda words, runs: (
        len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], b" ".join(collapse(words, runs))
    ))


def run_digests(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """doc_id, n_runs, the strongest run, and digests of the runs and of the collapsed text.

    Rows, nulls and empty texts as in :func:`periodic_runs`. Without runs the columns of the
    strongest one are null.
    """

    def digest(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        best = strongest(runs)
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        kept = b" ".join(collapse(words, runs))
        return len(runs), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()

    result = (
        f"doc_id {id_type(docs)}, n_runs long, start long, length long, period long, "
        "exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    )
    return _per_texts(docs, result, least, times, digest)


def _per_texts(docs: DataFrame, result: str, least: int, times: int, show) -> DataFrame:
    if times < 2:
        raise ValueError("a run repeats its period at least twice")
    spark = docs.sparkSession
    bound_batches(spark)
    target = arrow_schema(spark, result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = [(t or b"").split() for t in batch.column(1).to_pylist()]
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size + len(texts[high]) <= WORDS):
                    size += len(texts[high])
                    high += 1
                part = texts[low:high]
                rows = zip(names[low:high], part, find_runs(part, least, times))
                yield to_batch([(name, *show(words, runs)) for name, words, runs in rows], target)
                low = high

    chosen = docs.selectExpr("doc_id", "cast(text as binary) as text")
    return chosen.mapInArrow(run, result)
