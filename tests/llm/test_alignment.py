"""Token alignment against whole-text encoding and plain sets of end offsets."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402

from strata.llm.alignment import Aligner, ByteLevel, Pieces, aligned, alignment_digests, cut, segments  # noqa: E402
from strata.llm.queries import op12_diagonal_token_alignment  # noqa: E402

MODELS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "\t", "a", "the", "word", "’s", "'s", "'ll", "9", "12", "é", "🙂", "\xa0", "　", "<s>",
         "<|endoftext|>", "▁", ".", "!", "\x1c", "ñandú", "日本"]


@pytest.fixture(scope="module")
def aligner():
    return Aligner(ByteLevel(MODELS[0]), Pieces(MODELS[1]))


def shown(aligner, text):
    *numbers, links = aligner.text(text)
    return *numbers, links.tolist()


def whole(aligner, text):
    """Tokens, groups and links of the whole text, by the sets of common ends."""
    if not text:
        return 0, 0, "", []
    a = aligner.a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.model.encode(text)
    raw_a, raw_b = [aligner.a.entries[i] for i in a], [aligner.b.entries[i] for i in b]
    if not (" " + text).encode() == b"".join(raw_a) == b"".join(raw_b):
        return 0, 0, "", []
    ends_a, ends_b = list(accumulate(map(len, raw_a))), list(accumulate(map(len, raw_b)))
    at_a, at_b = {e: i + 1 for i, e in enumerate(ends_a)}, {e: j + 1 for j, e in enumerate(ends_b)}
    groups, links, i, j = [], [], 0, 0
    for end in sorted(at_a.keys() & at_b.keys()):
        x, y = at_a[end], at_b[end]
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        links.append(a[x - 1] * len(aligner.b.entries) + b[y - 1])
        i, j = x, y
    return len(a), len(b), ";".join(groups), links


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=30), st.lists(st.integers(1, 4), max_size=30))
def test_segments_of_random_ends(a, b):
    total = sum(a) + sum(b) + 1
    ends = [list(accumulate([*x, total - sum(x)])) for x in (a, b)]
    common = sorted(set(ends[0]) & set(ends[1]))
    got = []
    i = j = 0
    for x, x2, y, y2, straight in segments(*ends):
        assert (x, y) == (i, j)
        i, j = x2, y2
        got += ends[0][x:x2] if straight else [ends[0][x2 - 1]]
        assert not straight or ends[0][x:x2] == ends[1][y:y2]
    assert got == common and (i, j) == (len(ends[0]), len(ends[1]))


def test_texts_against_whole_encoding(aligner):
    random.seed(4)
    texts = ["".join(random.choices(PARTS, k=random.randint(0, 30))) for _ in range(800)]
    texts += ["word " * 3000, "x" * 5000, " lead", "trail ", "a  b   c", "\n", "one\r\ntwo  three"]
    for text in texts * 2:  # the second time from what is known
        assert "".join(cut(" " + text)) == " " + text
        assert shown(aligner, text) == whole(aligner, text), text


def test_ranks_are_used_and_equal_the_library(spark, data, aligner):
    assert aligner.a.by_ranks
    texts = [r[0] for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    for text in texts:
        assert aligner.a.encode(" " + text) == aligner.a.tokenizer.encode(" " + text, add_special_tokens=False).ids


def test_small_cache_gives_the_same(aligner, monkeypatch):
    monkeypatch.setattr("strata.llm.alignment.CACHED", 3)
    random.seed(5)
    for _ in range(100):
        text = " ".join(random.choices(["the", "house", "of", "ñandú", "is", "big", "qwrtz"], k=12))
        assert shown(aligner, text) == whole(aligner, text)


def expected(aligner, rows):
    """doc_id and all columns, by brute force over all rows."""
    found = [(doc_id, *whole(aligner, text)) for doc_id, text in rows]
    counts = Counter(link for *_, links in found for link in links)
    most = Counter()
    for link, n in counts.items():
        most[link % 32000] = max(most[link % 32000], n)
    return sorted((
        (doc_id, n_a, n_b, len(links), len(links), sum(counts[x] == most[x % 32000] for x in links),
         sum(counts[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for doc_id, n_a, n_b, g, links in found), key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_odd_rows_by_either_join(odd, none, bag, aligner, few):
    got = bag(alignment_digests(odd, *MODELS, few=few), *COLUMNS)
    assert got == expected(aligner, [tuple(r) for r in odd.select("doc_id", "text").collect()])
    zeros = [r for r in got if r[0] in (2, 3)]
    assert [r[1:] for r in zeros] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert alignment_digests(none, *MODELS, few=few).count() == 0


def test_groups_themselves(make_docs, bag, aligner):
    docs = make_docs([(1, "the house"), (2, None)])
    rows = bag(aligned(docs, *MODELS), "doc_id", "n_groups", "groups", "pairs", "times")
    n_a, n_b, groups, links = whole(aligner, "the house")
    assert rows == [(1, len(links), groups, sorted(links), [1] * len(links)), (2, 0, "", [], [])]


def test_query_against_brute_force(spark, data, bag, aligner):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = bag(op12_diagonal_token_alignment(spark, data), *COLUMNS)
    assert got == expected(aligner, [tuple(r) for r in rows])
