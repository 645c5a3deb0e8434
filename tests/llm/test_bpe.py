import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm.bpe import Decoder, Encoder, Merges, Transducer, byte_alphabet, digests, encode, encode_digests

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, cache=500)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)

    def run(text):
        ids = t.encode(text, add_special_tokens=False).ids
        joined, decoded = " ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False)
        return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (joined, decoded))

    return run


def test_equals_the_library(encoder, library):
    draw = random.Random(6)
    parts = [*" \n\tabtheingñéßÉ'sl12!|.", "日本", "▁", "　", "\x00", "<|endoftext|>", "<|startoftext|>", "ﬁ",
             "​", "🙂", "Σ", "İ", "é", "́", "\x1c", "\x85", "\xa0", "don't", "एक", "½"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert digests(encoder, text.encode()) == library(text), text


@pytest.mark.parametrize("letters", ["a", "ab", "aeiouth", "étu", "theingandstr"])
def test_long_words_stream(encoder, library, letters):
    draw = random.Random(7)
    for size in (33, 200, 6000):
        text = "".join(draw.choice(letters) for _ in range(size))
        assert digests(encoder, text.encode()) == library(text)


def test_memory_of_a_long_word_is_bounded(encoder):
    run, draw, most = Transducer(encoder.merges), random.Random(8), 0
    for _ in range(20_000):
        list(run.feed(draw.choice("abcdefgh")))
        most = max(most, len(run.text))
    assert most <= 8 * encoder.merges.lookahead


def test_streaming_equals_the_definition():
    merges = [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "a"), ("ba", "b</w>"), ("aba", "ab"), ("b", "b")]
    tokens = ["a", "b", "a</w>", "b</w>", *("".join(m) for m in merges)]
    m = Merges({t: i for i, t in enumerate(tokens)}, merges)
    draw = random.Random(9)
    for _ in range(500):
        word = "".join(draw.choice("ab") for _ in range(draw.randint(1, 90)))
        run, found = Transducer(m), []
        for char in word:
            found += run.feed(char)
        assert found + list(run.finish()) == m.merge(m.symbols(word + "</w>"))


def test_bytes_to_text(encoder):
    text = "naïve café 🙂 日本 ok"
    tokens = [t for unit in text.split() for _, t in encoder.tokens(unit)]
    decoder = Decoder()
    assert "".join(map(decoder.feed, tokens)) + decoder.finish() == text + " "
    assert len(set(byte_alphabet().values())) == 256


def test_query(spark, odd, none, library):
    found = encode_digests(odd, PATH).collect()
    want = sorted(str((r.doc_id, *library(r.text or ""))) for r in odd.collect())
    assert sorted(str(tuple(r)) for r in found) == want
    assert encode_digests(none, PATH).count() == 0
    rows = {r.doc_id: r for r in encode(odd, PATH).collect()}
    assert rows[6].tokens == ["one</w>"] and rows[2].ids == []
