import random

import public_tokenizers
import pytest

from strata.llm.tokens import Counting, check_model, frequent_lengths, processor, split_pieces, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library():
    sp, count = processor(MODEL), Counting(MODEL, {"the": 1, "": 1}, cache=50)
    check_model(sp)
    draw = random.Random(4)
    parts = [*" \n\t ab<s>ñéß", "  ", "日本", "▁", "　", "\x00", "</s>", "the", "ing", "ﬁ", "​", "🙂", "<0x0A>"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert count(text) == len(sp.encode(text)), text


def test_pieces_join_to_the_text():
    for text in ("a b", " a  b ", "", "  "):
        assert " ".join(["", *split_pieces(text)])[1:] == text


def test_query_against_the_library(spark, odd, none):
    sp = processor(MODEL)
    found = token_counts(odd, MODEL, limit=20).collect()
    source = {(r.doc_id, r.text) for r in odd.collect()}
    want = sorted((d or 0, len((t or "").encode()), len(sp.encode(t or ""))) for d, t in source)
    assert sorted({(r.doc_id or 0, r.n_bytes, r.n_tokens) for r in found}) == want
    assert len(found) == 9 and all(r.over_limit == (r.n_tokens > 20) for r in found)
    assert token_counts(none, MODEL).count() == 0


def test_the_table_does_not_change_counts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    table = frequent_lengths(docs, MODEL, 50, 100)
    assert 0 < len(table) <= 100
    one = sorted(map(tuple, token_counts(docs, MODEL, entries=1, cache=10).collect()))
    assert one == sorted(map(tuple, token_counts(docs, MODEL).collect()))


def test_a_model_whose_tokens_cross_pieces_is_refused():
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    with pytest.raises(ValueError):
        check_model(Crossing())
