"""Token counts: a broadcast table of frequent words before a tokenizer in each worker.

The model splits at white space and never joins a character to a following space mark, so
a text's count is the sum over its pieces, each a run of spaces with the characters after
it. A piece is looked up in a broadcast table, then in the worker's own cache, and only
then encoded. Pieces are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.rows import id_type, per_row

_PIECES = re.compile(" +[^ ]*")


def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def check_model(sp) -> None:
    """Counting by pieces is right only if no token has a space mark after another character,
    and text is taken as it is."""
    mark = "▁"
    for i in range(sp.get_piece_size()):
        if mark in sp.id_to_piece(i).lstrip(mark):
            raise ValueError(f"token {i} crosses a piece")
    if sp.encode("a  b", out_type=str) != sp.encode("a", out_type=str) + sp.encode(" b", out_type=str):
        raise ValueError("the model changes white space")


def split_pieces(text: str) -> list[str]:
    """Pieces without the space that the tokenizer itself puts before a text."""
    if "  " in text or text.startswith(" "):
        return [p[1:] for p in _PIECES.findall(" " + text)]
    return text.split(" ")


def frequent_lengths(docs: DataFrame, model: str, sample_rows: int, entries: int) -> dict[str, int]:
    """Token counts of the most frequent pieces in about ``sample_rows`` documents.

    The table only saves work: a piece that is not in it is counted all the same.
    """
    rows = docs.count()
    if not rows:
        return {}

    def make() -> Callable[[tuple], Iterable[tuple]]:
        def count(row: tuple) -> Iterable[tuple]:
            found = Counter(p for p in split_pieces((row[0] or b"").decode()) if 0 < len(p) <= 32)
            return found.items()

        return count

    chosen = docs.select("text").sample(min(1.0, sample_rows / rows), seed=7)
    top = (
        per_row(chosen, ["text"], "piece string, n long", make)
        .groupBy("piece").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece").limit(entries)
    )
    sp = processor(model)
    pieces = [r.piece for r in top.collect()]
    return dict(zip(pieces, map(len, sp.encode(pieces, num_threads=1)))) if pieces else {}


class Counting:
    """Counts the tokens of texts; remembers at most ``cache`` pieces at a time."""

    def __init__(self, model: str, table: dict[str, int], cache: int) -> None:
        self.sp, self.table, self.cache = processor(model), table, cache
        self.recent: dict[str, int] = {}
        self.stop = len(self.sp.encode("a"))

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace("▁", " ")  # the model does not tell the two apart
        spaces = len(text) - len(text.rstrip(" "))
        total = 0
        if spaces:
            # spaces at the end are counted behind a letter, with which they never join
            total = len(self.sp.encode("a" + " " * spaces)) - self.stop
            text = text[:-spaces]
            if not text:
                return len(self.sp.encode(" " * spaces))
        pieces = split_pieces(text)
        known = list(map(self.table.get, pieces))
        rare = [p for p, n in zip(pieces, known) if n is None]
        total += sum(filter(None, known))
        if rare:
            recent = self.recent
            known = list(map(recent.get, rare))
            total += sum(filter(None, known))
            misses = [p for p, n in zip(rare, known) if n is None]
            for piece, ids in zip(misses, self.sp.encode(misses, num_threads=1)):
                total += len(ids)
                if len(piece) <= 64:
                    recent[piece] = len(ids)
            if len(recent) > self.cache:
                recent.clear()
        return total


def token_counts(
    docs: DataFrame,
    model: str,
    limit: int = 4096,
    sample_rows: int = 2000,
    entries: int = 40_000,
    cache: int = 800_000,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``.

    A null or empty text has no bytes and no tokens; repeated rows are counted each; an
    empty table gives an empty result; other columns are left out. ``entries`` bounds the
    broadcast table, ``cache`` the worker's.
    """
    check_model(processor(model))
    table = docs.sparkSession.sparkContext.broadcast(
        frequent_lengths(docs, model, sample_rows, entries)
    )

    def make() -> Callable[[tuple], Iterable[tuple]]:
        count = Counting(model, table.value, cache)

        def one(row: tuple) -> Iterable[tuple]:
            data = row[1] or b""
            n = count(data.decode())
            yield row[0], len(data), n, n > limit

        return one

    return per_row(
        docs, ["doc_id", "text"],
        f"doc_id {id_type(docs)}, n_bytes long, n_tokens long, over_limit boolean", make,
    )
