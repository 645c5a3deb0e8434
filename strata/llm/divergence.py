"""Quality by distribution: a document's histograms against those of its language.

Two histograms are taken of every text: classes of characters, and common function words.
The reference of a language is the sum over all its documents that pass the base rules.
The Jensen-Shannon distance (base 2, between 0 and 1) to the reference decides, where a
text is long enough for its histogram to mean something.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.rows import id_type, per_row, save_and_read

# fixed values: frequent function words
COMMON = {
    "en": "the of and to a in is that for it as was on with be by at this are or an from not have".split(),
    "fr": "le la les de des du un une et est en que qui dans pour pas au sur par plus avec ce il".split(),
    "de": "der die das und in zu den von mit ist des auf für im dem nicht ein eine als auch es an".split(),
    "es": "el la los las de y en que un una por con no para del se al lo su es como más".split(),
}
SYMBOLS = b"#*$%&|<>"
CLASSES = ["vowel", "consonant", "upper", "digit", "blank", "line", "stop", "symbol", "other", "beyond"]


def _class_table() -> np.ndarray:
    """The class of each byte; a character beyond ASCII counts by its first byte."""
    kind = np.full(256, CLASSES.index("other"), np.uint8)
    for name, chars in (
        ("consonant", bytes(range(97, 123))), ("vowel", b"aeiou"), ("upper", bytes(range(65, 91))),
        ("digit", b"0123456789"), ("blank", b" \t"), ("line", b"\n\r"), ("stop", b".,;:?'\"()-"),
        ("symbol", SYMBOLS),
    ):
        kind[list(chars)] = CLASSES.index(name)
    kind[0xC0:] = CLASSES.index("beyond")
    kind[0x80:0xC0] = len(CLASSES)
    return kind


_KIND = _class_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(97, 123), *range(0x80, 256)]] = False
_VOCABULARY = sorted({w for words in COMMON.values() for w in words})


def _lookup() -> tuple[np.ndarray, np.ndarray]:
    found = [W.hashes(d, *W.bounds(d))[0] for d in (W.as_bytes(w.encode()) for w in _VOCABULARY)]
    order = np.argsort(np.array(found, np.uint64))
    return np.array(found, np.uint64)[order], order


def features(text: bytes | None, window: int = 8) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the two histograms.

    The last bin of the word histogram holds all words that are not in the list.
    """
    data = W.as_bytes(text)
    starts, ends = W.bounds(data)
    kinds = np.bincount(_KIND[data], minlength=len(CLASSES) + 1)
    points = len(data) - int(kinds[-1])
    blank = int(W._SPACE[data].sum())
    hashes = W.hashes(data, starts, ends)
    grams = W.grams(hashes, window)
    repeated = 0
    if len(grams):
        order = np.sort(grams)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            repeated = int(W.covered(np.flatnonzero(np.isin(grams, twice)), window, len(hashes)).sum())
    lines = [x for x in (text or b"").split(b"\n") if x.strip()]
    lower = _LOWER[data]
    plain = W.hashes(lower, *W.bounds(lower, _NO_LETTER))
    table, order = _TABLE
    at = np.minimum(np.searchsorted(table, plain), len(table) - 1)
    bins = np.where(table[at] == plain, order[at], len(table))
    return (
        len(starts), points - blank, int(kinds[CLASSES.index("symbol")]), len(lines) - len(set(lines)),
        repeated, kinds[:-1].tolist(), np.bincount(bins, minlength=len(table) + 1).tolist(),
    )


_TABLE = _lookup()


def js_distance(left: Column, right: Column) -> Column:
    """Of two histograms of counts; null if either is empty."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    def term(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    a, b = F.nullif(total(left), F.lit(0.0)), F.nullif(total(right), F.lit(0.0))
    shares = F.zip_with(left, right, lambda p, q: F.struct((p / a).alias("p"), (q / b).alias("q")))
    parts = F.transform(shares, lambda s: (
        term(s.p, (s.p + s.q) / 2) + term(s.q, (s.p + s.q) / 2)) / 2)
    distance = F.sqrt(F.greatest(F.lit(0.0), total(parts)))
    return F.when(a.isNotNull() & b.isNotNull(), distance)


def _sums(histogram: str, size: int) -> Column:
    return F.array(*(F.sum(F.col(histogram)[i]).cast("double") for i in range(size)))


def quality(
    docs: DataFrame,
    max_class_distance: float = 0.21,
    max_word_distance: float = 0.4,
    min_chars: int = 200,
    min_words: int = 100,
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang).

    Base counts, ``base_failed``, the two distances and ``kept``. Texts under ``min_chars``
    characters or ``min_words`` words are not judged by the histogram concerned. A language
    without a word list shares the reference "other"; a null text has no words and fails
    the base rules. A distance is null where there is nothing to compare, and then does not
    count against the text. Repeated rows are each judged; an empty table gives no rows.
    """
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()

    def make() -> Callable[[tuple], Iterable[tuple]]:
        return lambda row: [(row[0], (row[2] or b"").decode(), *features(row[1]))]

    kind = F.when(F.col("lang").isin(*COMMON), F.col("lang")).otherwise("other")
    found = per_row(
        docs.select("doc_id", "text", kind.alias("kind")), ["doc_id", "text", "kind"],
        f"doc_id {id_type(docs)}, kind string, " + "".join(f"{n} long, " for n in names)
        + "classes array<double>, common array<double>", make,
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    found = save_and_read(found.withColumn("base_failed", failed), "quality")
    # at most one row for each listed language and one for the rest
    reference = found.where("not base_failed").groupBy("kind").agg(
        _sums("classes", len(CLASSES)).alias("ref_classes"),
        _sums("common", len(_VOCABULARY) + 1).alias("ref_common"),
    )
    judged = found.join(F.broadcast(reference), "kind", "left").select(
        "doc_id", *names, "base_failed", "classes",
        js_distance(F.col("classes"), F.col("ref_classes")).alias("class_distance"),
        js_distance(F.col("common"), F.col("ref_common")).alias("word_distance"),
    )
    chars = reduce(lambda a, b: a + b, (F.col("classes")[i] for i in range(len(CLASSES))))
    odd = F.coalesce((chars >= min_chars) & (F.col("class_distance") > max_class_distance), F.lit(False)) | (
        F.coalesce((F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance), F.lit(False))
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~odd).drop("classes")
