"""Alignment of the tokens of two tokenizers on the bytes they share.

Both tokenizers cut the same bytes; a group is what lies between two offsets where tokens of
both end. The end offsets of a text's tokens are two rising lists. As long as the text is cut
alike, the ends at a fixed index shift are equal: probes of doubling length compare whole
stretches of both lists at that shift, then halves find where it breaks. There a group is
resolved token by token, and the shift follows it.

A link joins the two tokens that end a group. How often each pair of ids is linked in all
documents is summed by pair from counts that each task has added up per document. The pairs
of the documents meet the sums in a join: the sums are broadcast while they are few, by their
count, and shuffled beyond it.

Words recur, so each worker keeps what it has found for the pieces it has met, and encodes and
aligns those it has not, all of a text together. A piece starts at a single space between two
characters other than white space: no token of either side reaches across.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Callable, Iterable
from operator import add, itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.rows import id_type, per_row, save_and_read
from strata.llm.tokens import check_model, processor

# fixed value: the words of byte-level tokenizers
BYTE_LEVEL_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: sums of more pairs than this are shuffled; below it they take less than 100 MB
FEW_PAIRS = 1 << 20
#: pieces that a worker keeps twice over, the recent and the ones before, and the longest of them
CACHED, CACHED_LENGTH = 250_000, 48
_IRREGULAR = re.compile(r"\s | \s| \Z")
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: characters whose classes do not depend on the version of Unicode
_PLAIN = re.compile("[\x00-\u024f]*")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def cut(text: str) -> list[str]:
    """Pieces of a text that starts with a space; joined they are the text."""
    if not _IRREGULAR.search(text):
        return [" " + p for p in text[1:].split(" ")]
    at = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
    return [text[i:j] for i, j in zip(at, at[1:])]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """A tokenizers file whose entries are written in the byte alphabet.

    Plain text is encoded by ranks, several times as fast, if the file's merges are in the
    order of their results and it cuts words by the byte-level pattern: then both mean the same.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.tokenizer.get_vocab().items()}
        self.entries = [
            bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
            for t in (names.get(i, "") for i in range(max(names, default=-1) + 1))
        ]
        self.by_ranks = self._ranks()

    def _ranks(self):
        import tiktoken

        file = json.loads(self.tokenizer.to_str())
        model, cutter = file["model"], file["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        ranks = [model["vocab"].get(x + y, -1) for x, y in merges]
        if (
            file["normalizer"] is not None
            or model["type"] != "BPE"
            or (cutter.get("type"), cutter.get("add_prefix_space"), cutter.get("use_regex")) != ("ByteLevel", False, True)
            or ranks != sorted(set(ranks))
        ):
            return None
        special = {t["id"] for t in file["added_tokens"]}
        known = {e: i for i, e in enumerate(self.entries) if i not in special}
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=known, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.by_ranks and _PLAIN.fullmatch(text):
            return self.by_ranks.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """A sentencepiece model; it puts the leading space there by itself."""

    def __init__(self, path: str) -> None:
        self.model = processor(path)
        check_model(self.model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.entries = [
            bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(t)) else t.replace("▁", " ").encode() for t in names
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text[1:])


def segments(ends_a: list[int], ends_b: list[int]) -> Iterable[tuple[int, int, int, int, bool]]:
    """(i, i2, j, j2, straight): tokens i to i2 of A and j to j2 of B, in order.

    A straight segment holds groups of one token each; any other is a single group. Both
    lists rise strictly and end with the same offset.
    """
    i = j = 0
    last = len(ends_a)
    while i < last:
        at, shift, step = i, j - i, 1
        if ends_a[i] == ends_b[j]:
            while (probe := ends_a[at : at + step]) and probe == ends_b[at + shift : at + shift + step]:
                at += len(probe)
                step *= 2
            while step > 1:
                step >>= 1
                if (probe := ends_a[at : at + step]) and probe == ends_b[at + shift : at + shift + step]:
                    at += len(probe)
        if at > i:
            yield i, at, j, at + shift, True
            i, j = at, at + shift
            if i == last:
                return
        x, y = i, j
        a, b = ends_a[x], ends_b[y]
        while a != b:
            if a < b:
                x += 1
                a = ends_a[x]
            else:
                y += 1
                b = ends_b[y]
        yield i, x + 1, j, y + 1, False
        i, j = x + 1, y + 1


#: a piece whose tokens have other bytes
DIFFERENT = (-1, -1, "", b"")
_OF_A, _OF_B, _GROUPS, _LINKS = map(itemgetter, range(4))


class Aligner:
    """Aligns one text at a time; keeps what it has found for recurring pieces."""

    def __init__(self, a: ByteLevel, b: Pieces) -> None:
        self.a, self.b = a, b
        self.width = len(b.entries)
        self.lengths = [np.array([len(e) for e in side.entries], np.int64) for side in (a, b)]
        self.text_a = [str(i) for i in range(len(a.entries))]
        self.text_b = [str(i) for i in range(self.width)]
        self.before_bar = [t + "|" for t in self.text_a]
        self.known: dict[str, tuple] = {}
        self.older = self.known

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both sides; None if either has other bytes than the text."""
        raw, ids = text.encode(), (self.a.encode(text), self.b.encode(text))
        same = all(raw == b"".join(map(s.entries.__getitem__, i)) for s, i in zip((self.a, self.b), ids))
        return ids if same else None

    def align(self, a: list[int], b: list[int]) -> tuple[list[str], np.ndarray, np.ndarray, list[np.ndarray]]:
        """Groups as text, their last offsets, their links as id_a * width + id_b, and the
        ends of both sides' tokens."""
        ids = [np.array(i, np.int64) for i in (a, b)]
        ends = [np.cumsum(n[i]) for n, i in zip(self.lengths, ids)]
        show_a = [self.before_bar[t] for t in a]
        show_b = [self.text_b[t] for t in b]
        groups: list[str] = []
        inner_a: list[int] = []
        inner_b: list[int] = []
        for i, i2, j, j2, straight in segments(ends[0].tolist(), ends[1].tolist()):
            if straight:
                groups += map(add, show_a[i:i2], show_b[j:j2])
            else:
                left = ",".join([self.text_a[t] for t in a[i:i2]])
                groups.append(left + "|" + ",".join(show_b[j:j2]))
                inner_a += range(i, i2 - 1)
                inner_b += range(j, j2 - 1)
        links = np.delete(ids[0], inner_a) * self.width + np.delete(ids[1], inner_b)
        return groups, np.delete(ends[0], inner_a), links, ends

    def learn(self, pieces: list[str]) -> dict[str, tuple]:
        """(tokens of A, of B, groups as text, links) of pieces; -1 tokens where bytes differ.

        Pieces that start with a space and have other characters than white space on both
        sides of it are encoded and aligned as one text, as their borders are cuts again.
        """
        out: dict[str, tuple] = {}
        joined = [p for p in pieces if len(p) > 1 and not p[1].isspace() and not p[-1].isspace()]
        plain = [p for p in joined if _PLAIN.fullmatch(p)]
        for part in (plain, [p for p in joined if not _PLAIN.fullmatch(p)] if len(plain) < len(joined) else []):
            if ids := part and self.encode("".join(part)):
                self.split(part, ids, out)
        for p in pieces:
            if p not in out:
                if ids := self.encode(p):
                    self.split([p], ids, out)
                else:
                    out[p] = DIFFERENT
        self.keep(out)
        return out

    def keep(self, found: dict[str, tuple]) -> None:
        self.known.update((p, f) for p, f in found.items() if len(p) <= CACHED_LENGTH)
        if len(self.known) >= CACHED:
            self.older, self.known = self.known, {}

    def split(self, pieces: list[str], ids: tuple[list[int], list[int]], out: dict) -> None:
        """Aligns the ids of joined pieces and hands each piece its part."""
        groups, last, links, ends = self.align(*ids)
        borders = np.cumsum([len(p.encode()) for p in pieces])
        at = [np.searchsorted(e, borders) + 1 for e in (*ends, last)]
        n_a, n_b = (np.diff(x, prepend=0).tolist() for x in at[:2])
        cuts = [0, *at[2].tolist()]
        raw = links.tobytes()
        for k, p in enumerate(pieces):
            low, high = cuts[k], cuts[k + 1]
            out[p] = n_a[k], n_b[k], ";".join(groups[low:high]), raw[8 * low : 8 * high]

    def text(self, text: str) -> tuple[int, int, str, np.ndarray]:
        """Tokens of A, of B, groups as text, and links of the text after a space."""
        nothing = 0, 0, "", np.empty(0, np.int64)
        if not text:
            return nothing
        pieces = cut(" " + text)
        found = list(map(self.known.get, pieces))
        if unknown := [k for k, f in enumerate(found) if f is None]:
            missing = {pieces[k]: self.older.get(pieces[k]) for k in unknown}
            if again := {p: f for p, f in missing.items() if f}:
                self.keep(again)
            if len(again) < len(missing):
                missing |= self.learn([p for p, f in missing.items() if not f])
            for k in unknown:
                found[k] = missing[pieces[k]]
        if DIFFERENT in found:
            # the text as a whole decides
            ids = self.encode(" " + text)
            if not ids:
                return nothing
            groups, _, links, _ = self.align(*ids)
            return len(ids[0]), len(ids[1]), ";".join(groups), links
        links = np.frombuffer(b"".join(map(_LINKS, found)), np.int64)
        return sum(map(_OF_A, found)), sum(map(_OF_B, found)), ";".join(map(_GROUPS, found)), links


@functools.lru_cache(maxsize=1)
def _aligner(model_a: str, model_b: str) -> Aligner:
    """One for all tasks of a worker, with the pieces it has met."""
    return Aligner(ByteLevel(model_a), Pieces(model_b))


def aligned(docs: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, and the distinct linked pairs of a document.

    ``pairs`` are id_a * (number of ids of B) + id_b, ``times`` how often each is linked in
    the document. Entries are never empty, so a group has one link.
    """
    schema = (
        f"doc_id {id_type(docs)}, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "pairs array<long>, times array<long>"
    )
    return _aligned(docs, model_a, model_b, schema, lambda groups: groups)


def _aligned(docs: DataFrame, model_a: str, model_b: str, schema: str, show: Callable[[str], str]) -> DataFrame:
    def make() -> Callable[[tuple], Iterable[tuple]]:
        aligner = _aligner(model_a, model_b)

        def one(row: tuple) -> Iterable[tuple]:
            n_a, n_b, groups, links = aligner.text((row[1] or b"").decode())
            pairs, times = np.unique(links, return_counts=True)
            yield row[0], n_a, n_b, len(links), len(links), show(groups), pairs.tolist(), times.tolist()

        return one

    return per_row(docs.select("doc_id", "text"), ["doc_id", "text"], schema, make)


def link_counts(found: DataFrame, width: int) -> DataFrame:
    """pair, total, best: links of each pair in all rows, and whether no pair of its B id has more."""
    pairs = found.selectExpr("inline(arrays_zip(pairs, times))")
    totals = save_and_read(pairs.groupBy("pairs").agg(F.sum("times").alias("total")), "totals")
    totals = totals.select(F.col("pairs").alias("pair"), "total", (F.col("pairs") % width).alias("id_b"))
    most = totals.groupBy("id_b").agg(F.max("total").alias("most"))
    return totals.join(most, "id_b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def alignment_digests(docs: DataFrame, model_a: str, model_b: str, few: int = FEW_PAIRS) -> DataFrame:
    """One row for each row of ``docs``: tokens, groups, links, and how common its links are.

    ``model_a`` is a byte-level tokenizers file, ``model_b`` a sentencepiece model. A null or
    empty text, or one whose tokens do not have its bytes, has no tokens: zeros and an empty
    ``groups_sha256``. Repeated rows and doc_ids, null ones too, are rows of their own, and
    the links of each count. An empty table gives no rows; other columns are not used.
    """
    schema = (
        f"doc_id {id_type(docs)}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<long>"
    )

    def digest(groups: str) -> str:
        return hashlib.sha256(groups.encode()).hexdigest() if groups else ""

    found = _aligned(docs, model_a, model_b, schema, digest)
    found = save_and_read(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = save_and_read(link_counts(found, len(Pieces(model_b).entries)), "links")
    if counts.count() <= few:
        counts = F.broadcast(counts)
    shown = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    links = found.selectExpr(*shown, "inline_outer(arrays_zip(pairs, times)) as (linked, times)")
    # the pairs of a document leave its task as one row
    joined = links.join(counts, F.col("linked") == F.col("pair"), "left")
    sums = joined.groupBy(*shown).agg(
        F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), F.lit(0)).alias("n_best"),
        F.coalesce(F.sum(F.col("times") * F.col("total")), F.lit(0)).alias("count_sum"),
    )
    return sums.drop("row").select(*shown[1:6], "n_best", "count_sum", "groups_sha256")
