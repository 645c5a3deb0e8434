"""Byte-pair encoding as a streaming transducer with bounded lookahead, and the way back.

The encoding of a prefix is given by its last token: of all tokens that end there, exactly
one is compatible with the encoding before it, that is, the merges keep the border between
the two. So one token for each position is all the state there is. A token that ends within
``lookahead`` bytes (the longest token the merge list can build) of the read position may
still change; a border is stable, and the tokens before it are emitted, once the encodings
of all prefixes that end within the lookahead agree on it. What a word needs in memory is
the stretch since its last stable border, whatever its length.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import regex
from pyspark.sql import DataFrame

from strata.llm.rows import id_type, per_row

END = "</w>"
#: these texts are their own normal form, and both regex libraries read them alike
_PLAIN = re.compile("[!-~¡-ſ]*")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merges:
    """The merge list, with what is derived from it."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = END) -> None:
        self.ids, self.end = vocab, end
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        built = {a + b for a, b in self.rank}
        self.lookahead = max([1, *(len(t.removesuffix(end)) for t in built)])
        self._whole: dict[str, bool] = {}
        self._border: dict[tuple[str, str], bool] = {}

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merge(self, parts: list[str]) -> list[str]:
        """The encoding by its definition: the earliest merge first, leftmost first."""
        parts, rank, none = list(parts), self.rank.get, len(self.rank)
        ranks = [rank(p, none) for p in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != none:
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), none)
        return parts

    def reachable(self, token: str) -> bool:
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = token in self.ids and self.merge(self.symbols(token)) == [token]
        return known

    def compatible(self, left: str, right: str) -> bool:
        known = self._border.get((left, right))
        if known is None:
            if len(self._border) > 1_000_000:
                self._border.clear()
            known = self.merge(list(left) + self.symbols(right)) == [left, right]
            self._border[left, right] = known
        return known


class Transducer:
    """Encodes one word, given piece by piece; yields tokens as they become stable.

    A word that ends within the lookahead is merged at once: nothing in it could be stable.
    """

    def __init__(self, merges: Merges) -> None:
        self.m = merges
        self.short = True
        self.text = ""  # since the last stable border
        self.last: list[str] = []  # of each prefix of it
        self.before: str | None = None  # the token emitted last

    def _final(self, stop: int, text: str, mark: str) -> str:
        """The one last token of the encoding of text[:stop], which ``mark`` ends."""
        m = self.m
        for size in range(min(stop, m.lookahead), 0, -1):
            token = text[stop - size : stop] + mark
            if m.reachable(token):
                left = self.last[stop - size - 1] if stop > size else self.before
                if left is None or m.compatible(left, token):
                    return token
        raise ValueError(f"no token for {text[stop - 1]!r}")

    def _path(self, at: int) -> list[str]:
        """Tokens that lead to position ``at``, last first."""
        out = []
        while at:
            out.append(self.last[at - 1])
            at -= len(out[-1])
        return out

    def feed(self, piece: str) -> Iterator[str]:
        if self.short:
            if len(self.text) + len(piece) <= self.m.lookahead:
                self.text += piece
                return
            piece, self.text, self.short = self.text + piece, "", False
        for char in piece:
            self.text += char
            self.last.append(self._final(len(self.text), self.text, ""))
            if len(self.text) >= 4 * self.m.lookahead and len(self.text) % self.m.lookahead == 0:
                yield from self._settle()

    def _settle(self) -> Iterator[str]:
        live = set(range(max(0, len(self.text) - self.m.lookahead), len(self.text) + 1))
        while len(live) > 1:
            furthest = max(live)
            live.remove(furthest)
            live.add(furthest - len(self.last[furthest - 1]))
        border = live.pop()
        if border:
            tokens = self._path(border)[::-1]
            yield from tokens
            self.before, self.text, self.last = tokens[-1], self.text[border:], self.last[border:]

    def finish(self) -> Iterator[str]:
        """The rest of the word, its last token with the end mark."""
        if self.short and self.text:
            yield from self.m.merge(self.m.symbols(self.text + self.m.end))
        elif self.text:
            token = self._final(len(self.text), self.text, self.m.end)
            yield from self._path(len(self.text) - len(token) + len(self.m.end))[::-1]
            yield token


class Decoder:
    """Tokens to text, a token at a time: bytes wait until they make a whole character."""

    def __init__(self, end: str = END) -> None:
        import codecs

        self.byte = {c: b for b, c in byte_alphabet().items()}
        self.end, self.utf8 = end, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: str) -> str:
        closes = token.endswith(self.end)
        body = bytes(self.byte[c] for c in (token[: -len(self.end)] if closes else token))
        return self.utf8.decode(body) + " " * closes

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


class Encoder:
    """Texts to tokens as the file of the ``tokenizers`` library at ``path`` says.

    Normal form and word borders are taken from the file, the merging is the transducer's.
    Words between spaces are remembered, at most ``cache`` at a time.
    """

    def __init__(self, path: str, cache: int = 300_000) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or spec["decoder"]:
            raise ValueError("a BPE file with word ends and without a decoder is needed")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.library = Tokenizer.from_file(path)
        self.merges = Merges(model["vocab"], model["merges"])
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.alphabet = byte_alphabet()
        self.units: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.words: dict[str, tuple[int, bytes, bytes]] = {}
        self.cache = cache

    def _tokens(self, word: str) -> Iterator[str]:
        """Of one word in the byte alphabet."""
        run = Transducer(self.merges)
        yield from run.feed(word)
        yield from run.finish()

    def _word(self, word: str) -> tuple[int, bytes, bytes]:
        """The chunk of one word, remembered."""
        found = self.words.get(word)
        if found is None:
            ids = self.merges.ids
            found = self._joined([(ids[t], t) for t in self._tokens(word)])
            if len(self.words) >= self.cache:
                self.words.clear()
            self.words[word] = found
        return found

    def _unit(self, unit: str) -> tuple[int, bytes, bytes]:
        """The chunk of all that stands between two spaces."""
        if self.marks.search(unit) or not _PLAIN.fullmatch(unit):
            return self._joined([*self.tokens(unit)])
        found = [self._word(w) for w in self.words_of(unit)]
        if len(found) == 1:
            return found[0]
        counts, ids, tokens = zip(*found)
        return sum(counts), b" ".join(ids), b" ".join(tokens)

    def words_of(self, part: str) -> Iterable[str]:
        """The words of a part without white space, in the byte alphabet."""
        if _PLAIN.fullmatch(part):
            found = self.pattern.findall(part.lower())
            if part.isascii():
                return found
            return ["".join(map(self.alphabet.__getitem__, w.encode())) for w in found]
        normal = self.library.normalizer.normalize_str(part)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def tokens(self, unit: str) -> Iterator[tuple[int, str]]:
        """Id and token of all that stands between two spaces."""
        for part in self.marks.split(unit):
            if part in self.special:
                yield self.special[part], part
            elif part:
                for word in self.words_of(part):
                    for token in self._tokens(word):
                        yield self.merges.ids[token], token

    def chunks(self, text: bytes) -> Iterator[tuple[int, bytes, bytes]]:
        """Number of tokens, their ids and the tokens, the latter two joined by spaces.

        A unit of more than 4,096 bytes comes in several chunks, all else in one chunk a unit.
        """
        units = self.units
        for unit in text.split():
            found = units.get(unit)
            if found is None:
                if len(unit) > 4096:
                    yield from self._long(unit.decode())
                    continue
                found = self._unit(unit.decode())
                if len(unit) <= 64:
                    if len(units) >= self.cache:
                        units.clear()
                    units[unit] = found
            if found[0]:
                yield found

    def _long(self, unit: str) -> Iterator[tuple[int, bytes, bytes]]:
        held: list[tuple[int, str]] = []
        for pair in self.tokens(unit):
            held.append(pair)
            if len(held) == 4096:
                yield self._joined(held)
                held = []
        if held:
            yield self._joined(held)

    @staticmethod
    def _joined(pairs: list[tuple[int, str]]) -> tuple[int, bytes, bytes]:
        return (
            len(pairs), b" ".join(b"%d" % i for i, _ in pairs),
            b" ".join(t.encode() for _, t in pairs),
        )


def digests(encoder: Encoder, text: bytes) -> tuple[int, str, str]:
    """Number of tokens, and the hashes of the ids and of the decoded text, a few chunks at a time."""
    ids, decoded, total = hashlib.sha256(), hashlib.sha256(), 0
    held: list[tuple[int, bytes, bytes]] = []

    def flush() -> None:
        nonlocal total
        for digest, at in ((ids, 1), (decoded, 2)):
            digest.update(b" " * bool(total) + b" ".join(c[at] for c in held))
        total += sum(c[0] for c in held)
        held.clear()

    for chunk in encoder.chunks(text):
        held.append(chunk)
        if len(held) >= 4096:
            flush()
    if held:
        flush()
    return total, ids.hexdigest(), decoded.hexdigest()


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs``.

    A null or empty text has no tokens, and the hashes of nothing. Repeated rows are encoded
    each; an empty table gives no rows; other columns are not used.
    """

    def make() -> Callable[[tuple], Iterable[tuple]]:
        encoder = Encoder(path)
        return lambda row: [(row[0], *digests(encoder, row[1] or b""))]

    return per_row(
        docs, ["doc_id", "text"],
        f"doc_id {id_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string", make,
    )


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` rows as doc_id, ids and tokens in arrays (a null text gives empty ones)."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        encoder = Encoder(path)

        def one(row: tuple) -> Iterable[tuple]:
            pairs = [p for unit in (row[1] or b"").decode().split() for p in encoder.tokens(unit)]
            yield row[0], [i for i, _ in pairs], [t for _, t in pairs]

        return one

    return per_row(
        docs, ["doc_id", text], f"doc_id {id_type(docs)}, ids array<int>, tokens array<string>", make
    )
