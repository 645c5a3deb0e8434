"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

Subwords are the runs of one to four letters of a word, with its edges as a mark. Their
hashed embeddings are averaged over the whole text and go through one linear layer. The
model is trained by stochastic gradient descent in numpy on a bounded sample of labelled
documents, spread over the languages, and on gibberish made of some of them, which is a
class of its own. A part of the sample is held back to set the temperature of the softmax
and the evidence for gibberish above which a text is rejected. Evidence is the lead of the
gibberish class, which is a mean over subwords, times the root of their number: a short
text can lead by chance.
"""

from __future__ import annotations

import functools
import sys
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.rows import bound_batches, id_type, per_row
from strata.llm.words import mix

BITS, LONGEST = 14, 4
UNKNOWN = "und"
#: of so many sampled texts one is also turned into gibberish, the class of rejected texts
GIBBERISH = 4
#: code points at once, so that a very long text costs bounded memory
_STEP = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def subwords(text: str) -> np.ndarray:
    """How often each bucket occurs in the text; all zero if it has no letters."""
    counts = np.zeros(1 << BITS)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(points), _STEP):
        part = points[max(0, at - LONGEST + 1) : at + _STEP]
        fresh = min(at, LONGEST - 1)  # these were the end of the part before
        marked = np.where(_letters()[part], part, 0)
        marked = np.concatenate([[0] * (at == 0), marked, [0] * (at + _STEP >= len(points))])
        marked = marked.astype(np.uint64)
        hashed = np.zeros(len(marked), np.uint64)
        inner = np.ones(len(marked), bool)  # no edge strictly inside the run
        with np.errstate(over="ignore"):
            for n in range(1, LONGEST + 1):
                size = len(marked) - n + 1
                if size <= 0:
                    break
                last = marked[n - 1 :]
                hashed = hashed[:size] * np.uint64(0x100000001B3) + last + np.uint64(1)
                if n == 2:
                    good = (marked[:size] != 0) | (last != 0)
                elif n > 2:
                    inner = inner[:size] & (marked[n - 2 : n - 2 + size] != 0)
                    good = inner
                else:
                    good = last != 0
                first = max(0, fresh - n + 1) if at else 0
                keys = mix(hashed[first:][good[first:]] + np.uint64(n << 56)) >> np.uint64(64 - BITS)
                counts += np.bincount(keys.astype(np.int64), minlength=1 << BITS)
    return counts


def gibberish(text: str) -> str:
    """The text with every letter drawn anew, the rest as it is: from its own letters, all equally
    likely, or from up to 64 letters in a row of any script."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    letter = _letters()[points]
    rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    if letter.any():
        if rng.random() < 0.5:
            drawn = np.unique(points[letter])
        else:
            every = np.flatnonzero(_letters()).astype(np.uint32)
            drawn = every[rng.integers(len(every)) :][: rng.integers(16, 65)]
        points[letter] = rng.choice(drawn, int(letter.sum()))
    return points.tobytes().decode("utf-32-le", "surrogatepass")


@dataclass(frozen=True)
class Model:
    """``table`` holds, for each bucket, the embedding already taken through the softmax layer.
    Its last column is the class of gibberish."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_above: float

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score, rejected."""
        counts = subwords(text) if text else np.zeros(0)
        total = counts.sum()
        if not total or not self.languages:
            return UNKNOWN, 0.0, True
        used = np.flatnonzero(counts)
        logits = (counts[used] / total) @ self.table[used] + self.bias
        p = _softmax(logits[:-1] / self.temperature)
        best = int(np.argmax(p))
        rejected = bool((logits[-1] - logits[best]) * total**0.5 > self.reject_above)
        return self.languages[best], float(min(1.0, p[best])), rejected


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(
    rows: list[tuple[str | None, np.ndarray, np.ndarray, float]],
    size: int = 16,
    epochs: int = 6,
    rate: float = 2.0,
    held_back: int = 5,
    rejected_share: float = 0.001,
) -> Model:
    """``rows``: language (None: gibberish), buckets, their share of the text, number of subwords.

    One row in ``held_back`` calibrates. The limit of rejection is half the evidence that 95 %
    of the held-back gibberish exceeds, at least the one that ``rejected_share`` of the other
    held-back rows exceed, and never below zero.
    """
    languages = tuple(sorted({r[0] for r in rows if r[0] is not None}))
    if not languages:
        return Model((), np.zeros((1 << BITS, 1)), np.zeros(1), 1.0, 0.0)
    number = {x: i for i, x in enumerate([*languages, None])}
    rng = np.random.default_rng(7)
    order = rng.permutation(len(rows))
    real, noise = ([i for i in order if (rows[i][0] is None) == x] for x in (False, True))
    held, wild = real[::held_back], noise[::held_back]
    used = [i for some in (real, noise) for k, i in enumerate(some) if k % held_back]
    embed = rng.normal(0, 0.1, (1 << BITS, size))
    layer, bias = rng.normal(0, 0.1, (size, len(number))), np.zeros(len(number))
    steps = max(1, epochs * len(used))
    for step, i in enumerate(rng.permutation(used) for _ in range(epochs)):
        for k, j in enumerate(i):
            language, buckets, share, _ = rows[j]
            eta = rate * (1 - (step * len(used) + k) / steps)
            hidden = share @ embed[buckets]
            wrong = _softmax(hidden @ layer + bias)
            wrong[number[language]] -= 1
            back = layer @ wrong
            layer -= eta * np.outer(hidden, wrong)
            bias -= 0.1 * eta * wrong
            embed[buckets] -= eta * np.outer(share, back)
    table = embed @ layer

    def outputs(of: list[int]) -> np.ndarray:
        return np.array([rows[i][2] @ table[rows[i][1]] + bias for i in of])

    def evidence(of: list[int], logits: np.ndarray) -> np.ndarray:
        return (logits[:, -1] - logits[:, :-1].max(axis=1)) * np.sqrt([rows[i][3] for i in of])

    logits = outputs(held)
    truth = np.array([number[rows[i][0]] for i in held])

    def loss(t: float) -> float:
        return -np.log(_softmax(logits[:, :-1] / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    reject = max(0.0, float(np.quantile(evidence(held, logits), 1 - rejected_share)))
    if wild:
        reject = max(reject, 0.5 * float(np.quantile(evidence(wild, outputs(wild)), 0.05)))
    return Model(languages, table.astype(np.float32), bias, temperature, reject)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = 800) -> Model:
    """A model from ``docs`` (doc_id, text, lang).

    Learns only from rows that are not held out and have a text and a language: about
    ``per_language`` of each, chosen by a hash, and never more than twice that on the whole.
    """
    usable = docs.select("doc_id", "text", F.col("lang").alias("lang")).where(
        ~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return train([])
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, per_language / n)))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)
    sample = usable.where(draw < share[F.col("lang")]).limit(2 * per_language * len(counts))

    def make() -> Callable[[tuple], Iterable[tuple]]:
        def one(row: tuple) -> Iterable[tuple]:
            text = row[2].decode()
            found = subwords(text)
            if found.any():
                yield (row[0] or b"").decode(), row[1].decode(), *_sparse(found)
                if zlib.crc32(row[2]) % GIBBERISH == 0:
                    yield (row[0] or b"").decode(), None, *_sparse(subwords(gibberish(text)))

        return one

    sparse = per_row(
        sample.select(F.col("doc_id").cast("string").alias("id"), "lang", "text"),
        ["id", "lang", "text"], "id string, lang string, buckets binary, share binary, total double", make,
    )
    rows = sorted(sparse.collect(), key=lambda r: (r.id, r.lang or "", r.buckets, r.share))
    return train(
        [(r.lang, np.frombuffer(r.buckets, np.uint16), np.frombuffer(r.share, np.float32), r.total) for r in rows]
    )


def _sparse(counts: np.ndarray) -> tuple[bytes, bytes, float]:
    used, total = np.flatnonzero(counts), counts.sum()
    return used.astype(np.uint16).tobytes(), (counts[used] / total).astype(np.float32).tobytes(), float(total)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of ``docs``.

    A null text or one without letters is ``und`` with score 0, and rejected; so is every
    text if there is nothing to learn from. Repeated rows get the same prediction each; an
    empty table gives no rows; other columns are not used.
    """
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers a language

    def make() -> Callable[[tuple], Iterable[tuple]]:
        predict = shared.value
        return lambda row: [(row[0], row[1], *predict(None if row[2] is None else row[2].decode()))]

    return per_row(
        docs.select("doc_id", held_out().alias("held_out"), "text"), ["doc_id", "held_out", "text"],
        f"doc_id {id_type(docs)}, held_out boolean, lang_pred string, score double, rejected boolean",
        make,
    )


def accepted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is not rejected (see ``identify``).

    Where there is nothing to learn from, only texts without letters go.
    """
    model = model or fit(docs)
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value

        def keep(text: str | None) -> bool:
            return not predict(text)[2] if predict.languages else bool(text and subwords(text).any())

        for batch in batches:
            kept = [keep(text) for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
