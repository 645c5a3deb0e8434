"""Removal of repeated passages with suffix automata over shards of repeated text.

A window of ``span`` words is anchored at the least hash of its k-grams, which the content of
the window alone decides, so all places of a window share an anchor. Only text around anchors
that occur more than once can repeat; its distinct stretches, with their numbers of places,
are the reference. The reference is cut into shards by anchor; a task builds the automaton of
a shard and streams the shard's stretches through it: matching statistics give the longest
match that ends at each word, and the automaton's place counts tell whether a span of that
length stands more than once. Sending every shard to every document would cost documents
times shards; a shard can only match stretches that share its anchors, so those are sent to
the shard instead.

An anchor with more than ``hot`` places (boilerplate in a large part of all documents) would
make one shard too large. Around such anchors windows are counted one by one, by a 128-bit
digest, with partial sums before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.rows import arrow_schema, bound_batches, id_type, per_row, same, save_and_read, text_key, to_batch

GRAM = 8
#: anchors that one task compares at once, and stretches of an automaton, on average
BUCKET, SHARD = 400_000, 2000


class Automaton:
    """The suffix automaton of several word sequences, with how often each match stands there."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.places = [-1], [0], [0]

    def _state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.places.append(0)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A state for the matches of q that are no longer than p's and the word."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list, places: int) -> None:
        at = 0
        for word in sequence:
            q = self.next[at].get(word)
            if q is not None:
                at = q if self.length[q] == self.length[at] + 1 else self._split(at, word, q)
            else:
                new, p = self._state(self.length[at] + 1, {}, 0), at
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
                at = new
            self.places[at] += places

    def finish(self) -> None:
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.places[self.link[s]] += self.places[s]

    def ends(self, sequence: list, span: int, least: int) -> Iterator[int]:
        """Where a match of ``span`` words that stands ``least`` times or more ends."""
        at = size = 0
        for i, word in enumerate(sequence):
            while at and word not in self.next[at]:
                at = self.link[at]
                size = self.length[at]
            if word in self.next[at]:
                at, size = self.next[at][word], size + 1
            while at and self.length[self.link[at]] >= span:
                at = self.link[at]
                size = self.length[at]
            if size >= span and self.places[at] >= least:
                yield i + 1


def spans(ends: Iterable[int], span: int) -> list[tuple[int, int]]:
    """What windows that end there cover, joined."""
    out: list[tuple[int, int]] = []
    for e in ends:
        if out and e - span <= out[-1][1]:
            out[-1] = (out[-1][0], e)
        else:
            out.append((e - span, e))
    return out


def anchors(text: bytes | None, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every k-gram, and for every window of ``span`` words the place of its least."""
    data = W.as_bytes(text)
    grams = W.grams(W.hashes(data, *W.bounds(data)), k)
    width = span - k + 1
    if len(grams) < width:
        return grams, np.empty(0, np.int64)
    value, place, size = grams, np.arange(len(grams)), 1
    while size < width:
        step = min(size, width - size)
        keep = value[:-step] <= value[step:]  # of equal ones the first
        value, place = np.where(keep, value[:-step], value[step:]), np.where(keep, place[:-step], place[step:])
        size += step
    return grams, place


def _runs(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each anchor."""
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return first, np.append(first[1:], len(place)) - 1


def _packed(docs: DataFrame, span: int, k: int, buckets: int) -> DataFrame:
    """bucket, found: the anchors of many rows, packed.

    Of an anchor that stands several times in the rows of a batch, one place goes to the
    anchor's bucket, with their number. The others are known to be repeated and go with
    bucket -1, so that a bucket gets each anchor at most once from a batch.
    """
    bound_batches(docs.sparkSession)
    ddl = "bucket long, found binary"
    target = arrow_schema(docs.sparkSession, ddl)

    def pack(held: list[tuple]) -> pa.RecordBatch:
        a = np.concatenate([x[0] for x in held])
        key = np.repeat(np.array([x[2] for x in held], np.int64), [len(x[0]) for x in held])
        place = np.concatenate([x[1] for x in held]).astype(np.uint32)
        bucket = a % np.uint64(buckets)
        order = np.lexsort((a, bucket))
        a, key, place, bucket = a[order], key[order], place[order], bucket[order]
        sign = a >> np.uint64(16)
        new = np.ones(len(a), bool)
        new[1:] = (sign[1:] != sign[:-1]) | (bucket[1:] != bucket[:-1])
        number = np.diff(np.append(np.flatnonzero(new), len(a))).astype(np.uint32)
        rows = []
        if not new.all():
            rows.append((-1, key[~new].tobytes() + _name(sign[~new], bucket[~new]).tobytes() + place[~new].tobytes()))
        key, place, bucket, sign = key[new], place[new], bucket[new], sign[new]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        for low, high in zip(cuts, [*cuts[1:], len(sign)]):
            part = sign[low:high]
            rows.append((int(bucket[low]), b"".join([
                key[low:high].tobytes(), (part >> np.uint64(16)).astype(np.uint32).tobytes(),
                place[low:high].tobytes(), number[low:high].tobytes(), part.astype(np.uint16).tobytes()])))
        return to_batch(rows, target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams, place = anchors(text, span, k)
                if len(place):
                    at = place[_runs(place)[0]]
                    held.append((grams[at], at, key))
                    total += len(at)
                    if total >= 500_000:
                        yield pack(held)
                        held, total = [], 0
        if held:
            yield pack(held)

    return docs.select("row_key", F.col("text").cast("binary").alias("text")).mapInArrow(run, ddl)


def _name(sign: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """One number for an anchor, whose hash a bucket holds without its last bits."""
    return W.mix(sign ^ W.mix(bucket.astype(np.uint64)))


def _repeated(packed: DataFrame, hot: int) -> DataFrame:
    """row_key, p, h: places of the anchors that stand more than once, and of those with more
    than ``hot`` places."""
    counted = save_and_read(_counted(packed.where("bucket >= 0"), hot), "counted")
    heavy = counted.where("hot is not null").select("hot").distinct()
    ddl = "row_key long, name long, place int"
    target = arrow_schema(packed.sparkSession, ddl)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(1).to_pylist():
                n = len(blob) // 20
                columns = [(np.int64, 0), (np.int64, 8 * n), (np.int32, 16 * n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(blob, t, n, at)) for t, at in columns], schema=target
                )

    waiting = packed.where("bucket < 0").mapInArrow(unpack, ddl)
    waiting = waiting.join(heavy, waiting["name"] == heavy["hot"], "left").groupBy("row_key").agg(
        F.collect_list(F.when(F.col("hot").isNull(), F.col("place"))).alias("p"),
        F.collect_list(F.when(F.col("hot").isNotNull(), F.col("place"))).alias("h"),
    )
    rows = counted.where("hot is null").select("row_key", "p", "h").unionByName(waiting)
    return rows.groupBy("row_key").agg(
        F.flatten(F.collect_list("p")).alias("p"), F.flatten(F.collect_list("h")).alias("h")
    )


def _counted(packed: DataFrame, hot: int) -> DataFrame:
    """row_key, p, h of the places in buckets, and a row with the name of each hot anchor."""
    ddl = "row_key long, p array<int>, h array<int>, hot long"
    target = arrow_schema(packed.sparkSession, ddl)

    def found(bucket: int, blobs: list[bytes]) -> pa.RecordBatch:
        parts = []
        for blob in blobs:
            n = len(blob) // 22
            sign = np.frombuffer(blob, np.uint32, n, 8 * n).astype(np.uint64) << np.uint64(16)
            parts.append((sign | np.frombuffer(blob, np.uint16, n, 20 * n),
                          np.frombuffer(blob, np.int64, n), np.frombuffer(blob, np.uint32, n, 12 * n),
                          np.frombuffer(blob, np.uint32, n, 16 * n)))
        a, key, place, number = (np.concatenate([p[i] for p in parts]) for i in range(4))
        order = np.argsort(a, kind="stable")
        a, key, place, number = a[order], key[order], place[order], number[order]
        starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        sums = np.add.reduceat(number.astype(np.int64), starts)
        rows = [
            (None, None, None, int(x)) for x in
            _name(a[starts], np.full(len(starts), bucket, np.uint64))[sums > hot].view(np.int64)
        ]
        many = np.repeat(sums, np.diff(np.append(starts, len(a))))
        key, place, many = key[many > 1], place[many > 1], many[many > 1]
        order = np.argsort(key, kind="stable")
        key, place, many = key[order], place[order], many[order]
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
        for low, high in zip(cuts, [*cuts[1:], len(key)]):
            heavy, p = many[low:high] > hot, place[low:high]
            rows.append((int(key[low]), p[~heavy].tolist(), p[heavy].tolist(), None))
        return to_batch(rows, target)

    return _by_bucket(packed, found, ddl)


def _by_bucket(packed: DataFrame, work, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b != bucket and held:
                    yield work(bucket, held)
                    held = []
                bucket = b
                held.append(blob)
        if held:
            yield work(bucket, held)

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ddl)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _stretches(
    text: bytes, places: np.ndarray, hot_places: np.ndarray, span: int, k: int
) -> Iterator[tuple[int, int | None, bytes]]:
    """start, anchor, words: the text around each repeated anchor; without an anchor, one window."""
    grams, place = anchors(text, span, k)
    listed = text.split()
    first, last = _runs(place)
    at = place[first]
    for kind, chosen in ((0, places), (1, hot_places)):
        for i in np.flatnonzero(np.isin(at, chosen)):
            low, high = int(first[i]), int(last[i])
            if kind == 0:
                yield low, int(grams[at[i]].astype(np.int64)), b" ".join(listed[low : high + span])
            else:
                for s in range(low, high + 1):
                    yield s, None, b" ".join(listed[s : s + span])


def _verdicts(counted: DataFrame, shards: int, span: int) -> DataFrame:
    """stretch (digest), covered (pairs of words): what of each distinct stretch stands more than once."""
    ddl = "stretch binary, covered array<int>"
    target = arrow_schema(counted.sparkSession, ddl)

    def judge(rows: list[tuple[bytes, int]]) -> list[tuple]:
        automaton = Automaton()
        listed = [(words.split(b" "), n, words) for words, n in rows]
        for sequence, n, _ in listed:
            automaton.add(sequence, n)
        automaton.finish()
        out = []
        for sequence, _, words in listed:
            covered = [x for pair in spans(automaton.ends(sequence, span, 2), span) for x in pair]
            if covered:
                out.append((_digest(words), covered))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            out = []
            for s, words, stretch, n in zip(*(c.to_pylist() for c in batch.columns)):
                if words is None:
                    if n > 1:
                        out.append((stretch, [0, span]))
                    continue
                if s != shard and held:
                    out += judge(held)
                    held = []
                shard = s
                held.append((words, n))
            yield to_batch(out, target)
        if held:
            yield to_batch(judge(held), target)

    shard = F.pmod(F.coalesce("anchor", F.xxhash64("stretch")), F.lit(shards))
    rows = counted.select(shard.alias("shard"), "words", "stretch", "n")
    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, ddl)


def repeated_spans(docs: DataFrame, span: int = 35, k: int = GRAM, hot: int = 2000) -> DataFrame:
    """doc_id, text_key, text, n (rows alike), marked: pairs of words, of rows with repeated passages.

    ``docs`` has doc_id, text and text_key; a word is marked if a window of ``span`` words
    that covers it also starts anywhere else, in the same row or another.
    """
    kind = id_type(docs)
    keyed = docs.select(
        "doc_id", "text_key", F.xxhash64("doc_id", "text_key").alias("row_key"), "text"
    ).where("text is not null")
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a window of 35 words has about one anchor in 14 words, of 6 bytes
    buckets = max(8, size // (6 * (span - k + 2) // 2 * BUCKET))
    packed = save_and_read(_packed(keyed, span, k, buckets), "anchors")
    repeated = save_and_read(_repeated(packed, hot), "repeated")
    # rows alike must keep their number: each place counts
    texts = keyed.join(repeated, "row_key").select("doc_id", "text_key", "text", "p", "h")
    texts = save_and_read(texts, "texts")
    total = repeated.agg(F.sum(F.size("p"))).first()[0] or 0
    shards = max(8, total // SHARD)

    def make(full: bool):
        def one(row: tuple) -> Iterable[tuple]:
            text, p, h = row[:3]
            for start, anchor, words in _stretches(text, np.array(p, int), np.array(h, int), span, k):
                digest = _digest(words)
                if full:
                    yield digest, anchor, None if anchor is None else words
                else:
                    yield *row[3:], start, digest

        return lambda: one

    stretches = per_row(texts, ["text", "p", "h"], "stretch binary, anchor long, words binary", make(True))
    counted = stretches.groupBy("stretch", "anchor", "words").agg(F.count("*").alias("n"))
    verdicts = save_and_read(_verdicts(counted, shards, span), "verdicts")
    once = texts.dropDuplicates(["doc_id", "text_key"])
    places = per_row(
        once, ["text", "p", "h", "doc_id", "text_key"],
        f"doc_id {kind}, text_key long, start int, stretch binary", make(False),
    )
    marked = (
        places.join(verdicts, "stretch")
        .select("doc_id", "text_key", F.transform("covered", lambda x: x + F.col("start")).alias("at"))
        .groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("at")).alias("marked"))
    )
    keys = ["doc_id", "text_key"]
    return once.alias("t").join(marked.alias("m"), same("t", "m", keys)).select(
        "t.doc_id", "t.text_key", "t.text", "m.marked"
    )


def deduplicated(docs: DataFrame, span: int = 35, k: int = GRAM, hot: int = 2000) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``.

    Null and empty texts have no words, and keep the hash of nothing. A row that is repeated
    counts as a further document, so all its windows stand more than once. An empty table
    gives no rows; other columns are not used.
    """
    docs = docs.select("doc_id", "text", text_key().alias("text_key"))
    kind = id_type(docs)

    def whole():
        def one(row: tuple) -> Iterable[tuple]:
            listed = (row[2] or b"").split()
            yield row[0], row[1], len(listed), hashlib.sha256(b" ".join(listed)).hexdigest()

        return one

    def cut():
        def one(row: tuple) -> Iterable[tuple]:
            listed = row[2].split()
            marks = np.zeros(len(listed) + 1, np.int64)
            at = np.array(row[3])
            np.add.at(marks, at[::2], 1)
            np.add.at(marks, at[1::2], -1)
            gone = np.cumsum(marks[:-1]) > 0
            kept = b" ".join(w for w, g in zip(listed, gone.tolist()) if not g)
            yield row[0], row[1], int(gone.sum()), hashlib.sha256(kept).hexdigest()

        return one

    base = per_row(docs, ["doc_id", "text_key", "text"],
                   f"doc_id {kind}, text_key long, n_words long, whole string", whole)
    found = repeated_spans(docs, span, k, hot)
    changed = per_row(found, ["doc_id", "text_key", "text", "marked"],
                      f"doc_id {kind}, text_key long, n_removed long, kept string", cut)
    keys = ["doc_id", "text_key"]
    return base.alias("b").join(changed.alias("c"), same("b", "c", keys), "left").select(
        "b.doc_id", "b.n_words", F.coalesce("c.n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("c.kept", "b.whole").alias("kept_sha256"),
    )
