"""Set-similarity join of word shingles by PartEnum signatures, exact, with its components.

Two sets whose Jaccard similarity reaches the threshold differ in at most k elements, where
k follows from the size band. The hash domain is cut into more than k parts; a pair differs
in at most k of them, so at least one part holds the same elements in both. The signature of
a set for a part is the hash of its elements there: sufficiently similar sets share one.

Sets belong to a band of sizes and are also enumerated for the band below, so that all pairs
of similar sizes meet in one band. Parts without elements say nothing and are left out; the
number of parts allows for ``spare`` such parts, and a set that has more emits them all, so
that no pair is missed.

Signatures that several sets share give lists of candidates. Each list is first checked
against one member; only where members are then still in different components are the
remaining pairs of different components compared, each in one of the lists it shares. Groups of
copies settle in the first step and are never expanded into pairs. Before the texts of a pair are fetched, a bit map of each
set is compared: sets differ in at least as many elements as their maps differ in bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.components import components
from strata.llm.rows import (
    arrow_schema, bound_batches, id_type, per_row, save_and_read, squeeze, to_batch, unsqueeze,
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: signatures that one task reads at once, on average
BUCKET = 500_000
#: 64-bit words of a set's bit map
MAP = 16
#: lists by which a pair is known to have been made in another list
FIRST_LISTS = 64


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle."""
    data = _LOWER[W.as_bytes(text)]
    hashes = W.hashes(data, *W.bounds(data))
    if not len(hashes):
        return hashes
    return np.unique(W.grams(hashes, min(size, len(hashes))))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def set_key(h: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the set."""
    with np.errstate(over="ignore"):
        one, two = W.mix(h).sum(dtype=np.uint64), W.mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def bit_map(h: np.ndarray) -> list[int]:
    """Bits that the elements of a set fall on."""
    bits = np.zeros(64 * MAP, bool)
    bits[(h % np.uint64(64 * MAP)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64).tolist()


def _plausible(a: str, b: str, percent: int) -> Column:
    """Whether two sets, given as struct columns (n, bits), can be similar at all."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = reduce(
        lambda x, y: x + y,
        (F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(MAP)),
    )
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (
        (100 + percent) * differ <= (100 - percent) * (n + m)
    )


class Bands:
    """Size bands of a threshold, with the parts that each needs."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.first = [1]  # least size of each band
        self.parts: list[tuple[int, int, np.ndarray]] = []

    def of(self, size: int) -> int:
        while self.first[-1] <= size:
            self.first.append(self.first[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.first, size, side="right")) - 1

    def layout(self, band: int) -> tuple[int, int, np.ndarray]:
        """Number of parts, spare parts, and the borders between parts."""
        while len(self.parts) <= band:
            j = len(self.parts)
            self.of(self.first[j])
            top = self.first[j + 1] - 1
            union = 100 * (top + top * 100 // self.percent) // (100 + self.percent)
            differ = (100 - self.percent) * union // 100
            empty = (differ + 1) * float(np.exp(-self.first[j] / (differ + 1)))
            spare = 1 + int(np.ceil(empty + 2 * np.sqrt(empty)))
            n = differ + 1 + spare
            borders = np.arange(1, n, dtype=np.uint64) * np.uint64((1 << 64) // n)
            self.parts.append((n, spare, borders))
        return self.parts[band]

    def signatures(self, h: np.ndarray) -> np.ndarray:
        """Of a set, for its own band and the one below."""
        if not len(h):
            return h
        own = self.of(len(h))
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(h), dtype=np.uint64)])
            out = []
            for band in (own, own - 1):
                if band < 0:
                    continue
                n, spare, borders = self.layout(band)
                at = np.concatenate([[0], np.searchsorted(h, borders), [len(h)]])
                salt = np.arange(n, dtype=np.uint64) + np.uint64((band + 1) << 40)
                found = W.mix(sums[at[1:]] - sums[at[:-1]] + W.mix(salt))
                filled = at[1:] > at[:-1]
                out.append(found if n - filled.sum() > spare else found[filled])
        return np.concatenate(out)


def _packed(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """bucket, found: signatures and set keys of many documents, packed.

    A bucket is a range of signatures and keeps their last 48 bits.
    """
    bound_batches(docs.sparkSession)
    ddl = "bucket long, found binary"
    target = arrow_schema(docs.sparkSession, ddl)

    def pack(signs: list[np.ndarray], keys: list[int]) -> pa.RecordBatch:
        s = np.concatenate(signs)
        k = np.repeat(np.array(keys, np.int64), [len(x) for x in signs])
        order = np.argsort(s)
        s, k = s[order], k[order]
        bucket = ((s >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # rises with s
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        rows = []
        for low, high in zip(cuts, [*cuts[1:], len(s)]):
            part = s[low:high]
            rows.append((int(bucket[low]), b"".join([
                part.astype(np.uint32).tobytes(), (part >> np.uint64(32)).astype(np.uint16).tobytes(),
                k[low:high].tobytes()])))
        return to_batch(rows, target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                h = shingles(text, size)
                if len(h):
                    key = set_key(h)[0]
                    # copies of one set in this batch count once
                    if key not in held:
                        held[key] = bands.signatures(h)
                if len(held) >= 4000:
                    yield pack([*held.values()], [*held])
                    held = {}
        if held:
            yield pack([*held.values()], [*held])

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, ddl)


def _lists(packed: DataFrame) -> DataFrame:
    """list, member: sets that share a signature, each list of members once a bucket."""
    ddl = "list long, member long"
    target = arrow_schema(packed.sparkSession, ddl)

    def shared(blobs: list[bytes]) -> pa.RecordBatch:
        signs, keys = [], []
        for blob in blobs:
            n = len(blob) // 14
            high = np.frombuffer(blob, np.uint16, n, 4 * n).astype(np.uint64)
            signs.append((high << np.uint64(32)) | np.frombuffer(blob, np.uint32, n))
            keys.append(np.frombuffer(blob[6 * n :], np.int64))
        s, k = np.concatenate(signs), np.concatenate(keys)
        order = np.lexsort((k, s))
        s, k = s[order], k[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (k[1:] != k[:-1])
        s, k = s[new], k[new]
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        sizes = np.diff(np.append(starts, len(s)))
        with np.errstate(over="ignore"):
            names = W.mix(np.add.reduceat(W.mix(k.view(np.uint64)), starts) + sizes.astype(np.uint64))
        many = np.flatnonzero(sizes > 1)
        _, first = np.unique(names[many], return_index=True)
        chosen = many[first]
        at = np.repeat(starts[chosen], sizes[chosen]) + _within(sizes[chosen])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(names[chosen], sizes[chosen]).view(np.int64)), pa.array(k[at])],
            schema=target,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b != bucket and held:
                    yield shared(held)
                    held = []
                bucket = b
                held.append(found)
        if held:
            yield shared(held)

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ddl)


def _within(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """a, b (ids) of the pairs (x, y: set keys) that really are similar."""
    left = texts.select(F.col("key").alias("x"), F.col("id").alias("a"), F.col("squeezed").alias("s"))
    right = texts.select(F.col("key").alias("y"), F.col("id").alias("b"), F.col("squeezed").alias("t"))

    def make():
        last: list = [None, None]

        def one(row: tuple) -> Iterable[tuple]:
            a, b, s, t = row
            if last[0] != a:
                last[:] = [a, shingles(unsqueeze(s), size)]
            if a != b and similar(last[1], shingles(unsqueeze(t), size), percent):
                yield a, b

        return one

    kind = dict(texts.dtypes)["id"]
    joined = pairs.join(left, "x").join(right, "y")
    return per_row(joined, ["a", "b", "s", "t"], f"a {kind}, b {kind}", make)


def similarity_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    ``component_id`` is the least doc_id that links of at least ``percent`` Jaccard
    similarity reach, its own included. A null text, or one without words, has no shingles
    and no links. Repeated rows are copies of each other. Rows of one doc_id with different
    texts are one document in the links. A row without a doc_id links with nothing and has
    no component. An empty table gives no rows; other columns are not used.
    """
    docs = docs.select("doc_id", "text")
    kind = id_type(docs)

    def make():
        def one(row: tuple) -> Iterable[tuple]:
            h = shingles(row[1], size)
            yield row[0], len(h), *set_key(h), bit_map(h)

        return one

    schema = f"doc_id {kind}, n_shingles long, key long, more long, bits array<long>"
    sets = save_and_read(per_row(docs, ["doc_id", "text"], schema, make), "sets")
    linked = sets.where("n_shingles > 0 and doc_id is not null")
    same = ["key", "more", "n_shingles"]
    # a third of all rows may be one set: its copies meet in one minimum
    classes = save_and_read(linked.groupBy(*same).agg(F.min("doc_id").alias("id")), "classes")
    total = linked.agg(F.sum("n_shingles")).first()[0] or 0
    if total == 0:
        return sets.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    buckets = max(8, 4 * total * (100 - percent) // (percent + 100) // BUCKET)
    usable = docs.where("doc_id is not null and text is not null")
    lists = save_and_read(_lists(_packed(usable, size, percent, buckets)).distinct(), "lists")
    members = lists.select(F.col("member").alias("key")).distinct()
    maps = linked.join(members, "key").groupBy("key").agg(
        F.first(F.struct(F.col("n_shingles").alias("n"), "bits")).alias("set")
    )
    maps = save_and_read(maps, "maps")
    texts = _texts(docs, classes, members, size)
    # the member on most lists differs least from the others, so most links lead to it
    often = lists.groupBy("member").agg(F.count("*").alias("often"))
    centers = lists.join(often, "member").groupBy("list").agg(F.max(F.struct("often", "member")).alias("c"))
    centers = centers.select("list", F.col("c.member").alias("x"))
    first = lists.join(centers, "list").where("x <> member").select("x", F.col("member").alias("y")).distinct()
    first = save_and_read(first, "pairs")
    near = first.join(maps.toDF("x", "a"), "x").join(maps.toDF("y", "b"), "y").where(_plausible("a", "b", percent))
    links = save_and_read(_verified(near.select("x", "y"), texts, size, percent), "similar")
    # rows of one doc_id with several sets
    owners = linked.join(classes, same).select("doc_id", "id").distinct()
    several = owners.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z")
    several = owners.join(several, "doc_id").select("a", F.col("id").alias("b"))
    links = save_and_read(links.unionByName(several), "all_links")
    found = components(links)
    rest = _open_pairs(lists, classes, found, maps, first, percent)
    more = save_and_read(_verified(rest, texts, size, percent), "similar")
    if not more.isEmpty():
        # what is joined already stays so
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = classes.join(found, classes["id"] == found["node"], "left").select(
        *same, F.coalesce("component", "id").alias("component_id")
    )
    return sets.join(named, same, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: of each component the row
    with the least doc_id stays (of several rows with that id, the one whose text sorts first).

    Rows without words or without a doc_id link with nothing and stay.
    """
    found = similarity_components(docs, size, percent)
    kept = found.where("doc_id = component_id").groupBy("doc_id").agg(F.max("n_shingles").alias("n"))
    kept = save_and_read(kept, "kept").withColumnsRenamed({"doc_id": "kept_id", "n": "kept_n"})
    least = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
    own = docs.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("kept_id"))
    own = own.withColumn("kept_at", F.row_number().over(least))
    own = own.where("kept_at = 1 or kept_n = 0").select(*docs.columns)
    return own.unionByName(docs.where("doc_id is null"))


def _texts(docs: DataFrame, classes: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """key, id, squeezed: one text for each set that is a candidate."""
    kind = id_type(docs)
    wanted = classes.join(keys, "key").select(F.col("id").alias("doc_id"), "key")

    def small():
        return lambda row: [(row[0], squeeze(row[1]))]

    def checked():
        # a doc_id may come with several texts
        def one(row: tuple) -> Iterable[tuple]:
            if set_key(shingles(unsqueeze(row[2]), size))[0] == row[0]:
                yield row

        return one

    moved = per_row(docs.where("text is not null"), ["doc_id", "text"], f"doc_id {kind}, squeezed binary", small)
    found = moved.join(wanted, "doc_id").groupBy("doc_id", "key", "squeezed").count()
    rows = per_row(found, ["key", "doc_id", "squeezed"], f"key long, id {kind}, squeezed binary", checked)
    return save_and_read(rows, "texts")


def _open_pairs(
    lists: DataFrame, classes: DataFrame, found: DataFrame, maps: DataFrame, done: DataFrame, percent: int
) -> DataFrame:
    """Pairs of a list that are still in different components, can be similar, and have not
    been compared."""
    placed = classes.join(found, classes["id"] == found["node"], "left").select(
        F.col("key").alias("member"), F.coalesce("component", "id").alias("component")
    )
    rows = lists.join(placed, "member")
    mixed = rows.groupBy("list").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p <> q")
    rows = save_and_read(rows.join(mixed.select("list"), "list"), "mixed")
    # a pair that shares several lists is made in the least of them, if that is among the
    # first of both; else in each
    first = F.slice(F.array_sort(F.collect_set("list")), 1, FIRST_LISTS).alias("first")
    rows = rows.join(rows.groupBy("member").agg(first), "member").join(maps.toDF("member", "set"), "member")
    rows = save_and_read(rows, "open")
    one = rows.select("list", F.col("member").alias("x"), F.col("set").alias("a"), F.col("component").alias("c1"),
                      F.col("first").alias("f1"))
    two = rows.select("list", F.col("member").alias("y"), F.col("set").alias("b"), F.col("component").alias("c2"),
                      F.col("first").alias("f2"))
    least = F.array_min(F.array_intersect("f1", "f2"))
    once = F.coalesce(least == F.col("list"), F.lit(True))
    pairs = one.join(two, "list").where("x < y and c1 <> c2").where(_plausible("a", "b", percent) & once)
    return save_and_read(pairs.select("x", "y").distinct().join(done, ["x", "y"], "left_anti"), "open_pairs")
