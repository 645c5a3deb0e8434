"""Exact top-k inner products through an index of pivots and distances.

Vectors of integers get one more coordinate, sqrt(M^2 - |x|^2) with M the greatest length, and
queries a zero: then the greater the inner product, the smaller the distance, as
|q - x|^2 = |q|^2 + M^2 - 2 qx. A vector is keyed by its nearest pivot and its distance to it;
the vectors of a pivot are cut at quantiles of that distance into rings, and rings into blocks
of bounded size, so that copies of one vector never meet in one task.

For a query at distance d of a pivot, a ring of distances [r, s] holds nothing nearer than
max(0, d - s, r - d), by the triangle inequality. A query visits the rings in the order of that
bound, eight times as many in each round, and leaves out those whose bound cannot beat its k-th
best score so far; it is done when no ring can.

Blocks are dealt out in groups of bounded size, in the order of the rings. In a round a task
takes the blocks of a group, then one after the other the queries that ask for its rings: a
query goes to a group once, with a bit for each ring, whatever the number of rings. Queries that
are near to each other travel together, and their k best so far stay with them. Nothing that
grows with the table goes to the driver, is broadcast or is held by a task. Pivots are fitted on
a bounded sample; they decide about work, never about results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.rows import arrow_schema, bound_batches, save_and_read, to_batch

#: rows that pivots are fitted on, most pivots, and most rings of a pivot
SAMPLE, PIVOTS, RINGS = 2048, 256, 64
#: vectors of a block, queries of a block, vectors that a ring should hold at least
BLOCK, ASKERS, RING = 4096, 1024, 512
#: bytes of a block and of a group of blocks, groups that a table should have if blocks suffice
BLOCK_BYTES, GROUP_BYTES, GROUPS = 4 << 20, 32 << 20, 32
#: queries and vectors that are multiplied at once, pairs of query and ring that are bounded at once and by a task
TILE, CELLS, BOUNDED = (1024, 1024), 1 << 17, 1 << 23
#: candidates of a block of queries, besides some for each, and bytes that are gathered before they go on
HELD, SENT = 1 << 16, 1 << 20

LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: a block of queries and the best that they have found: spots are places of queries in the block
BEST = (
    "block long, names binary, ids binary, m binary, spots binary, scores binary, found binary, rows binary, asked long"
)
#: a block of vectors, or queries that ask for rings of a group
DEALT = "grp int, kind int, key long, rows binary, ids binary, m binary, spots binary, floors binary, mask binary"


def _narrowest(low: int, high: int) -> np.dtype:
    kinds = map(np.dtype, (np.int8, np.int16, np.int32, np.int64))
    return next(t for t in kinds if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def _matrix(raw: list[bytes], widths: list[int], size: int, kind: np.dtype) -> np.ndarray:
    """Rows of integers that have so many bytes each, short rows filled with zeros."""
    out = np.zeros((len(raw), size), kind)
    if len(shape := set(zip(map(len, raw), widths))) == 1:
        ((length, width),) = shape
        out[:, : length // width] = np.frombuffer(b"".join(raw), f"i{width}").reshape(len(raw), length // width)
    else:
        for i, (r, width) in enumerate(zip(raw, widths)):
            out[i, : len(r) // width] = np.frombuffer(r, f"i{width}")
    return out


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One entry for each stretch of values."""
    ends = pa.py_buffer((starts * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(values))])


def _longs(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", np.int64)


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """With the coordinate that turns inner products into distances."""
    x = x.astype(np.float64)
    rest = np.maximum(0.0, most * most - (x * x).sum(axis=1))
    return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, squares))


def equal_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The same to the last bit on every machine and in every round, by one coordinate after the other."""
    squares = np.zeros((len(x), len(pivots)))
    for a, b in zip(x.T, pivots.T):
        apart = a[:, None] - b[None]
        squares += apart * apart
    return np.sqrt(squares)


def fit_pivots(x: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Means of ``count`` groups of the sample, from rows spread over it."""
    pivots = x[np.linspace(0, len(x) - 1, min(count, len(x))).astype(int)].copy()
    for _ in range(rounds):
        nearest = distances(x, pivots).argmin(axis=1)
        for p in np.unique(nearest):
            pivots[p] = x[nearest == p].mean(axis=0)
    return np.unique(pivots, axis=0)


def gaps(d: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """No vector of a ring (columns) is nearer to a query (rows)."""
    return np.maximum(0.0, np.maximum(d - high[None], low[None] - d))


def reached(gap: np.ndarray, length2: np.ndarray, most: float) -> np.ndarray:
    """No vector at such a distance or beyond has a greater inner product with a query (rows).

    A little is added for what floating point may have lost.
    """
    reach = length2[:, None] + most * most
    return (reach - gap * gap) / 2 + 1e-7 * reach + 1


def bounds(d: np.ndarray, low: np.ndarray, high: np.ndarray, length2: np.ndarray, most: float) -> np.ndarray:
    """No vector of a ring (columns) has a greater inner product with a query (rows)."""
    return reached(gaps(d, low, high), length2, most)


def first_of(keys: np.ndarray, count: int) -> np.ndarray:
    """Marks the ``count`` least of each row, of equal ones those on the left."""
    if not 0 < count < keys.shape[1]:
        return np.full(keys.shape, count > 0)
    last = np.partition(keys, count - 1, axis=1)[:, count - 1 : count]
    below, equal = keys < last, keys == last
    return below | equal & (np.cumsum(equal, axis=1) <= count - below.sum(axis=1)[:, None])


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    limit = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if limit < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if limit < 1 << 63:
        return q @ x.T
    raise OverflowError("inner products do not fit a long")


def ranked(spots: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple:
    """The entries of each spot's k best in their order, of equal scores the least ids, and their ranks from 0."""
    order = np.lexsort((rows, ids, -scores, spots))
    sorted_spots = spots[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_spots, sorted_spots)
    return order[rank < k], rank[rank < k]


def floors_of(n: int, spots: np.ndarray, scores: np.ndarray, ids: np.ndarray, rank: np.ndarray, k: int) -> tuple:
    """Score and id of the k-th best of each of n spots; whatever comes behind it is not asked for."""
    floors, ties = np.full(n, LEAST), np.full(n, MOST)
    last = rank == k - 1
    floors[spots[last]], ties[spots[last]] = scores[last], ids[last]
    return floors, ties


def best_of(scores: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best of each row that are not below its floor, of equal ones those on the left."""
    able = np.flatnonzero(scores.max(axis=1) >= floors)
    scores = scores[able]
    hit = scores >= floors[able, None]
    i, c = np.divmod(np.flatnonzero(hit), scores.shape[1])
    over = np.flatnonzero(np.bincount(i) > k) if len(i) > k else i[:0]
    if len(over):
        hit[over] = first_of(-scores[over], k)
        i, c = np.divmod(np.flatnonzero(hit), scores.shape[1])
    return able[i], c


def answer(asked: dict, blocks: list[tuple], first: int, rings: int, most: float, k: int) -> tuple:
    """spots, scores, ids and rows of the best that queries find in the rings of a group they ask for.

    ``blocks`` holds ring, rows, ids and vectors, in the order of ids; ``first`` is the first ring
    of ``rings`` that the group has.
    """
    names, ties, floors = (_longs(asked[c]) for c in ("rows", "ids", "floors"))
    n = len(names)
    ties, floors = ties.copy(), floors.copy()
    mask = np.unpackbits(np.frombuffer(asked["mask"], np.uint8).reshape(n, -1), axis=1)[:, :rings].astype(bool)
    # sums of integers below these are exact, in whatever order
    kind = np.float32 if most * most < 1 << 24 else np.float64 if most * most < 1 << 53 else np.int64
    q = np.frombuffer(asked["m"], blocks[0][3].dtype).reshape(n, blocks[0][3].shape[1]).astype(kind)
    # a query may find itself
    k += 1
    spare, held, count = np.empty(TILE[0] * TILE[1], kind), [], 0

    def settle() -> None:
        """Keep the best of what is held; behind them nothing is looked for."""
        nonlocal held, count
        spots, scores, ids, rows = (np.concatenate(c) for c in zip(*held))
        keep, rank = ranked(spots, scores, ids, rows, k)
        held = [(spots[keep], scores[keep], ids[keep], rows[keep])]
        count = len(keep)
        found, least = floors_of(n, *held[0][:3], rank, k)
        better = (found > floors) | (found == floors) & (least < ties)
        floors[better], ties[better] = found[better], least[better]

    for ring, rows, ids, m in blocks:
        asking = np.flatnonzero(mask[:, ring - first])
        for left in range(0, len(rows) if len(asking) else 0, TILE[1]):
            x = m[left : left + TILE[1]].astype(kind)
            for top in range(0, len(asking), TILE[0]):
                at = asking[top : top + TILE[0]]
                if kind is np.int64:
                    scores = products(q[at], x)
                else:
                    scores = spare[: len(at) * len(x)].reshape(len(at), len(x))
                    np.matmul(q[at[0] : at[-1] + 1] if at[-1] - at[0] + 1 == len(at) else q[at], x.T, out=scores)
                # scores are integers, and ids rise: an equal score behind the least id it must have is too late
                i, c = best_of(scores, (floors[at] + (ties[at] < ids[left])).astype(kind), k)
                if len(i):
                    held.append((at[i], scores[i, c].astype(np.int64), ids[left + c], rows[left + c]))
                    count += len(i)
                    if count > HELD + 4 * k * n:
                        settle()
    if not held:
        return (np.zeros(0, np.int64),) * 4
    spots, scores, ids, rows = (np.concatenate(c) for c in zip(*held))
    other = names[spots] != rows
    spots, scores, ids, rows = (c[other] for c in (spots, scores, ids, rows))
    keep, _ = ranked(spots, scores, ids, rows, k - 1)
    return _longs(asked["spots"])[spots[keep]], scores[keep], ids[keep], rows[keep]


def _mapped(df: DataFrame, ddl: str, make: Callable[[Iterator[pa.RecordBatch]], Iterable[list]]) -> DataFrame:
    """``make`` gives the columns of batches."""
    bound_batches(df.sparkSession)
    target = arrow_schema(df.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in make(b for b in batches if b.num_rows):
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, target)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, ddl)


def _flowing(df: DataFrame, ddl: str, make: Callable[[Iterator[dict]], Iterable[tuple]]) -> DataFrame:
    """Rows made of the rows of a task, in their order; few are held at a time. ``make`` gives them as tuples."""
    bound_batches(df.sparkSession)
    # rows are large here: fewer at once
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 2 * SENT)
    target = arrow_schema(df.sparkSession, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for row in make(r for b in batches for r in b.to_pylist()):
            out.append(row)
            held += sum(len(c) if isinstance(c, bytes) else 8 for c in row)
            if held > SENT:
                yield to_batch(out, target)
                out, held = [], 0
        yield to_batch(out, target)

    return df.mapInArrow(run, ddl)


def _runs(batches: Iterable[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Rows that follow each other and have equal keys, so many at most."""
    held, count, last = [], 0, None
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in keys]
        edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            key = tuple(c[a] for c in columns)
            while a < b:
                if held and (key != last or count == most):
                    yield pa.Table.from_batches(held)
                    held, count = [], 0
                last, take = key, min(b - a, most - count)
                held.append(batch.slice(a, take))
                count += take
                a += take
    if held:
        yield pa.Table.from_batches(held)


class _Index:
    """Keyed blocks of all vectors, and what queries must know about them."""

    def __init__(self, vectors: DataFrame) -> None:
        self.vectors = vectors
        found = vectors.agg(F.count("*"), F.max("length2"), F.max(F.expr("length(v) div width")), F.max("width")).first()
        self.rows, self.size, self.kind = found[0], found[2] or 0, np.dtype(f"i{found[3] or 1}")
        self.most = float(np.sqrt(found[1] or 0.0)) * (1 + 1e-9)
        sample = vectors.orderBy(F.xxhash64("row")).limit(SAMPLE).select("v", "width").collect()
        count = int(np.clip(np.sqrt(self.rows) / 8, 1, PIVOTS))
        raw, widths = ([r[c] for r in sample] for c in ("v", "width"))
        x = lifted(_matrix(raw, widths, self.size, np.dtype(np.int64)), self.most)
        self.pivots = fit_pivots(x, count) if self.rows else x
        if self.rows:
            self._build()

    def _keyed(self) -> DataFrame:
        size, kind, most, pivots = self.size, self.kind, self.most, self.pivots

        def make(batches: Iterator[pa.RecordBatch]) -> Iterable[list]:
            for b in batches:
                x = _matrix(b.column("v").to_pylist(), b.column("width").to_pylist(), size, kind)
                d = distances(lifted(x, most), pivots)
                p = d.argmin(axis=1)
                v = _binary(x.ravel(), np.arange(len(x) + 1) * size)
                yield [*(b.column(c) for c in ("row", "vec_id", "asks")), v, p.astype(np.int32), d[np.arange(len(p)), p]]

        ddl = "row long, vec_id long, asks boolean, v binary, pivot int, far double"
        return _mapped(self.vectors.select("row", "vec_id", "asks", "width", "v"), ddl, make)

    def _build(self) -> None:
        spark, size, pivots = self.vectors.sparkSession, self.size, self.pivots
        keyed = save_and_read(self._keyed(), "keyed")
        rings = int(np.clip(self.rows // (len(pivots) * RING), 1, RINGS))
        steps = [F.lit((i + 1) / rings) for i in range(rings - 1)]
        # a row for each pivot
        cuts = keyed.groupBy("pivot").agg(
            (F.percentile_approx("far", F.array(*steps)) if steps else F.array().cast("array<double>")).alias("cuts")
        )
        ringed = keyed.join(F.broadcast(save_and_read(cuts, "cuts")), "pivot")
        ringed = ringed.withColumn("ring", F.expr("size(filter(cuts, c -> c < far))")).drop("cuts")
        known = ringed.groupBy("pivot", "ring").agg(
            F.min("far").alias("low"), F.max("far").alias("high"), F.count("*").alias("n"),
            F.count_if("asks").alias("asking"),
        )
        # at most PIVOTS * RINGS rows
        found = sorted(known.collect())
        self.pivot_of = np.array([r["pivot"] for r in found])
        self.low, self.high = (np.array([r[c] for r in found], np.float64) for c in ("low", "high"))
        # rows of a vector with its row and id: blocks and groups are bounded by their bytes too
        bytes_each = size * self.kind.itemsize + 16
        block, ask = (int(np.clip(BLOCK_BYTES // bytes_each, 1, n)) for n in (BLOCK, ASKERS))
        of_group = max(block, min(GROUP_BYTES // bytes_each, -(-self.rows // GROUPS)))
        askers: dict[int, int] = {}
        for r in found:
            askers[r["pivot"]] = askers.get(r["pivot"], 0) + r["asking"]
        places, before, self.spans = [], 0, {}
        for at, r in enumerate(found):
            n, parts = r["n"], -(-r["n"] // block)
            # a pivot's queries are sorted in one task unless they are many
            places.append((r["pivot"], r["ring"], at, before, n, parts, -(-askers[r["pivot"]] // (16 * ask)) or 1))
            for group in range(before // of_group, (before + (parts - 1) * n // parts) // of_group + 1):
                self.spans[group] = (self.spans.get(group, (at,))[0], at + 1)
            before += n
        ddl = "pivot int, ring int, at int, before long, n long, parts long, shares long"
        placed = ringed.join(F.broadcast(spark.createDataFrame(places, ddl)), ["pivot", "ring"])
        placed = placed.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
        # queries are few bytes but much work
        self.tasks = int(np.clip(sum(askers.values()) * len(found) // BOUNDED, 1, 256))
        grp = F.expr(f"int((before + (part * n) div parts) div {of_group})")
        spread = placed.select(grp.alias("grp"), "at", "part", "vec_id", "row", "v").repartition("at", "part")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterable[list]:
            for t in _runs(batches, ["at", "part"], block):
                rows, ids = (t[c].to_numpy().tobytes() for c in ("row", "vec_id"))
                yield [[t["grp"][0].as_py()], [0], [t["at"][0].as_py()], [rows], [ids],
                       [b"".join(t["v"].to_pylist())], [None], [None], [None]]

        blocks = _mapped(spread.sortWithinPartitions("at", "part", "vec_id", "row"), DEALT, pack)
        self.blocks = save_and_read(blocks, "blocks")
        share = F.pmod(F.xxhash64("row"), F.col("shares")).alias("share")
        asking = placed.where("asks").select("pivot", share, "ring", "row", "vec_id", "v")
        asking = asking.repartition(self.tasks, "pivot", "share")

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterable[list]:
            for t in _runs(batches, ["pivot", "share"], ask):
                rows, ids = (t[c].to_numpy().tobytes() for c in ("row", "vec_id"))
                yield [[t["row"][0].as_py()], [rows], [ids], [b"".join(t["v"].to_pylist())],
                       [b""], [b""], [b""], [b""], [0]]

        self.askers = _mapped(asking.sortWithinPartitions("pivot", "share", "ring", "row"), BEST, gather)

    def requests(self, best: DataFrame, order: tuple[int, int], k: int) -> DataFrame:
        """Queries that ask for rings of a group in this round, in the order of their bounds."""
        size, kind, most, pivots, pivot_of, low, high, spans = (
            self.size, self.kind, self.most, self.pivots, self.pivot_of, self.low, self.high, self.spans
        )

        def wanted(x: np.ndarray, floors: np.ndarray) -> np.ndarray:
            q = np.concatenate([x, np.zeros((len(x), 1))], axis=1, dtype=np.float64)
            d = equal_distances(q, pivots)[:, pivot_of]
            gap = gaps(d, low, high)
            able = reached(gap, (q * q).sum(axis=1), most) >= floors[:, None]
            # by falling bound, of rings that may hold the query itself the nearer pivot
            key = np.where(gap > 0, gap, d - d.max(axis=1, keepdims=True) - 1)
            # bounds fall along the order: who is able to do with the rings visited asks for none
            live = np.flatnonzero(able.sum(axis=1) > order[0])
            key = key[live]
            able[live] &= first_of(key, order[1]) & ~first_of(key, order[0])
            able[np.setdiff1d(np.arange(len(x)), live)] = False
            return able

        def make(rows: Iterator[dict]) -> Iterable[tuple]:
            step = max(1, CELLS // len(low))
            for r in rows:
                names = _longs(r["names"])
                n = len(names)
                x = np.frombuffer(r["m"], kind).reshape(n, size)
                spots, scores, ids = (_longs(r[c]) for c in ("spots", "scores", "found"))
                rank = np.arange(len(spots)) - np.searchsorted(spots, spots)
                floors, ties = floors_of(n, spots, scores, ids, rank, k)
                asks = [wanted(x[i : i + step], floors[i : i + step]) for i in range(0, n, step)]
                asks = np.concatenate(asks)
                for group, (a, b) in spans.items():
                    at = np.flatnonzero(asks[:, a:b].any(axis=1))
                    if len(at):
                        mask = np.packbits(asks[at, a:b], axis=1)
                        parts = (names[at], ties[at], x[at], at, floors[at], mask)
                        yield group, 1, r["block"], *(c.tobytes() for c in parts)

        return _flowing(best, DEALT, make)

    def answers(self, requests: DataFrame, k: int) -> DataFrame:
        """What queries find in each group that they ask, and the number of rings they asked for."""
        size, kind, most, spans = self.size, self.kind, self.most, self.spans

        def make(rows: Iterator[dict]) -> Iterable[tuple]:
            group, blocks = None, []
            for r in rows:
                if r["grp"] != group:
                    group, blocks = r["grp"], []
                if r["kind"] == 0:
                    ids = _longs(r["ids"])
                    m = np.frombuffer(r["m"], kind).reshape(len(ids), size)
                    blocks.append((r["key"], _longs(r["rows"]), ids, m))
                else:
                    first, end = spans[group]
                    found = answer(r, blocks, first, end - first, most, k)
                    asked = int(np.bitwise_count(np.frombuffer(r["mask"], np.uint8)).sum())
                    yield r["key"], None, None, None, *(c.tobytes() for c in found), asked

        met = self.blocks.unionByName(requests).repartitionById(max(self.spans) + 1, F.col("grp"))
        return _flowing(met.sortWithinPartitions("grp", "kind", "key"), BEST, make)


def merged(best: DataFrame, found: DataFrame, k: int, tasks: int) -> DataFrame:
    """The blocks of queries with the k best of what they had and have found, and how many rings they asked for."""

    def make(rows: Iterator[dict]) -> Iterable[tuple]:
        block, held, asked = None, [], 0

        def settled() -> tuple:
            columns = [np.concatenate(c) for c in zip(*held)]
            keep, _ = ranked(*columns, k)
            return tuple(c[keep] for c in columns)

        for r in rows:
            if r["names"] is not None:
                if block:
                    yield *(block[c] for c in ("block", "names", "ids", "m")), *(c.tobytes() for c in settled()), asked
                block, held, asked = r, [], 0
            else:
                asked += r["asked"]
            held.append(tuple(_longs(r[c]) for c in ("spots", "scores", "found", "rows")))
            if sum(len(h[0]) for h in held) > HELD + 4 * len(held[0][0]):
                held = [settled()]
        if block:
            yield *(block[c] for c in ("block", "names", "ids", "m")), *(c.tobytes() for c in settled()), asked

    # a block's own row comes first: only it has names
    both = best.unionByName(found).repartition(tasks, "block")
    return _flowing(both.sortWithinPartitions("block", F.col("names").isNull()), BEST, make)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterable[list]:
    """Vectors with as few bytes for a component as the batch allows, and squares of their lengths."""
    for b in batches:
        values, starts = b.column("e").flatten().to_numpy(), b.column("e").offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        kind = _narrowest(values.min(initial=0), values.max(initial=0))
        length2, some = np.zeros(b.num_rows), np.flatnonzero(np.diff(starts))
        if len(some):
            length2[some] = np.add.reduceat(values.astype(np.float64) ** 2, starts[some])
        widths = np.full(b.num_rows, kind.itemsize, np.int32)
        yield [*(b.column(c) for c in ("row", "vec_id", "asks")), widths, _binary(values.astype(kind), starts), length2]


def _shown(batches: Iterator[pa.RecordBatch]) -> Iterable[list]:
    for b in batches:
        for r in b.to_pylist():
            spots, scores, found = (_longs(r[c]) for c in ("spots", "scores", "found"))
            rank = np.arange(1, len(spots) + 1) - np.searchsorted(spots, spots)
            yield [_longs(r["ids"])[spots], rank.astype(np.int32), found, scores]


def top_products(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k other rows with the greatest inner product.

    ``vectors`` holds vec_id and embedding, an array of integers; ``is_query`` tells from vec_id
    which rows are queries. Equal scores go to the smaller vec_id. A query has fewer rows if
    there are fewer others. Rows with a null vec_id, a null vector or a null component take no
    part; vectors of fewer components count as filled with zeros, so an empty one scores 0.
    A vec_id that comes twice is two rows: each is a candidate of the other, and each has
    results of its own if it is a query. Scores that do not fit a long are an error. An empty
    table gives no rows; other columns are not used.
    """
    whole = vectors.where("vec_id is not null and embedding is not null and not exists(embedding, x -> x is null)")
    whole = whole.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                         is_query.alias("asks"), F.col("embedding").cast("array<long>").alias("e"))
    ddl = "row long, vec_id long, asks boolean, width int, v binary, length2 double"
    index = _Index(save_and_read(_mapped(whole, ddl, _packed), "vectors"))
    shown = "query_id long, rank int, vec_id long, score long"
    if not index.rows:
        return vectors.sparkSession.createDataFrame([], shown)
    best = save_and_read(index.askers, "askers")
    first, last = 0, 4
    while first < len(index.low):
        found = index.answers(index.requests(best, (first, last), k), k)
        best = save_and_read(merged(best, found, k, index.tasks), "best")
        # bounds fall along the order, so no later ring can be asked for
        if not best.agg(F.sum("asked")).first()[0]:
            break
        first, last = last, 8 * last
    return _mapped(best, shown, _shown)


# every query against every other row; exact, as the sums of small integers are
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 20
"""
