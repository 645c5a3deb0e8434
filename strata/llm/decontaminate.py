"""Benchmark decontamination by winnowing, in column functions only.

A text's fingerprints are the least hash of its k-grams in every stretch of ``span - k + 1``
k-grams. Two texts that share ``span`` words share the least hash of that stretch, so an
equality join of fingerprints misses no shared span. A hit is then extended from the shared
k-gram to the whole window and compared word by word. Items shorter than a span are one
window; for each such length that occurs, all the documents' grams of that length are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.rows import same, save_and_read, text_key

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPAN, GRAM = 10, 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def _each(count: Column, body: Callable[[Column], Column], kind: str) -> Column:
    """``body`` of 1 .. count; an empty array if there is nothing to count."""
    empty = F.array().cast(f"array<{kind}>")
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), body)).otherwise(empty)


def gram_hashes(ws: Column, n: int, salt: int) -> Column:
    """Of every n consecutive words; ``salt`` keeps apart what must not be compared."""
    return _each(F.size(ws) - n + 1, lambda i: F.xxhash64(F.lit(salt), F.slice(ws, i, F.lit(n))), "bigint")


def _winnow(hashes: Column, width: int) -> Column:
    return _each(F.size(hashes) - width + 1, lambda i: F.array_min(F.slice(hashes, i, F.lit(width))), "bigint")


def fingerprints(text: Column, short: list[int], span: int, k: int) -> Column:
    """Distinct fingerprints of a text, with all grams of the ``short`` lengths."""

    def of(ws: Column) -> Column:
        kept = let(gram_hashes(ws, k, span), lambda hs: _winnow(hs, span - k + 1))
        return F.array_distinct(F.concat(kept, *(gram_hashes(ws, n, n) for n in short)))

    return let(words(text), of)


def windows(benchmark: DataFrame, span: int = SPAN, k: int = GRAM) -> DataFrame:
    """item_id, win (words), fp, at (1-based place of the least gram in the window)."""
    items = benchmark.select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    size = F.least(F.size("ws"), F.lit(span))
    rows = items.select("item_id", F.explode(_each(
        F.size("ws") - size + 1, lambda i: F.slice("ws", i, size), "array<string>")).alias("win"))
    whole = F.size("win") == span
    grams = gram_hashes(F.col("win"), k, span)
    return rows.distinct().select(
        "item_id", "win",
        F.when(whole, F.array_min(grams)).otherwise(F.xxhash64(F.size("win"), "win")).alias("fp"),
        F.when(whole, F.array_position(grams, F.array_min(grams)).cast("int")).otherwise(1).alias("at"),
    )


def _starts(ws: Column, grams: Column, w: Column, span: int) -> Column:
    """Where a window stands in a text: hits of its gram, extended to the whole window."""

    def whole(start: Column) -> Column:
        return (start > 0) & (F.slice(ws, F.greatest(start, F.lit(1)), F.size(w.win)) == w.win)

    places = F.filter(
        F.transform(grams, lambda h, i: F.when(h == w.fp, i + 2 - w.at)), lambda s: s.isNotNull()
    )
    short = _each(F.size(ws), lambda i: F.when(ws[i - 1] == w.win[0], i), "int")
    return F.filter(
        F.when(F.size(w.win) == span, places).otherwise(F.filter(short, lambda s: s.isNotNull())), whole
    )


KEYS = ["doc_id", "text_key"]


def contained(docs: DataFrame, wins: DataFrame, span: int = SPAN, k: int = GRAM) -> DataFrame:
    """doc_id, text_key, sure (window and its places) of the texts that contain windows.

    ``docs`` has doc_id, text and text_key; rows alike are one. ``wins`` comes from ``windows``.
    """
    # at most span - 1 numbers
    short = sorted(r.n for r in wins.select(F.size("win").alias("n")).where(f"n < {span}").distinct().collect())
    marks = save_and_read(wins.select("fp", "win", "at").distinct(), "marks")
    seen = docs.select(*KEYS, F.explode(fingerprints(F.col("text"), short, span, k)).alias("fp"))
    # one row for each window whose fingerprint occurs in the document
    hits = seen.join(marks, "fp").distinct()
    hits = hits.groupBy(*KEYS).agg(F.collect_list(F.struct("win", "fp", "at")).alias("found"))
    texts = docs.join(save_and_read(hits, "hits").withColumnRenamed("doc_id", "id"), "text_key").where(
        F.col("doc_id").eqNullSafe(F.col("id"))
    )

    def verify(ws: Column) -> Column:
        def found(grams: Column) -> Column:
            return F.filter(
                F.transform("found", lambda w: F.struct(
                    w.win.alias("win"), _starts(ws, grams, w, span).alias("starts"))),
                lambda x: F.size(x.starts) > 0,
            )

        return let(gram_hashes(ws, k, span), found)

    rows = texts.select(*KEYS, let(words(F.col("text")), verify).alias("sure")).where(F.size("sure") > 0)
    return save_and_read(rows, "contained").dropDuplicates(KEYS)


def uncontaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = GRAM) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no window of the benchmark."""
    keyed = docs.select("doc_id", "text", text_key().alias("text_key"))
    found = contained(keyed, save_and_read(windows(benchmark, span, k), "windows"), span, k)
    found = save_and_read(found.select(*KEYS), "leaks").alias("leak")
    return docs.alias("d").join(
        found,
        F.col("d.doc_id").eqNullSafe(F.col("leak.doc_id"))
        & text_key("d.text").eqNullSafe(F.col("leak.text_key")),
        "left_anti",
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = GRAM
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    Null and empty texts have no words; an item without words never occurs, one without an
    id hits words but is not listed. Items with the same id count once; repeated rows of
    ``docs`` are each reported. An empty table of documents gives no rows, an empty
    benchmark leaves all clean. Other columns are not used.
    """
    docs = docs.select("doc_id", "text", text_key().alias("text_key"))
    keys = KEYS
    wins = save_and_read(windows(benchmark, span, k), "windows")
    rows = contained(docs, wins, span, k)
    places = F.flatten(F.flatten(F.transform("sure", lambda x: F.transform(
        x.starts, lambda s: F.sequence(s, s + F.size(x.win) - 1)))))
    hit = rows.select(*keys, F.size(F.array_distinct(places)).cast("long").alias("n_hit"))
    named = (
        rows.select(*keys, F.explode("sure.win").alias("win"))
        .join(wins.select("item_id", "win").where("item_id is not null"), "win")
        .select(*keys, F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy(*keys).agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    base = docs.select(
        *keys, F.regexp_count(lowered(F.col("text")), F.lit(WORD)).cast("long").alias("n_words")
    )
    out = base.alias("b").join(hit.alias("h"), same("b", "h", keys), "left").join(
        named.alias("n"), same("b", "n", keys), "left"
    )
    items = F.coalesce("n.items", F.array().cast("array<string>"))
    n_hit = F.coalesce("h.n_hit", F.lit(0).cast("long"))
    return out.select(
        "b.doc_id", "b.n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM (SELECT *, least(len(w), 10) AS n FROM i WHERE len(w) > 0))),
places AS (
  SELECT rid, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
occ AS (SELECT rid, n, s, item_id FROM places JOIN wins USING (n, win)),
hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM occ) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM occ WHERE item_id IS NOT NULL)
  GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""
