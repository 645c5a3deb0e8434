"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.rows import save_and_read


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (a, b).

    Links in either direction and repeated ones are fine; a link with a null is ignored.
    Each round is a written table. A node with very many links is one row for each link
    and one minimum, never a list; the planner splits such a key in the joins.
    """
    edges = save_and_read(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    for _ in range(rounds):
        edges = save_and_read(_star(_star(edges, large=True), large=False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every larger neighbour of a node is linked to the node's least neighbour.
    Small: every smaller neighbour, and the node itself, is."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()
