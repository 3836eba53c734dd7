"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to u's smallest neighbour (or u)."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every node of ``links`` (u, v) that is not its component's smallest.

    Minima are aggregated before they are shuffled and joined back, so a node with very
    many links is folded map-side and its join partition can be split; each round is
    stored, which cuts the lineage.  A round or two more than the log of the longest path."""
    edges = stored(links.select("u", "v").filter("u <> v").distinct(), "links", few=True)
    before = _mark(edges)
    while True:
        last, edges = edges, stored(_small_star(_large_star(edges)), "links", few=True)
        discard(last)
        now = _mark(edges)
        if now == before:
            return edges.select("u", F.col("v").alias("root"))
        before = now
