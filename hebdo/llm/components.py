"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import stash


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(rows: DataFrame) -> DataFrame:
    """rows(u, v): hang every v, and u itself, below the least of u and its v's.

    The minimum is a partial aggregate joined back, so a centre with millions
    of neighbours is never gathered in one task (AQE splits the skewed join).
    """
    least = rows.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return rows.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b), any order -> (id, component): the least id reachable, for every id
    that an edge names. Self-loops and repeated edges are harmless; no edge, no row."""
    cur = (edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
           .filter("a < b").distinct())
    cur = stash(cur)
    before = _fingerprint(cur)
    while before[0]:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = (_star(both).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
                 .filter("a <> b").distinct())
        down = _star(large.select(F.col("b").alias("u"), F.col("a").alias("v")))
        small = (down.select(F.col("m").alias("a"), F.col("v").alias("b"))
                 .union(down.select(F.col("m").alias("a"), F.col("u").alias("b")))
                 .filter("a <> b").distinct())
        cur = stash(small)
        now = _fingerprint(cur)
        if now == before:
            break
        before = now
    return (cur.select(F.col("b").alias("id"), F.col("a").alias("component"))
            .union(cur.select(F.col("a").alias("id"), F.col("a").alias("component"))).distinct())
