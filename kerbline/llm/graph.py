"""Connected components of a graph of row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import land


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (a, b bigint) to (node, component): the smallest node reachable, for every node of an edge.

    Alternating large and small stars: each round hangs every node's larger neighbours, then the rest, below its
    smallest one, until nothing changes. Minima are combined before the shuffle, joins are equi-joins that adaptive
    execution splits where one node has many edges, and every round is landed, so lineage stays short.
    """
    pairs = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = land(pairs, name)
    seen, state = None, _state(pairs)
    while state != seen:
        pairs = land(_small_star(_large_star(pairs)), name)
        seen, state = state, _state(pairs)
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    hung = pairs.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first())
