"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.sources.shared import store


def _digest(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def connected(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of ``pairs`` (u, v), longs: the root is the
    smallest node that can be reached.

    Rounds of two steps until nothing changes, about as many as the logarithm of
    the longest chain.  First every node ties its larger neighbours to the
    smallest node it knows, then its smaller ones.  What a join reads is stored
    first: each round starts from files, and Spark can split a node with very
    many neighbours, as both sides are plain exchanges.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    pairs = store(pairs.where("u <> v").select(high.alias("u"), low.alias("v")).distinct(), "links")
    state = _digest(pairs)
    while True:
        both = store(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links-both")
        least = store(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "links-least")
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        larger = store(larger, "links-larger")
        least = store(larger.groupBy("u").agg(F.min("v").alias("m")), "links-smaller")
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = store(smaller.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _digest(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
