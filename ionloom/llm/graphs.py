"""Connected components of links between 64-bit keys, by alternating stars in shuffles of the links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ionloom.llm.shared import kept

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """key, root: for every key in links (a, b), the smallest key of its component.

    Large star and small star in turn (each key's neighbours move to the smallest one) until all links form stars; the number
    of rounds grows with the logarithm of the links. Minima are pre-aggregated and written, so the join with them has plain
    shuffles on both sides: Spark broadcasts small ones, and splits the partition of a key with many links.
    """
    edges = kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(MOST_ROUNDS):
        if _are_stars(edges):
            return edges.select(F.col("a").alias("key"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct())
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "links")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        edges = kept(small, "links")
    raise RuntimeError(f"components still move after {MOST_ROUNDS} rounds")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each a has one b only, which is no a itself: then each b, the smaller end, is the smallest key of its component."""
    ends = edges.select(F.col("a").alias("key"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(edges.select(F.col("b").alias("key"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    seen = ends.groupBy("key").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return not seen.agg(F.coalesce(F.max((F.col("low") > 1) | (F.col("low") > 0) & (F.col("high") > 0)), F.lit(False)).alias("more")).first()["more"]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n places linked by pairs (a, b), the smallest place of each one's component; all at once, in memory."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = np.minimum(label, label[label])
        if (label == before).all():
            break
    while (label[label] != label).any():
        label = label[label]
    return label
