"""Connected components of links, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.session import checkpointed


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(v, root) for each id that occurs in ``links`` (a, b): root is the smallest id it reaches.

    Each round hangs the larger neighbours of every id, and then its smaller ones, below the smallest (large star, small
    star; Kiveris et al. 2014), until nothing moves; that takes about the logarithm of the longest path. Only the number of links
    and a checksum come to the driver; each round's links are written to the checkpoint folder.
    """
    edges = checkpointed(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        # Now v < u in each link; hang u and its smaller neighbours below the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(hung.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("v"), F.col("v").alias("root")).union(roots.select(F.col("root").alias("v"), "root"))
