"""Connected components of a link table by alternating star rounds.

Large-star and small-star rounds (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014) turn the links of every component into a star
around its smallest node, in a number of rounds that grows with the logarithm
of its size. Each round is aggregations and joins on the link table alone; it
is written to the shared folder, so lineage stays short and a lost executor
costs one round's tasks at most. Joins are plain equi-joins of links with one
row per node. Those rows are a written table too: adaptive execution splits the
links of a node that has very many only where both sides come from a shuffle or
a scan, not where one is an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _content(links: DataFrame) -> tuple[int, int]:
    r = links.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first()
    return r[0], r[1] or 0


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (src long, dst long); root is the smallest node reachable.

    Loops and repeated links are fine; null ends are dropped; without links the
    result is empty.
    """
    now = stored(links.filter(F.col("src") != F.col("dst"))
                 .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(),
                 "links")
    content = _content(now)
    while content[0]:
        both = now.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
            now.select(F.col("dst").alias("u"), F.col("src").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = (both.join(least, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("src"), F.col("m").alias("dst"))
                 .unionByName(least.select(F.col("u").alias("src"), F.col("m").alias("dst"))).distinct())
        after = stored(small, "links")
        after_content = _content(after)
        if after_content == content:
            break
        now, content = after, after_content
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
        now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct())
