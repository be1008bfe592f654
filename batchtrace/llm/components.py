"""Connected components of an undirected link table, by alternating star steps.

Each round every node points at the least node it knows: first all its larger
neighbours are linked to the least one (large star), then all its smaller ones
(small star). The links stay as many or fewer, and after a logarithmic number of
rounds each component is a star around its least node. Rounds are checkpointed
in the shared folder. Minima are combined before the shuffle, so a node with
very many links sends one row a task; joins on such a node are left to the
adaptive skew split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchtrace.llm.common import checkpointed


def _star(links: DataFrame, low_only: bool) -> DataFrame:
    """Links (node, other) rewritten to the least neighbour of each node."""
    both = links if low_only else links.unionAll(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    paired = both.join(least, "node")
    moved = paired.filter(F.col("other") > F.col("node")) if not low_only else paired
    out = moved.select(F.col("other").alias("node"), F.col("least").alias("other"))
    if low_only:
        out = out.unionAll(least.select("node", F.col("least").alias("other")))
    return out.filter(F.col("node") != F.col("other")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node that a link ``(a, b)`` names, but roots."""
    a, b = F.col("a"), F.col("b")
    now = checkpointed(links.filter(a != b).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other")).distinct())
    mark = None
    while True:
        large = _star(now, False)
        # small star: every link goes from the larger node to the smaller one
        now = checkpointed(_star(large.select(F.greatest("node", "other").alias("node"),
                                              F.least("node", "other").alias("other")), True))
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)")).alias("s")).first()
        if mark == (seen.n, seen.s):
            return now.select("node", F.col("other").alias("root"))
        mark = (seen.n, seen.s)
