"""Connected components of a graph that is too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import stored


def components(links: DataFrame, folder: str, rows: int | None = None) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``); the root is the smallest node.

    Large-star and small-star steps in turn until nothing changes; every step joins and
    aggregates links, which combine before they are shuffled. Written to ``folder`` each
    round, so a lost executor costs one step. ``rows`` says about how many links there are at most.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, folder, "edges_0", rows)
    last, n = None, edges.count()
    for step in range(1, 100):
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # every node keeps the link to its smallest neighbour
        large = large.union(low.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        large = stored(large, folder, f"large_{step}", 2 * n)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(down.select("a", F.col("m").alias("b")))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        edges = stored(small, folder, f"edges_{step}", 2 * n)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last, n = now, now[0]
    else:
        raise RuntimeError("components did not settle")  # roots would be wrong
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b"), F.col("b"))).distinct()
