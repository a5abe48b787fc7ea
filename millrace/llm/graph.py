"""Connected components of a link table, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources import stage

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for every node of `links` (a, b: bigint) but the roots.

    Every round points the neighbours of a node to its smallest neighbour, larger ones first, then smaller
    ones; a path shrinks to a star in a logarithmic number of rounds. Rounds are staged, so a lost
    executor costs one round, and only a count and a checksum reach the driver.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, last = stage(ordered.distinct(), "components"), None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), "components")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(small.unionByName(smallest.toDF("a", "b")).distinct(), "components")
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == last:
            return edges.toDF("node", "root")
        last = state
    raise RuntimeError("components did not settle")
