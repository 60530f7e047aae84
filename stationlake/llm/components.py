"""Connected components over an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum (partial aggregate, so a hub costs each task one row) and a join
back (split by adaptive execution where a hub is hot). The edges of each round are written to the
shared folder, so the plan stays short and a lost executor repeats at most one round. No step makes
more edges than it was given, so the links' count tells how many files each of them needs, whatever
the number of shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import staged

ROWS = 100_000             # edges or nodes that one task writes


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in a partition for each ``ROWS`` of them. To be used behind a shuffle:
    the tasks before it stay as they are."""
    return df.coalesce(rows // ROWS + 1)


def _stars(edges: DataFrame) -> DataFrame:
    """For every node ``a`` of ``edges`` (lo, hi) the smallest id ``m`` among itself and its neighbours, and whether it is
    ``settled``: the smallest end of all its edges, or the larger end of its only one."""
    both = edges.selectExpr("hi AS a", "lo AS b", "1 AS up").union(edges.selectExpr("lo AS a", "hi AS b", "0 AS up"))
    return (both.groupBy("a").agg(F.min("b").alias("m"), F.sum("up").alias("up"), F.count("*").alias("n"))
            .select("a", F.least("a", "m").alias("m"), F.expr("up = 0 OR n = 1").alias("settled")))


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) → (node, root): root is the smallest id of the node's component.

    Only linked nodes are returned. Self-links and repeated links are allowed; null ends are not.
    """
    edges = staged(links.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")), "links")
    most = edges.count()
    while True:
        least = staged(sized(_stars(edges), 2 * most), "star")
        # only settled nodes: every component is a star around its smallest id
        if least.where("NOT settled").isEmpty():
            return least.select(F.col("a").alias("node"), F.col("m").alias("root"))
        # large star: larger neighbours move to the smallest id around the node
        large = (edges.withColumnRenamed("lo", "a").join(least, "a")
                 .select(F.col("m").alias("lo"), "hi").where("lo <> hi"))
        edges = staged(sized(large.distinct(), most), "large-star")
        # small star: smaller neighbours of a node are joined to their minimum
        least = staged(sized(edges.groupBy(F.col("hi").alias("a")).agg(F.min("lo").alias("m")), most), "star")
        small = (edges.withColumnRenamed("hi", "a").join(least, "a")
                 .select(F.col("m").alias("lo"), F.explode(F.array("lo", "a")).alias("hi")).where("lo <> hi"))
        edges = staged(sized(small.distinct(), most), "small-star")
