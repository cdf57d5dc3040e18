"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one aggregate and one join on nodes; labels only fall, and the number
of rounds grows with the logarithm of the longest chain.  Hubs are safe: a node's
neighbours are never gathered, only their minimum, which is combined on the map
side.  Rounds are cut by checkpoints in the shared folder.  A round has a task for every
ROWS edges, whatever the session's number of shuffle partitions: edges that one task holds
are not shuffled at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import cut, release

#: Edges that one task of a round takes.
ROWS = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of an edge reaches.

    Loops, repeated edges and both directions may occur; an empty table gives an empty one.
    """
    now = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        n, total = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if (n, total) == before or not n:
            break
        before = (n, total)
        tasks = -(-n // ROWS)
        now = now.coalesce(tasks)
        # large star: every larger neighbour of u goes to the least of u and its neighbours
        both = now.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")), F.struct(F.col("v").alias("x"), F.col("u").alias("y")))).alias("e")).select("e.x", "e.y")
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks)
        # small star: u and its smaller neighbours go to the least of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = cut(small.filter("u <> v").distinct().coalesce(tasks))
        # the files of a round's shuffles are small but many
        del both, least, large, small
        release(edges.sparkSession)
    # now every node that isn't its component's least has one edge, to the least
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
