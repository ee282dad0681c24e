"""Connected components of an edge table as a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import discard, durable


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Alternates two shuffles until nothing changes: every larger neighbour of a
    node is linked to the node's smallest neighbour, then every smaller one and
    the node itself are. Each pass is written to the shared checkpoint folder,
    so lineage stays short and no pass is lost with an executor. A star of any
    size is only an aggregate by min and a join, which adaptive execution splits
    where one node holds much of the edges. Passes grow with the logarithm of
    the longest path. No edges give no rows; loops and repeats do no harm.
    """
    spark = edges.sparkSession

    def both(e: DataFrame) -> DataFrame:
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def relink(e: DataFrame) -> DataFrame:
        least = e.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
        return e.join(least, "u")

    now, path = durable(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), name)
    seen = None
    while True:
        # large star: larger neighbours of u go to the least of u and its neighbours
        large = relink(both(now)).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the least of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        linked = relink(down)
        small = linked.select(F.col("v").alias("u"), F.col("least").alias("v")).union(linked.select("u", F.col("least").alias("v"))).where("u <> v").distinct()
        after, new_path = durable(small, name)
        # each edge's two 64-bit hashes, summed as decimals: 128 bits and the count would have to collide
        state = tuple(after.agg(F.count("*"), *[F.sum(F.xxhash64(F.lit(n), "u", "v").cast("decimal(20,0)")) for n in (0, 1)]).first())
        discard(spark, path)
        now, path = after, new_path
        if state == seen:
            break
        seen = state
    labels = now.groupBy("u").agg(F.min("v").alias("v"))
    roots = now.select("v").distinct().select(F.col("v").alias("u"), F.col("v"))
    return labels.union(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
