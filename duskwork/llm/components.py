"""Connected components of an undirected graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwork.llm.frames import written


def components(pairs: DataFrame) -> DataFrame:
    """node, component (its smallest reachable id) for every node of ``pairs`` (columns a, b).

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its smallest one, then its smaller neighbours. Each step is a
    grouped minimum and a join; no group is collected. Each round is written to the
    shared folder, so lineage stays short.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = written(pairs.select(larger.alias("u"), smaller.alias("v")).filter("u <> v").distinct(), "edges")
    state = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        star = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        low = star.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(low.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    ends = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node")).distinct().join(ends.select("node"), "node", "left_anti")
    return ends.unionByName(roots.withColumn("component", F.col("node")))
