"""Connected components of an edge table, by stars that grow and shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamsync.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of ``edges`` (a, b: longs).

    Large and small stars by turns (Kiveris and others, 2014): every node joins its larger
    neighbours, then its smaller ones, to the smallest node it knows, until nothing moves.
    The work of a node with many edges is a partial minimum and a join.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.select("u", "v").union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy(F.col("u").alias("of")).agg(F.least(F.min("v"), F.col("of")).alias("m"))
        large = both.join(least, F.col("u") == F.col("of")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # every edge now goes from a node to a smaller one
        least = large.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("of"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m")).toDF("u", "v")
        now = stored(small.filter("u <> v").distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
