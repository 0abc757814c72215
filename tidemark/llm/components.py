"""Connected components of links, on Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node that can be reached.

    Alternating large and small stars: first every node tells its larger neighbours its smallest one, then
    its smaller ones, until nothing changes; the distance to the root about halves each time. Minima are
    aggregated before they are shuffled, and the join that hands them on is split where a node has many
    neighbours, so a star of any size is never gathered. Every step is written, so nothing is computed twice
    and no lineage grows. NULLs link nothing.
    """
    edges = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, name)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter(F.col("u") != F.col("v")).distinct(), name)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))  # u > v throughout
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.filter(F.col("u") != F.col("v")).unionByName(lowest.withColumnRenamed("m", "v")).distinct()
        edges = written(small, name)
        digest = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if digest == state:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = digest
