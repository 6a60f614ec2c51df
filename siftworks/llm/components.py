"""Connected components by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import discard, materialise, work_dir


def connected_components(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """node, component (the least node reachable) for every node of ``edges``.

    ``edges`` has two long columns, u and v.  Each round links every node's
    larger neighbours, then its smaller ones, to the least of its
    neighbourhood; minima are combined before they are shuffled, and joins
    against a node with very many links are split by AQE.  Rounds are written
    to the shared folder, those before the last are removed; no link is
    collected.  Ends when a round changes nothing, after about the logarithm of
    the longest path.
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    last = work_dir(spark, "links")
    edges = materialise(edges, "links", last)
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        halfway, done = work_dir(spark, "links-large"), work_dir(spark, "links-small")
        large = materialise(large, "links-large", halfway)
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).distinct()
        edges = materialise(small, "links-small", done)
        discard(spark, halfway)
        discard(spark, last)
        last = done
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
