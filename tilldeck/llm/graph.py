"""Connected components of a link table, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tilldeck.session import scratch_dir


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: its lineage ends
    there, and a lost executor takes nothing with it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component``: the smallest node that links lead to.

    Rounds of large-star and small-star: every node hands its neighbours on to
    the smallest one it knows, until each component is a star. For the large star
    a node's neighbours are reduced to a minimum before the shuffle and joined
    back, so a hub is never gathered; after it, a node has few smaller ones. Only
    nodes with a link appear; null ends and loops are no links.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v"), "links")
    own = Window.partitionBy("u")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
        # Small star: a node and its smaller neighbours go to the smallest one.
        # Repeats are dropped and minima found in the partitions of one shuffle.
        small = large.repartition("u").distinct().withColumn("low", F.min("v").over(own))
        small = small.select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))
        state = Observation()
        change = F.xxhash64("u", "v").cast("decimal(38,0)")
        edges = written(small.observe(state, F.count("*").alias("n"), F.sum(change).alias("sum")), "stars")
        if state.get == seen:
            stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
            return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state.get
