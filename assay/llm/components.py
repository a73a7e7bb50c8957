"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its smallest node.

    Each round hangs neighbours on the smallest node that a node knows: first all larger ones,
    then all smaller ones. It ends when a round changes nothing, after about log(nodes) rounds.
    Rounds are written to the shared folder. A node of many links is summed up before it is
    shuffled, and its links are joined back, which lets Spark split them.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == before:
            break
        before = (state["n"], state["h"])
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        larger = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = larger.distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        smaller = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(smaller.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
