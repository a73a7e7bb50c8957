"""Lineage as edges: from moves, declared against observed, and traced upstream."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.sources.tables import materialise

DECLARED_ONLY = "declared only"


def edges_from_moves(moves: DataFrame, reads: str = "reads", writes: str = "writes") -> DataFrame:
    """Distinct (source, target) edges; reads pair with writes inside their own move only."""
    return (
        moves.select(F.explode(reads).alias("source"), F.col(writes))
        .select("source", F.explode(writes).alias("target"))
        .distinct()
    )


def moves_from_source(landed: DataFrame, connection: str, path: str) -> DataFrame:
    """One move per landed path, read from the source system that delivered it."""
    return landed.select(
        F.array(F.col(connection).cast("string")).alias("reads"),
        F.array(F.col(path).cast("string")).alias("writes"),
    )


def plan_sources(df: DataFrame) -> list[str]:
    """Names of the tables at rest that ``df`` reads, taken from its analysed plan.

    A table is named by the last part of its path, without an ending; a plan has one leaf for each
    scan, so this costs the same whatever the tables hold.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    names = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            roots = leaf.relation().location().rootPaths()
            names |= {roots.apply(k).getName().removesuffix(".parquet") for k in range(roots.size())}
    return sorted(names)


def label_edges(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Each declared edge with the producer that was seen making it, or none.

    ``observed`` is (source, target, producer); an edge seen from several producers
    takes the first by name.
    """
    seen = observed.groupBy("source", "target").agg(F.min("producer").alias("_producer"))
    return (
        declared.select("source", "target")
        .distinct()
        .join(seen, ["source", "target"], "left")
        .withColumn("producer", F.coalesce("_producer", F.lit(DECLARED_ONLY)))
        .withColumn("observed", F.col("_producer").isNotNull())
        .drop("_producer")
    )


def observed_or_fail(observed: DataFrame) -> DataFrame:
    """Observed edges, or an error: a failed read must not look like an empty graph."""
    if observed.isEmpty():
        raise ValueError("no observed edges were read; refusing to label everything as declared only")
    return observed


def orphans(into: DataFrame, out_of: DataFrame) -> DataFrame:
    """Nodes where two hops should meet and do not: written but never read, or the reverse."""
    written = into.select(F.col("target").alias("node")).distinct()
    read = out_of.select(F.col("source").alias("node")).distinct()
    return (
        written.withColumn("written", F.lit(True))
        .join(read.withColumn("read", F.lit(True)), "node", "full_outer")
        .where(F.col("written").isNull() | F.col("read").isNull())
        .select("node", F.when(F.col("read").isNull(), "never read").otherwise("never written").alias("problem"))
    )


def trace_upstream(edges: DataFrame, starts: DataFrame, folder: str) -> DataFrame:
    """Every (node, ancestor, distance) above the ``starts``, at its shortest distance.

    Edges and each level are written under ``folder``, so a lost executor does not
    replay the levels below. A level joins the previous one's new pairs only; pairs
    already reached at a shorter distance are left out, so a cycle ends by itself, and
    the trace ends with the level that reaches nothing new, however deep that is.
    """
    upstream = materialise(edges.select("source", "target").distinct(), f"{folder}/edges")
    level = materialise(
        starts.select(F.col("node"), F.col("node").alias("ancestor"), F.lit(0).alias("distance")).distinct(),
        f"{folder}/level=0",
    )
    seen, found = level, level.where(F.lit(False))
    for distance in count(1):
        above = level.join(upstream, F.col("ancestor") == F.col("target")).select(
            "node", F.col("source").alias("ancestor"), F.lit(distance).alias("distance")
        )
        shortest = above.unionByName(seen).groupBy("node", "ancestor").agg(F.min("distance").alias("distance"))
        level = materialise(shortest.where(F.col("distance") == distance), f"{folder}/level={distance}")
        if level.isEmpty():
            return found
        found = found.unionByName(level)
        seen = seen.unionByName(level)


def _meet(rows: DataFrame, key: str, table: DataFrame, node: str, how: str) -> DataFrame:
    """``rows`` joined to the rows of ``table`` whose ``node`` is their ``key``; null meets null.

    The one join key is a hash: rows are sorted by a number, not by names that begin alike. Names
    are compared as a range of one, which the optimiser does not turn into a second key.
    """
    left, right = F.col(key), F.col(node)
    return rows.withColumn("_key", F.xxhash64(left.cast("string"))).join(
        table.withColumn("_node", F.xxhash64(right.cast("string"))),
        (F.col("_key") == F.col("_node"))
        & (((left <= right) & (left >= right)) | (left.isNull() & right.isNull())),
        how,
    )


def trace_to_sources(edges: DataFrame, starts: DataFrame, folder: str) -> DataFrame:
    """The ancestors that nothing feeds: where each start ultimately comes from, at its shortest distance.

    Only what feeds a start directly and is itself fed is traced level by level, once for
    all starts that share it; a start takes over its feeders' origins, one step further
    away. A feeder that nothing feeds is an origin at distance 1, and is compared with
    others only if a longer way leads to it too. Each table that is read more than once
    is written under ``folder``, so edges meet the starts once and their feeders once.
    """
    every = materialise(
        edges.select("source", "target").where(F.col("target").isNotNull()).distinct(), f"{folder}/edges"
    )
    nodes = starts.select("node", F.lit(True).alias("is_start"), F.lit(False).alias("is_feeder")).unionByName(
        every.select(F.col("source").alias("node"), F.lit(False).alias("is_start"), F.lit(True).alias("is_feeder"))
    )
    nodes = materialise(
        nodes.groupBy("node").agg(F.max("is_start").alias("is_start"), F.max("is_feeder").alias("is_feeder")),
        f"{folder}/nodes",
    )
    into = materialise(
        _meet(every, "target", nodes, "node", "inner").select("source", "target", "is_start", "is_feeder"),
        f"{folder}/into",
    )
    direct = into.where("is_start").select(F.col("target").alias("start"), F.col("source").alias("feeder"))
    inner = materialise(into.where("is_feeder").select("source", "target"), f"{folder}/inner")
    fed = materialise(inner.select(F.col("target").alias("node")).distinct(), f"{folder}/fed")
    feeders = materialise(
        direct.select(F.col("feeder").alias("node")).distinct().join(fed, "node", "left_semi"), f"{folder}/feeders"
    )

    above = trace_upstream(inner, feeders, f"{folder}/above")
    origins = materialise(
        above.join(fed.withColumnRenamed("node", "ancestor"), "ancestor", "left_anti").select(
            "node", F.col("ancestor").alias("origin"), "distance"
        ),
        f"{folder}/origins",
    )
    # A feeder that only cycles feed has no origin, and no distance; an origin of others is its own.
    known = materialise(
        feeders.join(origins, "node", "left").unionByName(
            origins.select(F.col("origin").alias("node"), "origin", F.lit(0).alias("distance")).distinct()
        ),
        f"{folder}/known",
    )
    traced = materialise(
        _meet(direct, "feeder", known, "node", "left")
        .where(F.col("_node").isNull() | F.col("distance").isNotNull())
        .select(
            F.col("start").alias("node"),
            F.when(F.col("_node").isNull(), F.col("feeder")).otherwise(F.col("origin")).alias("origin"),
            F.coalesce(F.col("distance") + 1, F.lit(1)).alias("distance"),
            F.col("_node").isNotNull().alias("shared"),
        ),
        f"{folder}/traced",
    )
    shortest = traced.where("shared").groupBy("node", "origin").agg(F.min("distance").alias("distance"))
    return traced.where(~F.col("shared")).select("node", "origin", "distance").unionByName(shortest)
