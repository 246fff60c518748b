"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.operators.storage import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """edges (a, b), a > b. Large star: bind larger neighbours to the least one; small star: the others and the node itself."""
    if small:
        pairs = edges
    else:
        pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = pairs.join(materialize(least, "least"), "a")  # as a table: the edges of a hot node can be split as a skewed join
    if small:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
    else:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest node reachable.

    Self-loops and nulls are ignored; a node without other edges doesn't come out. Each round's edges are
    written to the shared folder, so a lost executor costs one round at most. The edge sets meet their fixed point in
    O(log^2 n) rounds.
    """
    now = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = materialize(now, "edges"), None
    while True:
        print_of = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if print_of["n"] == 0 or (print_of["n"], print_of["h"]) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        seen = (print_of["n"], print_of["h"])
        now = materialize(_star(_star(now, small=False), small=True), "edges")


def first_independent(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes kept by the greedy rule: in ascending order a node stays unless an earlier kept one is its neighbour.

    nodes (node), edges (a, b). Each round keeps the open nodes without an open earlier neighbour and drops the neighbours of kept
    ones; the outcome equals the sequential scan. The first open node is always decided, so the rounds come to an end, after as many as the longest
    chain of decisions at most. What is decided is a table of its own.
    """
    links = edges.select(F.greatest("a", "b").alias("later"), F.least("a", "b").alias("earlier")).where("later <> earlier").distinct()
    links = materialize(links, "links")
    touched = links.select(F.explode(F.array("later", "earlier")).alias("node")).distinct()
    free = nodes.join(touched, "node", "left_anti")
    open_, kept = materialize(touched, "open"), []
    while not open_.isEmpty():
        live = links.join(open_.withColumnRenamed("node", "later"), "later", "left_semi").join(open_.withColumnRenamed("node", "earlier"), "earlier", "left_semi")
        now = materialize(open_.join(live.select(F.col("later").alias("node")), "node", "left_anti"), "kept")
        kept.append(now)
        gone = links.join(now.withColumnRenamed("node", "earlier"), "earlier", "left_semi").select(F.col("later").alias("node"))
        open_ = materialize(open_.join(now, "node", "left_anti").join(gone, "node", "left_anti"), "open")
        if len(kept) == 32:  # a long chain doesn't become a long plan
            kept = [materialize(reduce(DataFrame.unionByName, kept), "kept")]
    return reduce(DataFrame.unionByName, kept, free)


def first_in_buckets(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``first_independent`` where nodes of a bucket are neighbours: nodes (node), members (node, bucket). No pairs are made, so a
    round is linear in the buckets' sizes: a node that comes first in all its buckets is kept and the others of these leave.
    """
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    live = materialize(members.distinct().join(shared, "bucket", "left_semi"), "members")
    out = nodes.join(live.select("node").distinct(), "node", "left_anti")
    kept: list[DataFrame] = []
    while not live.isEmpty():
        least = live.groupBy("bucket").agg(F.min("node").alias("first"))
        now = live.join(least, "bucket").groupBy("node").agg(F.bool_and(F.col("first") == F.col("node")).alias("ok")).where("ok").select("node")
        now = materialize(now, "kept")
        kept.append(now)
        if len(kept) == 32:
            kept = [materialize(reduce(DataFrame.unionByName, kept), "kept")]
        taken = live.join(now, "node", "left_semi").select("bucket").distinct()
        gone = live.join(taken, "bucket", "left_semi").select("node").distinct()
        live = materialize(live.join(gone, "node", "left_anti"), "members")
    return reduce(DataFrame.unionByName, kept, out)
