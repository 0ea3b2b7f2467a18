"""Connected components of a link table, in the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise, remove

#: labels are broadcast up to this many nodes (16 bytes each), else joined by shuffle
BROADCAST_NODES = 500_000
#: how often labels are replaced by their labels' labels in a round
JUMPS = 2


def _named(table: DataFrame, key: str, value: str, few: bool) -> DataFrame:
    out = table.select(F.col("node").alias(key), F.col("label").alias(value))
    return F.broadcast(out) if few else out


def connected_components(links: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links``; component is the smallest node reachable.

    Each round hangs every node on its smallest neighbour if that is smaller -
    an aggregate that is combined before it is shuffled, so a hub costs one row
    a task - follows these links upwards, and replaces the nodes of all links by
    what they now hang on.  A round leaves half of the nodes at most, and none
    of a star.  All joins are between written tables, one of which has a node
    once: AQE can split a hub's links.  An empty link table, self links and
    repeated links are fine.
    """
    edges = materialise(links.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u > v"), "cc")
    spark = links.sparkSession
    steps: list[DataFrame] = []
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("label")), F.struct(F.col("v").alias("node"), F.col("v").alias("label")))).alias("e"))
        hung = materialise(ends.select("e.*").groupBy("node").agg(F.min("label").alias("label")), "cc-hung")
        few = hung.count() <= BROADCAST_NODES
        for _ in range(JUMPS):
            higher = hung.join(_named(hung, "at", "up", few), F.col("label") == F.col("at")).select("node", F.col("up").alias("label"))
            hung = materialise(higher, "cc-hung")
        steps.append(hung)
        ends = edges.join(_named(hung, "u", "x", few), "u").join(_named(hung, "v", "y", few), "v")
        less = materialise(ends.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u > v").distinct(), "cc")
        remove(spark, edges.inputFiles()[0].rsplit("/", 1)[0])
        edges = less
    else:
        raise RuntimeError("links did not settle")
    if not steps:
        return spark.createDataFrame([], "node long, component long")
    found = steps[0]
    for step in steps[1:]:
        found = found.join(_named(step, "at", "up", step.count() <= BROADCAST_NODES), F.col("label") == F.col("at"), "left").select("node", F.coalesce("up", "label").alias("label"))
    return found.select("node", F.col("label").alias("component"))
