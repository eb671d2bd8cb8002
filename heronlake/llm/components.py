"""Connected components by randomised contraction.

Every round, each node points at the neighbour (or itself) whose hash is lowest in that round; edges move to the
nodes pointed at, and loops and repeats go. In expectation a fixed share of the nodes goes each round, whatever the
shape, so chains take as few rounds as stars. The pointers of all rounds, composed, name a node of each component.

Nothing is collected: a round is an aggregate with partial sums (so a hub costs one row a task) and two joins that
Spark may split, and each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.support import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the smallest node that can be reached.

    Loops, repeats and nulls in edges are passed over. No edges give no rows.
    """
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    pointers: list[DataFrame] = []
    while not now.isEmpty():
        seed = F.lit(len(pointers))
        both = now.union(now.select("b", "a"))
        low = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b", seed).alias("h"), F.col("b").alias("n"))).alias("low"))
        own = F.struct(F.xxhash64("node", seed).alias("h"), F.col("node").alias("n"))
        step = written(low.select("node", F.least(F.col("low"), own)["n"].alias("to")), "pointers")
        pointers.append(step)
        moved = now.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        now = written(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not pointers:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    ends = pointers[0]
    for step in pointers[1:]:
        ends = ends.join(step.select(F.col("node").alias("to"), F.col("to").alias("on")), "to", "left").select("node", F.coalesce("on", "to").alias("to"))
    ends = written(ends, "ends")
    least = ends.groupBy(F.col("to").alias("end")).agg(F.min("node").alias("component"))
    # The key is rewritten so that both sides are dealt anew and Spark can split a large component among tasks.
    least = least.select((F.col("end") + 0).alias("end"), "component")
    return ends.join(least, ends["to"] == least["end"]).select("node", "component")
