"""Connected components by alternating large and small stars, each round written to the shared folder.

Minima are aggregated before the shuffle and joined back, so a node with a third of all edges is no bottleneck. They are joined by sort and merge: edges of stars take
little room on disk, and a table of them that Spark takes for small would be collected on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges(u, v); a component is named by its least node.

    An edge with a null end, or from a node to itself, names no component. A star of very many edges is split where Spark splits skewed joins.
    """
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(down, "edges")
    state = _state(now)
    for _ in range(rounds):
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest.hint("merge"), "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = stored(small.where("u <> v").distinct(), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
