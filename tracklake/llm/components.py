"""Connected components of a graph of links, as Spark joins.

Alternating stars: in a large star every node hands its larger neighbours to
its smallest neighbour, in a small star it hands itself and its smaller ones.
The edge list never grows and becomes a star per component after about log2
rounds. A hub's neighbours are only ever aggregated to a minimum or streamed
through a join, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionAll(edges.select("b", "a"))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select("u", "m"))
    return out.where("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the links ``a``-``b``; the component
    is its smallest node. Links may repeat, run either way or join a node to
    itself; null ends are left out."""
    ends = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    now = materialize(ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        now = materialize(_star(_star(now, True), False), "links")
    own = ends.select(F.col("a").alias("node")).unionAll(ends.select("b")).distinct()
    return own.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("component")
    )
